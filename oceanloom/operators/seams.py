"""Faces that are joined at their sides: neighbours across seams, turned vectors, and the gradient over them.

A link says which side of a face meets which side of another, and whether the two run against each other.  Sides are
``i_low, i_high, j_low, j_high``.  Only cells along linked sides travel; they enter a face as ghost cells one step beyond
its edge, where the stencils' own windows find them, so the cells themselves are not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oceanloom.operators.stencil import centre_mean, left_difference, rotated

SIDES = ("i_low", "i_high", "j_low", "j_high")
LINKS = "face INT, side STRING, to_face INT, to_side STRING, reversed BOOLEAN"
#: A table of links is taken for broadcasting up to this many rows.
MOST_BROADCAST = 100_000


def face_links(spark: SparkSession, seams: list[tuple[int, str, int, str, bool]]) -> DataFrame:
    """Links of both directions from ``(face, side, to_face, to_side, reversed)``, each seam named once or twice."""
    for _, a, _, b, _ in seams:
        if a not in SIDES or b not in SIDES:
            raise ValueError(f"sides are {SIDES}")
    both = {(int(f), a, int(t), b, bool(r)) for f, a, t, b, r in seams} | {(int(t), b, int(f), a, bool(r)) for f, a, t, b, r in seams}
    if len({x[:2] for x in both}) < len(both):
        raise ValueError("a side has two neighbours")
    return spark.createDataFrame(sorted(both), LINKS)


def _sizes(cells: DataFrame) -> DataFrame:
    return cells.groupBy("face").agg((F.max("j") + 1).alias("_nj"), (F.max("i") + 1).alias("_ni"))


def ghosts(cells: DataFrame, links: DataFrame, columns: list[str]) -> DataFrame:
    """``face, j, i, side, from_side, reversed`` and the columns of the cells across each seam, one step beyond the face's edge.

    Where the sides of a seam have different lengths, cells without a counterpart have no ghost.  A face may be linked to
    itself.  Cells that are missing along a side give none.
    """
    sizes = _sizes(cells)  # a row for each face
    low, high = F.lit(0), lambda c: F.col(c) - 1
    at = {"i_low": F.col("i") == low, "i_high": F.col("i") == high("_ni"), "j_low": F.col("j") == low, "j_high": F.col("j") == high("_nj")}
    sides = F.array_compact(F.array(*[F.when(at[s], F.lit(s)) for s in SIDES]))
    edge = cells.join(F.broadcast(sizes), "face").where(at["i_low"] | at["i_high"] | at["j_low"] | at["j_high"])
    edge = edge.select(F.col("face").alias("to_face"), *columns, "j", "i", "_nj", "_ni", F.explode(sides).alias("to_side"))
    along_i = F.col("to_side").startswith("j_")
    place, length = F.when(along_i, F.col("i")).otherwise(F.col("j")), F.when(along_i, F.col("_ni")).otherwise(F.col("_nj"))
    edge = edge.select("to_face", "to_side", *columns, place.alias("_at"), length.alias("_n"))
    small = F.broadcast(links) if links.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else links
    met = edge.join(small, ["to_face", "to_side"]).withColumn("_at", F.when(F.col("reversed"), F.col("_n") - 1 - F.col("_at")).otherwise(F.col("_at")))
    own = met.join(F.broadcast(sizes), "face")
    across = {"i_low": (F.col("_at"), F.lit(-1)), "i_high": (F.col("_at"), F.col("_ni")), "j_low": (F.lit(-1), F.col("_at")), "j_high": (F.col("_nj"), F.col("_at"))}

    def coordinate(k: int) -> Column:
        out = F.lit(None).cast("int")
        for s in SIDES:
            out = F.when(F.col("side") == s, across[s][k].cast("int")).otherwise(out)
        return out

    inside = F.when(F.col("side").startswith("i_"), F.col("_at") < F.col("_nj")).otherwise(F.col("_at") < F.col("_ni")) & (F.col("_at") >= 0)
    return own.where(inside).select("face", coordinate(0).alias("j"), coordinate(1).alias("i"), "side", F.col("to_side").alias("from_side"), "reversed", *columns)


def turned(across: DataFrame, u: str, v: str) -> DataFrame:
    """The ghosts with their vector in the axes of the face that they enter.

    ``u`` runs along i and ``v`` along j of the face that the cell belongs to.  What points into that face through its side
    points out of the face that it enters, and what runs along the seam keeps or changes its sign as the seam runs.
    """
    sign = lambda side: F.when(F.col(side).endswith("_high"), 1.0).otherwise(-1.0)
    inward = -sign("from_side") * F.when(F.col("from_side").startswith("i_"), F.col(u)).otherwise(F.col(v))
    along = F.when(F.col("reversed"), -1.0).otherwise(1.0) * F.when(F.col("from_side").startswith("i_"), F.col(v)).otherwise(F.col(u))
    normal, on_i = sign("side") * inward, F.col("side").startswith("i_")
    return across.withColumns({u: F.when(on_i, normal).otherwise(along), v: F.when(on_i, along).otherwise(normal)})


def linked_gradient(df: DataFrame, value: str, links: DataFrame, boundary: str = "null", fill: float = 0.0) -> DataFrame:
    """Adds ``zonal`` and ``merid`` as ``tracer_gradient`` does, with neighbours across seams; ``boundary`` and ``fill`` hold elsewhere.

    The edge between two faces has the spacing of the cell whose low edge it is; a seam of two high sides, for which none
    is stored, takes that of the cell across.
    """
    across = ghosts(df, links, [value, "dxc", "dyc"])
    spacing = F.when(F.col("from_side").startswith("i_"), F.col("dxc")).otherwise(F.col("dyc"))
    names = [c for c in df.columns if c not in ("zonal", "merid")]

    def along(rows: DataFrame, axis: str, metric: str, out: str) -> DataFrame:
        own = across.where(F.col("side").startswith(f"{axis}_")).select("face", "j", "i", value, spacing.alias(metric), F.lit(True).alias("_ghost"))
        whole = rows.withColumn("_ghost", F.lit(False)).unionByName(own, allowMissingColumns=True)
        edge = whole.withColumn("_g", F.try_divide(left_difference(value, axis, boundary), F.col(metric)))
        return edge.withColumn(out, centre_mean("_g", axis, fill)).where("NOT _ghost").drop("_ghost", "_g")

    both = along(along(df.select(*names), "i", "dxc", "_cx"), "j", "dyc", "_cy")
    return both.select(*names, *rotated(value, None))
