"""The retained-cell mask: cells at least ``halo_km`` from the nearest masked interface of their own face.

``euclid`` is relational: the distance to the midpoints between cells of
different mask value.  ``marched`` solves the distance equation on blocks of
cells that exchange their borders until none changes; see ``distance``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oceanloom.operators.distance import BLOCK, distances
from oceanloom.operators.stats import face_spacing_km


def interface_points(mask: DataFrame) -> DataFrame:
    """``face, pj, pi`` in half cells: midpoints between neighbours of which one is masked."""
    out = None
    for axis, other in (("i", "j"), ("j", "i")):
        w = Window.partitionBy("face", other).orderBy(axis)
        met = (F.lag(axis).over(w) == F.col(axis) - 1) & (F.lag("masked").over(w) != F.col("masked"))
        at = {axis: 2 * F.col(axis) - 1, other: 2 * F.col(other)}
        points = mask.withColumn("_met", met).where("_met").select("face", at["j"].alias("pj"), at["i"].alias("pi"))
        out = points if out is None else out.unionByName(points)
    return out


def euclid(mask: DataFrame, grid: DataFrame, halo_km: float) -> DataFrame:
    """``face, j, i, retained`` from ``mask(face, j, i, masked)``.

    Each interface point marks the cells in its own box of offsets, so the work grows with the coast, not with its square.
    A wholly masked face keeps nothing; a face without masked cells keeps all.
    """
    points = interface_points(mask).join(F.broadcast(face_spacing_km(grid)), "face")  # a row per face
    reach_j, reach_i = (F.ceil(F.lit(2.0 * halo_km) / F.col(c)).cast("int") for c in ("dy_km", "dx_km"))

    def reached(at: str, reach) -> F.Column:
        return F.explode(F.sequence(F.floor((F.col(at) - reach) / 2).cast("int"), F.ceil((F.col(at) + reach) / 2).cast("int")))

    near = points.withColumn("j", reached("pj", reach_j)).withColumn("i", reached("pi", reach_i))
    dy, dx = (F.col("j") - F.col("pj") / 2.0) * F.col("dy_km"), (F.col("i") - F.col("pi") / 2.0) * F.col("dx_km")
    halo = near.where(F.sqrt(dy * dy + dx * dx) < halo_km).select("face", "j", "i").distinct().withColumn("_in", F.lit(True))
    marked = mask.select("face", "j", "i", "masked").join(halo, ["face", "j", "i"], "left")
    return marked.select("face", "j", "i", (F.col("_in").isNull() & ~F.col("masked")).alias("retained"))


def marched(mask: DataFrame, grid: DataFrame, halo_km: float, block: int = BLOCK) -> DataFrame:
    """The same mask by the distance that a front from the interface travels around masked cells; cells missing from a face count as masked."""
    found = distances(mask, face_spacing_km(grid), halo_km, block)
    return found.select("face", "j", "i", (~F.col("masked") & F.col("km").isNull()).alias("retained"))
