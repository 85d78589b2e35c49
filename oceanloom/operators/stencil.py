"""Differences, two-point means and the tracer gradient on the staggered grid.

Windows run along a grid row or column, so one task holds at most one row or
column of one face.  Neighbours are found by coordinate: a gap in the cells
gives NULL, never the value across the gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AXES = {"i": "j", "j": "i"}
DIFF_BOUNDARIES = ("null", "fill", "extend", "periodic")


def along(axis: str, *more: str) -> Window:
    return Window.partitionBy("face", AXES[axis], *more).orderBy(axis)


def _neighbour(value: Column, axis: str, step: int, more: tuple[str, ...]) -> Column:
    w = along(axis, *more)
    return F.when(F.lag(axis, step).over(w) == F.col(axis) - step, F.lag(value, step).over(w))


def left_difference(value: Column | str, axis: str, boundary: str = "null", more: tuple[str, ...] = ()) -> Column:
    """``v[k] - v[k-1]``, standing on the left edge of cell k.

    At the first cell of a line: NULL, or ``v - 0`` (fill), 0 (extend), or the difference to the last cell (periodic).
    """
    if boundary not in DIFF_BOUNDARIES:
        raise ValueError(f"boundary must be one of {DIFF_BOUNDARIES}")
    v = F.col(value) if isinstance(value, str) else value
    inner = v - _neighbour(v, axis, 1, more)
    if boundary == "null":
        return inner
    w = along(axis, *more)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = {"fill": v, "extend": v - v, "periodic": v - F.last(v).over(whole)}[boundary]
    return F.when(F.row_number().over(w) == 1, edge).otherwise(inner)


def centre_mean(edge: Column | str, axis: str, fill: float = 0.0, more: tuple[str, ...] = ()) -> Column:
    """Mean of the two edges of a cell; beyond the last cell of a line the edge value is ``fill``."""
    e = F.col(edge) if isinstance(edge, str) else edge
    w = along(axis, *more)
    is_last = F.lead(axis).over(w).isNull()
    return F.lit(0.5) * (e + F.when(is_last, F.lit(fill)).otherwise(_neighbour(e, axis, -1, more)))


def edge_gradients(df: DataFrame, value: str, boundary: str = "null") -> DataFrame:
    """Adds ``gx`` and ``gy`` on left edges: differences over ``dxc`` and ``dyc``."""
    df = df.withColumn("gx", F.try_divide(left_difference(value, "i", boundary), F.col("dxc")))
    return df.withColumn("gy", F.try_divide(left_difference(value, "j", boundary), F.col("dyc")))


def tracer_gradient(df: DataFrame, value: str, boundary: str = "null", fill: float = 0.0, long_name: str | None = None, units: str | None = None) -> DataFrame:
    """Adds ``zonal`` and ``merid``, the gradient rotated to geographic axes by ``cs`` and ``sn``.

    All row-wise windows come before all column-wise ones: two exchanges in all.
    """
    x = df.withColumn("_gx", F.try_divide(left_difference(value, "i", boundary), F.col("dxc"))).withColumn("_cx", centre_mean("_gx", "i", fill))
    y = x.withColumn("_gy", F.try_divide(left_difference(value, "j", boundary), F.col("dyc"))).withColumn("_cy", centre_mean("_gy", "j", fill))
    return y.select(*[c for c in df.columns if c not in ("zonal", "merid")], *rotated(long_name or value, units))


def rotated(label: str, units: str | None) -> list[Column]:
    """``zonal`` and ``merid`` from ``_cx`` and ``_cy`` by the cell's own rotation."""
    cx, cy, cs, sn = (F.col(c) for c in ("_cx", "_cy", "cs", "sn"))
    return [
        (cx * cs - cy * sn).alias("zonal", metadata={"long_name": f"zonal gradient of {label}", "units": units or ""}),
        (cx * sn + cy * cs).alias("merid", metadata={"long_name": f"meridional gradient of {label}", "units": units or ""}),
    ]


def grad_squared(zonal: Column | str = "zonal", merid: Column | str = "merid") -> Column:
    z, m = (F.col(c) if isinstance(c, str) else c for c in (zonal, merid))
    return z * z + m * m
