"""Projection, merge and land mask."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oceanloom.schema import CELL_KEY, GEOMETRY_VARIABLES


def with_land_mask(df: DataFrame) -> DataFrame:
    """``maskc`` is 1 on ocean and NULL on land; a missing ``hfacc`` is land."""
    return df.withColumn("maskc", F.when(F.col("hfacc") > 0, F.lit(1.0))).withColumn("is_ocean", F.coalesce(F.col("hfacc") > 0, F.lit(False)))


def merge(state: DataFrame, grid: DataFrame, how: str = "full_outer", compat: str = "override") -> DataFrame:
    """State and geometry side by side.  Cells of either side survive; a column of both takes the state's value first.

    With ``compat="no_conflicts"`` a cell that both sides give different values for ends the job with an error that names it.
    """
    if compat not in ("override", "no_conflicts"):
        raise ValueError("compat must be override or no_conflicts")
    shared = [c for c in state.columns if c in grid.columns and c not in CELL_KEY]
    right = grid.withColumnsRenamed({c: f"_grid_{c}" for c in shared})
    both = state.join(right, list(CELL_KEY), how)
    if not shared:
        return both

    def one(c: str) -> F.Column:
        value, other = F.col(c), F.col(f"_grid_{c}")
        if compat == "override":
            return F.coalesce(value, other)
        where = F.concat_ws(" ", F.lit(f"conflicting values of {c} at face, j, i"), *[F.col(k).cast("string") for k in CELL_KEY])
        return F.when(value != other, F.raise_error(where).cast(state.schema[c].dataType)).otherwise(F.coalesce(value, other))

    return both.withColumns({c: one(c) for c in shared}).drop(*[f"_grid_{c}" for c in shared])


def conflicts(state: DataFrame, grid: DataFrame) -> DataFrame:
    """Cells whose shared columns hold two different values; ``merge`` expects none."""
    shared = [c for c in state.columns if c in grid.columns and c not in CELL_KEY]
    right = grid.select(*CELL_KEY, *[F.col(c).alias(f"_grid_{c}") for c in shared])
    differs = F.lit(False)
    for c in shared:
        differs = differs | F.coalesce(F.col(c) != F.col(f"_grid_{c}"), F.lit(False))
    return state.join(right, list(CELL_KEY)).where(differs).select(*CELL_KEY)


def prepare(state: DataFrame, grid: DataFrame, how: str = "full_outer") -> tuple[DataFrame, DataFrame]:
    """The merged frame and the geometry, both with the land mask."""
    kept = grid.select(*CELL_KEY, *[c for c in grid.columns if c.lower() in GEOMETRY_VARIABLES])
    return with_land_mask(merge(state, kept, how)), with_land_mask(kept)
