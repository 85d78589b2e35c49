"""Quantile summaries that are stored and merged, with a bound on the error of ranks.

A summary of a group is a few values with weights: what lies in the middle of each of ``size`` equal shares of its values, in
order.  Summaries are made of blocks of cells, so a task sorts one block, and are merged to faces, snapshots or anything
coarser without reading cells again.  A value's weight stands for ranks at most one share away, so making a summary and
each merge add at most ``1 / size`` of all values to the error of a rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SIZE, BLOCK = 1_000, 720


def _thinned(rows: DataFrame, by: list[str], size: int) -> DataFrame:
    """``by, v, weight`` with at most ``size`` values in each group: of each share the value that its middle weight falls on."""
    order = Window.partitionBy(*by).orderBy("v", "weight").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("weight").over(Window.partitionBy(*by))
    ranked = rows.select(*by, "v", "weight", F.sum("weight").over(order).alias("_upto"), total.alias("_total"))
    # The share that the middle of each value's own weight lies in.
    share = F.floor((2 * F.col("_upto") - F.col("weight")) * size / (2 * F.col("_total"))).cast("int")
    shared = ranked.select(*by, "v", "weight", "_upto", F.least(share, F.lit(size - 1)).alias("_share"))
    within = Window.partitionBy(*by, "_share")
    placed = shared.withColumns({"_all": F.sum("weight").over(within), "_first": F.min(F.col("_upto") - F.col("weight")).over(within)})
    middle = (F.col("_upto") - F.col("_first")) * 2 >= F.col("_all")
    return placed.groupBy(*by, "_share").agg(F.min(F.when(middle, F.col("v"))).alias("v"), F.first("_all").alias("weight")).drop("_share")


def summarise(df: DataFrame, value: str, by: list[str], size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """``by, v, weight``: a summary for each group of the cells' values; missing values have no weight.

    Blocks of cells are summarised first; a group holds its blocks' summaries, ``size`` values for each.
    """
    at = [F.floor(F.col(c) / block).cast("int").alias(b) for b, c in (("_jb", "j"), ("_ib", "i"))]
    cells = df.where(F.col(value).isNotNull()).select(*by, *at, F.col(value).cast("double").alias("v"), F.lit(1).cast("bigint").alias("weight"))
    return merge(_thinned(cells, [*by, "_jb", "_ib"], size), by, size)


def merge(summaries: DataFrame, by: list[str], size: int = SIZE) -> DataFrame:
    """Summaries of coarser groups from finer ones: the union of their values, thinned again."""
    return _thinned(summaries, by, size)


def quantiles(summaries: DataFrame, shares: list[float], by: list[str] | None = None) -> DataFrame:
    """``by, share, v``: the first value up to which that share of all weight lies, for each group, or for all rows."""
    by = by or []
    order = Window.partitionBy(*by or [F.lit(0)]).orderBy("v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*by or [F.lit(0)])
    ranked = summaries.select(*by, "v", F.sum("weight").over(order).alias("_upto"), F.sum("weight").over(whole).alias("_total"))
    asked = ranked.withColumn("share", F.explode(F.array(*map(F.lit, shares))))
    return asked.where(F.col("_upto") >= F.col("share") * F.col("_total")).groupBy(*by, "share").agg(F.min("v").alias("v"))


def rank_errors(df: DataFrame, value: str, limits: DataFrame) -> DataFrame:
    """``share, v, error``: how far the rank of each limit lies from what was asked, as part of all values; 0 where it lies among equal ones."""
    values = df.select(F.col(value).alias("_value")).where("_value IS NOT NULL")
    counts = values.crossJoin(F.broadcast(limits)).groupBy("share", "v").agg(  # a few rows of limits
        F.avg((F.col("_value") < F.col("v")).cast("double")).alias("_below"), F.avg((F.col("_value") <= F.col("v")).cast("double")).alias("_upto")
    )
    return counts.select("share", "v", F.greatest(F.col("_below") - F.col("share"), F.col("share") - F.col("_upto"), F.lit(0.0)).alias("error"))
