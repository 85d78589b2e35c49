"""Weighted, uniform and bin-wise sampling, and the tolerance match.

All draws come from ``functions.hashing.uniform``, so a sample depends on the
rows and the seed only.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oceanloom.functions.hashing import gumbel, uniform
from oceanloom.operators.stats import histogram, probability_table, quantiles, value_at_rank
from oceanloom.sources.scratch import remove, shared_folder

SLICES = 1024
#: Samples that one task may put in order.
SORTED_TOGETHER = 100_000


def weighted_sample(df: DataFrame, n: int, bias: float | Column, value: str = "v", keep: Column | None = None, seed: int = 0, strict: bool = True, together: int = SORTED_TOGETHER) -> DataFrame:
    """``sample_rank, face, j, i``: n cells without replacement, chance proportional to ``exp(bias * (v - min v))``.

    Gumbel top-k in log space: no normalising sum, no overflow.  More than ``together`` are chosen by the n-th largest key.  With ``strict`` too few cells raise ``ValueError``.
    A scalar bias needs no minimum (it shifts all keys alike); a Column does.
    """
    valid = df.where(F.col(value).isNotNull() & (F.coalesce(keep, F.lit(False)) if keep is not None else F.lit(True)))
    if strict and (have := valid.limit(n).count()) < n:
        raise ValueError(f"{n} samples asked for, {have} cells valid")
    keyed = _gumbel_keys(valid, bias, value, seed)
    if n > together:
        return _largest(keyed, n, together)
    top = keyed.orderBy(F.desc("_key"), "face", "j", "i").limit(n)
    rank = F.row_number().over(Window.orderBy(F.desc("_key"), "face", "j", "i"))  # over n rows
    return top.select(rank.alias("sample_rank"), "face", "j", "i")


def _gumbel_keys(valid: DataFrame, bias: float | Column, value: str, seed: int) -> DataFrame:
    u = uniform("face", "j", "i", seed)
    if isinstance(bias, Column):
        valid = valid.join(F.broadcast(valid.agg(F.min(value).alias("_least"))), F.lit(True))
        log_weight = bias * (F.col(value) - F.col("_least"))
    else:
        log_weight = F.lit(float(bias)) * F.col(value)
    return valid.select("face", "j", "i", (log_weight + gumbel(u)).alias("_key"))


def _largest(keyed: DataFrame, n: int, together: int) -> DataFrame:
    """``sample_rank, face, j, i`` of the n largest keys, without a task that holds them all.

    The n-th largest key is found by counting, and a filter keeps what lies above it; among keys equal to it the first cells
    fill up.  Ranks are places within ranges of keys, and the sizes of the ranges before.
    """
    spark = keyed.sparkSession
    folder = f"{shared_folder(spark)}/sample-{uuid.uuid4().hex}"
    try:
        keyed.write.parquet(f"{folder}/keys")
        keys = spark.read.schema(keyed.schema).parquet(f"{folder}/keys")
        have = keys.count()
        kept = keys
        if have > n:
            edge = value_at_rank(keys.select(F.col("_key").alias("_v")), have - n)
            above = keys.where(F.col("_key") > edge)
            equal = keys.where(F.col("_key") == edge).orderBy("face", "j", "i").limit(n - above.count())
            kept = above.unionByName(equal)
        parts = max(2, math.ceil(min(n, have) / together))
        kept.repartitionByRange(parts, F.desc("_key"), "face", "j", "i").withColumn("_part", F.spark_partition_id()).write.parquet(f"{folder}/parts")
        placed = spark.read.schema("face INT, j INT, i INT, _key DOUBLE, _part INT").parquet(f"{folder}/parts")
        sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each part
        before = sizes.select("_part", (F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_n")).alias("_before"))
        own = F.row_number().over(Window.partitionBy("_part").orderBy(F.desc("_key"), "face", "j", "i"))
        return placed.withColumn("_own", own).join(F.broadcast(before), "_part").select((F.col("_own") + F.col("_before")).cast("int").alias("sample_rank"), "face", "j", "i").checkpoint()
    finally:
        remove(spark, folder)


def weights(df: DataFrame, bias: float, value: str = "v") -> DataFrame:
    """The normalised chances themselves, for reports."""
    least = df.agg(F.min(value).alias("_least"))
    w = df.where(F.col(value).isNotNull()).join(F.broadcast(least), F.lit(True)).withColumn("w", F.exp(F.lit(bias) * (F.col(value) - F.col("_least")))).drop("_least")
    return w.join(F.broadcast(w.agg(F.sum("w").alias("_total"))), F.lit(True)).withColumn("p", F.col("w") / F.col("_total")).drop("_total")


def uniform_sample(df: DataFrame, n: int, *key: str, seed: int = 0) -> DataFrame:
    u = uniform(*key, seed)
    return df.withColumn("_u", u).orderBy("_u", *key).limit(n).drop("_u")


def linear_bin_counts(spark: SparkSession, n: int, bins: int, least: int, growth: float) -> DataFrame:
    """``bin, n``: ``least`` each, the rest in proportion to weights that grow linearly from 1 to ``growth``, cut toward zero."""
    w = [1.0 + (growth - 1.0) * k / max(bins - 1, 1) for k in range(bins)]
    rest, total = n - least * bins, math.fsum(w)
    return spark.createDataFrame([(k, least + int(rest * (x / total))) for k, x in enumerate(w)], "bin INT, n INT")


def linear_sample(edges: DataFrame, n: int, bins: int, least: int, growth: float, seed: int = 0) -> DataFrame:
    """``bin, draw, v``: uniform draws in each bin of ``edges(bin, lo, hi)``."""
    counts = linear_bin_counts(edges.sparkSession, n, bins, least, growth).where("n > 0")
    drawn = counts.join(edges.select("bin", "lo", "hi"), "bin").select("bin", "lo", "hi", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("draw"))
    return drawn.select("bin", "draw", (F.col("lo") + uniform("bin", "draw", seed) * (F.col("hi") - F.col("lo"))).alias("v"))


def inverse_transform_sample(table: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``draw, bin, v``: the first bin whose cdf reaches u1 (the last, if rounding leaves none), then uniform inside it.

    Bins and draws meet by the slice of u1 that they lie in, so a draw looks at the few bins of its slice.
    """
    spark = table.sparkSession
    order = Window.partitionBy(F.lit(0)).orderBy("bin")
    bins = table.select("bin", "lo", "hi", F.coalesce(F.lag("cdf").over(order), F.lit(-1.0)).alias("below"), F.when(F.lead("bin").over(order).isNull(), F.lit(2.0)).otherwise(F.col("cdf")).alias("upto"))
    draws = spark.range(n).select(F.col("id").alias("draw"), uniform(F.col("id"), 1, seed).alias("u1"), uniform(F.col("id"), 2, seed).alias("u2"))
    slice_of = lambda x: F.floor(F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)) * SLICES)
    sliced = bins.where("below < upto").withColumn("slice", F.explode(F.sequence(slice_of(F.col("below")), slice_of(F.col("upto")))))
    # At most SLICES and twice the number of bins rows.
    hit = draws.withColumn("slice", slice_of(F.col("u1"))).join(F.broadcast(sliced), "slice").where((F.col("u1") > F.col("below")) & (F.col("u1") <= F.col("upto")))
    return hit.select("draw", "bin", (F.col("lo") + F.col("u2") * (F.col("hi") - F.col("lo"))).alias("v"))


def sample_on_pdf(df: DataFrame, value: str, n: int, pool: int = 1000, bins: int = 10, growth: float = 100.0, seed: int = 0) -> DataFrame:
    """``bin, draw, v``: n of a pool drawn more densely toward high values."""
    have = sum(r["n"] for r in linear_bin_counts(df.sparkSession, pool, bins, 0, growth).collect())  # ``bins`` rows
    if n > have:
        raise ValueError(f"{n} samples asked for, the pool has {have}")
    edges = probability_table(df, value, bins)
    return uniform_sample(linear_sample(edges, pool, bins, 0, growth, seed), n, "bin", "draw", seed=seed + 1)


def first_match(df: DataFrame, samples: DataFrame, value: str, order: str, tolerance: float) -> DataFrame:
    """For each row of ``samples(sample_id, s)`` the first row, by ``order``, with ``abs(value - s) < tolerance``; NULL where none.

    Values go to buckets as wide as the tolerance, and each sample looks in those beside its own: an equi-join instead of a nested
    loop.  Buckets are doubles, which don't overflow; a quotient may round to the next one, so two on either side are looked in.
    Equal values count as the first of them, and equal samples look once, so copies of either make no pairs.
    """
    if tolerance <= 0:
        raise ValueError("tolerance must be above 0")
    bucket = lambda x: F.rint(x / F.lit(float(tolerance)))
    asked = samples.select("s").distinct().select("s", F.explode(F.array_distinct(F.array(*[bucket(F.col("s")) + float(d) for d in (-2, -1, 0, 1, 2)]))).alias("_b"))
    firsts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.min(order).alias("_order"))
    held = firsts.select("_order", "_v", bucket(F.col("_v")).alias("_b"))
    best = asked.join(held, "_b").where(F.abs(F.col("_v") - F.col("s")) < tolerance).groupBy("s").agg(F.min("_order").alias("match"))
    return samples.select("sample_id", "s").join(best, "s", "left").select("sample_id", "s", "match")


__all__ = ["first_match", "histogram", "inverse_transform_sample", "linear_bin_counts", "linear_sample", "quantiles", "sample_on_pdf", "uniform_sample", "weighted_sample", "weights"]
