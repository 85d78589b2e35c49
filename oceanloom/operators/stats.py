"""Quantiles, histograms, probability tables, ranges and sizes.

Global figures come from one aggregate that is broadcast back (one row, or one
row per face); no window runs over all cells.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oceanloom.sources.scratch import remove, shared_folder

BINS, Q_LOW, Q_HIGH = 200, 0.001, 0.999
LOG_RANGE = (0.01, 0.99)


#: Accuracy of the sketch that brackets a rank, bins of one narrowing pass, and values that are fetched at the end.
SKETCH, NARROWING, FETCHED = 10_000, 4_096, 20_000


def quantiles(df: DataFrame, value: str, low: float, high: float, approximate: bool = False) -> DataFrame:
    """``vmin, vmax``: exact, linearly interpolated; approximate only if asked for.

    Exact ones are found when this is called, in two passes or a few more: see ``values_at``.
    """
    if approximate:
        q = df.agg(F.percentile_approx(value, F.array(F.lit(low), F.lit(high)), F.lit(SKETCH)).alias("q"))
        return q.select(F.col("q")[0].cast("double").alias("vmin"), F.col("q")[1].cast("double").alias("vmax"))
    return df.sparkSession.createDataFrame([tuple(values_at(df, value, [low, high]))], "vmin DOUBLE, vmax DOUBLE")


def values_at(df: DataFrame, value: str, shares: list[float]) -> list[float | None]:
    """Exact quantiles without a table of all values in one task.

    A sketch brackets each quantile; a second pass counts what lies below each bracket and groups what lies within.  Where that is
    more than FETCHED values, histograms between the bracket's ends narrow it until it is less, or one value.
    """
    folder = f"{shared_folder(df.sparkSession)}/values-{uuid.uuid4().hex}"
    try:
        df.select(F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL").write.parquet(folder)  # each pass reads this one column
        return _values_at(df.sparkSession.read.schema("_v DOUBLE").parquet(folder), shares)
    finally:
        remove(df.sparkSession, folder)


def _values_at(v: DataFrame, shares: list[float]) -> list[float | None]:
    wide = 2.0 / SKETCH
    edges = [e for s in shares for e in (max(s - wide, 0.0), min(s + wide, 1.0))]
    first = v.agg(F.percentile_approx("_v", F.array(*map(F.lit, edges)), F.lit(SKETCH)).alias("q"), F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).first()
    if not first["n"]:
        return [None] * len(shares)
    found: dict[int, float] = {}
    for k, share in enumerate(shares):
        at = share * (first["n"] - 1)
        for rank in sorted({int(at), min(int(at) + 1, first["n"] - 1)}):
            if rank not in found:
                found[rank] = _value_at_rank(v, rank, first["q"][2 * k], first["q"][2 * k + 1], first["lo"], first["hi"], found)
    out = []
    for share in shares:
        at = share * (first["n"] - 1)
        below = int(at)
        above = min(below + 1, first["n"] - 1)
        out.append(found[below] + (at - below) * (found[above] - found[below]))
    return out


def value_at_rank(v: DataFrame, rank: int) -> float:
    """The value of ``_v`` with that many others before it; ``v`` is read several times."""
    n, lo, hi = v.agg(F.count("*"), F.min("_v"), F.max("_v")).first()
    wide = 2.0 / SKETCH
    low, high = v.agg(F.percentile_approx("_v", F.array(F.lit(max(rank / n - wide, 0.0)), F.lit(min(rank / n + wide, 1.0))), F.lit(SKETCH)).alias("q")).first()["q"]
    return _value_at_rank(v, rank, low, high, lo, hi, {})


def _value_at_rank(v: DataFrame, rank: int, lo: float, hi: float, least: float, most: float, found: dict[int, float]) -> float:
    """The value of that rank, from 0.  ``found`` also gets the other ranks that the same pass shows."""
    while True:
        inside = F.col("_v").between(lo, hi)
        rows = v.where(F.col("_v") <= hi).groupBy(F.when(inside, F.col("_v")).alias("x")).agg(F.count("*").alias("n")).limit(FETCHED + 2).collect()
        if len(rows) <= FETCHED + 1:
            upto = sum(r["n"] for r in rows if r["x"] is None)
            if rank < upto:  # the sketch's bracket lay too high
                lo, hi = least, lo
                continue
            for r in sorted((r for r in rows if r["x"] is not None), key=lambda r: r["x"]):
                if upto <= rank + 1 < upto + r["n"]:
                    found[rank + 1] = r["x"]
                if upto <= rank < upto + r["n"]:
                    answer = r["x"]
                upto += r["n"]
            if rank >= upto:  # or too low
                lo, hi = hi, most
                continue
            return answer
        bin_of = F.least(F.floor((F.col("_v") - lo) / (hi - lo) * NARROWING), F.lit(NARROWING - 1))
        bins = v.where(F.col("_v") <= hi).groupBy(F.when(inside, bin_of).alias("b")).agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).collect()
        upto = sum(r["n"] for r in bins if r["b"] is None)
        if rank < upto:
            lo, hi = least, lo
            continue
        for r in sorted((r for r in bins if r["b"] is not None), key=lambda r: r["b"]):
            if rank < upto + r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            upto += r["n"]
        else:
            lo, hi = hi, most


def log_magnitude(value: Column | str) -> Column:
    """log10 of the magnitude; NULL where the value is 0 or missing."""
    v = F.abs(F.col(value) if isinstance(value, str) else value)
    return F.when(v > 0, F.log10(v))


def log_range(df: DataFrame, value: str, low: float = LOG_RANGE[0], high: float = LOG_RANGE[1], approximate: bool = False) -> DataFrame:
    return quantiles(df.select(log_magnitude(value).alias("_log")), "_log", low, high, approximate)


def widened(limits: DataFrame) -> DataFrame:
    """Limits that coincide become half a unit wider on both sides."""
    flat = F.col("vmin") == F.col("vmax")
    return limits.select(F.when(flat, F.col("vmin") - 0.5).otherwise(F.col("vmin")).alias("vmin"), F.when(flat, F.col("vmax") + 0.5).otherwise(F.col("vmax")).alias("vmax"))


def histogram(df: DataFrame, value: str, limits: DataFrame, bins: int) -> DataFrame:
    """``bin, lo, hi, n`` of equal width between the one row of ``limits``; the last bin is closed on both sides."""
    spark = df.sparkSession
    limits = widened(limits)
    v, lo, hi = F.col(value), F.col("vmin"), F.col("vmax")
    bin_of = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counts = df.where(v.isNotNull()).select(value).join(F.broadcast(limits), (v >= lo) & (v <= hi)).groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    every = spark.range(0, bins, 1, 1).select(F.col("id").cast("int").alias("bin")).join(F.broadcast(limits), hi.isNotNull())
    width = (hi - lo) / bins
    edges = every.select("bin", (lo + F.col("bin") * width).alias("lo"), F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * width).alias("hi"))
    return edges.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def clip(value: Column, lo: Column, hi: Column) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, lo), hi))


def probability_table(df: DataFrame, value: str, bins: int = BINS, q_low: float = Q_LOW, q_high: float = Q_HIGH, approximate: bool = False) -> DataFrame:
    """``bin, lo, hi, n, pdf, cdf`` of the values clipped to two quantiles; the tails gather in the end bins."""
    limits = quantiles(df, value, q_low, q_high, approximate)
    clipped = df.select(value).join(F.broadcast(limits), F.col("vmin").isNotNull()).select(clip(F.col(value), F.col("vmin"), F.col("vmax")).alias(value))
    table = histogram(clipped, value, limits, bins)
    # Windows over the bins only: at most ``bins`` rows.
    order = Window.partitionBy(F.lit(0)).orderBy("bin")
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return table.withColumn("pdf", F.try_divide(F.col("n").cast("double"), total)).withColumn("cdf", F.try_divide(F.sum("n").over(order).cast("double"), total))


def density_histogram(df: DataFrame, value: Column, bins: int = BINS) -> DataFrame:
    """``bin, lo, hi, n, density`` over the whole range of the non-missing values."""
    x = df.select(value.alias("_v")).where("_v IS NOT NULL")
    limits = x.agg(F.min("_v").alias("vmin"), F.max("_v").alias("vmax"))
    table = histogram(x, "_v", limits, bins)
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return table.withColumn("density", F.try_divide(F.col("n").cast("double"), total * (F.col("hi") - F.col("lo"))))


def magnitude_density(df: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    return density_histogram(df, F.when(F.abs(F.col(value)) > 0, F.abs(F.col(value))), bins)


def log_magnitude_density(df: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    return density_histogram(df, log_magnitude(value), bins)


def face_range(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy("face").agg(F.min(value).alias("vmin"), F.max(value).alias("vmax"), F.count(value).alias("n"))


def face_spacing_km(grid: DataFrame) -> DataFrame:
    """Mean cell spacing of a whole face, in km."""
    return grid.groupBy("face").agg((F.avg("dxc") / 1000.0).alias("dx_km"), (F.avg("dyc") / 1000.0).alias("dy_km"))


_WIDTHS = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8}


def size_bytes(df: DataFrame) -> DataFrame:
    """``rows, bytes``: rows times the widths of the fixed-width columns, as dense arrays would take."""
    width = sum(_WIDTHS.get(type(f.dataType), 0) for f in df.schema)
    return df.agg(F.count("*").alias("rows")).withColumn("bytes", F.col("rows") * F.lit(width))
