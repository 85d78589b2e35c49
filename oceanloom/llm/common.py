"""Reading tables, bounding Arrow batches and cutting lineage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oceanloom.sources.scratch import remove, shared_folder

ROWS_PER_BATCH = 256

__all__ = ["cut", "id_and_text", "join_to_rows", "remove", "settings", "shared_folder", "small_batches", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, null text as empty: other columns can't clash with what an operator adds."""
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def small_batches(spark: SparkSession) -> None:
    """Few rows in each Arrow batch, so that long texts don't meet in one."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def cut(df: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: A key that more than one of so many rows have is joined from a broadcast table; fewer keys than this can be.
KEY_SHARE = 1 << 12


def join_to_rows(rows: DataFrame, per_key: DataFrame, key: str, count: str, columns: list[str]) -> DataFrame:
    """The rows, left-joined to a frame of one row for each key, which says in ``count`` how many rows have it.

    Keys of very many rows come from a broadcast table, which their share of all rows bounds; the rest is shuffled, with no
    key that large.  ``per_key`` is read three times.
    """
    total = per_key.agg(F.coalesce(F.sum(count), F.lit(0)).alias("n")).first()["n"]
    is_hot = F.col(count) * KEY_SHARE > total
    hot = per_key.where(is_hot).select(key, F.lit(True).alias("_hot"), *(F.col(c).alias(f"_hot_{c}") for c in columns))
    cold = per_key.where(~is_hot).select(F.col(key).alias("_key"), *(F.col(c).alias(f"_cold_{c}") for c in columns))
    met = rows.join(F.broadcast(hot), key, "left")
    # Rows that have met a hot key need no other; they and rows without a key are dealt out by what they hold.
    elsewhere = F.encode(F.concat(F.lit("row:"), F.xxhash64(*rows.columns).cast("string")), "utf-8")
    own = F.when(F.col("_hot") | F.col(key).isNull(), elsewhere).otherwise(F.col(key))
    joined = met.withColumn("_own", own).join(cold, F.col("_own") == F.col("_key"), "left")
    return joined.select(*rows.columns, *(F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c) for c in columns))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Within this, the session has these settings."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
