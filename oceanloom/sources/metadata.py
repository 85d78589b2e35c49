"""The patch-metadata sink: appended Parquet whose columns may differ from batch to batch."""

from __future__ import annotations

import datetime
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

log = logging.getLogger(__name__)
FLUSH_ROWS = 10_000


def append(df: DataFrame, path: str, rows_per_file: int = FLUSH_ROWS) -> None:
    """Add rows.  Nothing already written is read or rewritten."""
    df.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows so far; a column that a batch lacked is NULL there."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def union(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def _kind(values: list) -> T.DataType:
    """One type for all values that are there: numbers are doubles, so that flushes agree; what differs otherwise becomes text."""
    kinds = {bool if isinstance(v, bool) else float if isinstance(v, (int, float)) else type(v) for v in values if v is not None}
    known = {bool: T.BooleanType(), float: T.DoubleType(), bytes: T.BinaryType(), datetime.date: T.DateType(), datetime.datetime: T.TimestampType()}
    return known.get(kinds.pop(), T.StringType()) if len(kinds) == 1 else T.StringType()


class MetadataWriter:
    """Buffers dict records on the driver and appends ``flush_every`` at a time; for hand-made records, not for frames.

    With a schema the records are written by it; keys that it lacks are an error.  Without one, numbers are written as doubles, and
    a key without a value in a whole flush is left out of that flush: ``read`` gives NULL there.
    """

    def __init__(self, spark: SparkSession, path: str, flush_every: int = FLUSH_ROWS, schema: T.StructType | None = None):
        self.spark, self.path, self.flush_every, self.schema, self._rows = spark, path, flush_every, schema, []

    def add(self, record: dict) -> None:
        self._rows.append(dict(record))
        if len(self._rows) >= self.flush_every:
            self.flush()

    def flush(self) -> None:
        if self._rows:
            append(self.spark.createDataFrame(*self._typed()), self.path, self.flush_every)
            log.info("%d records appended to %s", len(self._rows), self.path)
            self._rows = []

    def _typed(self) -> tuple[list[tuple], T.StructType]:
        names = list(dict.fromkeys(k for r in self._rows for k in r))
        if self.schema is not None:
            if unknown := set(names) - set(self.schema.fieldNames()):
                raise ValueError(f"keys that the schema lacks: {sorted(unknown)}")
            return [tuple(r.get(k) for k in self.schema.fieldNames()) for r in self._rows], self.schema
        columns = {k: [r.get(k) for r in self._rows] for k in names}
        kept = {k: v for k, v in columns.items() if any(x is not None for x in v)} or {k: v for k, v in list(columns.items())[:1]}
        schema = T.StructType([T.StructField(k, _kind(v)) for k, v in kept.items()])
        cast = {T.DoubleType(): float, T.StringType(): str}
        cells = [[x if x is None else cast.get(f.dataType, lambda x: x)(x) for x in kept[f.name]] for f in schema]
        return list(zip(*cells, strict=True)), schema

    def close(self) -> None:
        self.flush()

    def __enter__(self) -> MetadataWriter:
        return self

    def __exit__(self, *_) -> None:
        self.close()
