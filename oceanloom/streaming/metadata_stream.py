"""A stream of metadata records to the append-only sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from oceanloom.sources import metadata


def write_stream(records: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append every micro-batch.  Batches are tagged by number; a batch that is run again after a failure replaces its own folder."""

    def one_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("maxRecordsPerFile", metadata.FLUSH_ROWS).parquet(f"{path}/batch={number}")

    writer = records.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
