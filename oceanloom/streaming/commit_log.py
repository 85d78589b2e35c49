"""A metadata table that streams append to, with a log of what counts.

Data goes to folders that no reader looks at until a small file in the log names them.  That file appears whole or not at
all, and a name can be taken only once, so a batch that failed between its write and its entry is written again and counts
once, and a batch that runs again after its entry does nothing.  Compaction writes the rows of many folders anew and puts
one entry in the place of theirs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ROWS_PER_FILE = 1_000_000


class CommitLog:
    """The log in ``path/log`` of the folders in ``path/data``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def _entries(self) -> dict[str, dict]:
        if not self._fs.exists(self._at("log")):
            return {}
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at("log"))]
        if not any(n.endswith(".json") for n in names):
            return {}
        rows = self.spark.read.option("pathGlobFilter", "*.json").text(f"{self.path}/log", wholetext=True).collect()  # an entry for each batch since the last compaction
        return {e["name"]: e for e in (json.loads(r["value"]) for r in rows)}

    def commit(self, name: str, folder: str, replaces: list[str] | None = None) -> bool:
        """Whether this call made the entry; False if there is one of that name."""
        target = self._at(f"log/{name}.json")
        if self._fs.exists(target):
            return False
        draft = self._at(f"log/.{name}-{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps({"name": name, "folder": folder, "replaces": replaces or []}).encode()))
        out.close()
        try:
            made = not self._fs.exists(target) and self._fs.rename(draft, target)
        finally:
            if self._fs.exists(draft):
                self._fs.delete(draft, False)
        return bool(made)

    def has(self, name: str) -> bool:
        return self._fs.exists(self._at(f"log/{name}.json"))

    def counting(self) -> list[dict]:
        """The entries whose folders hold the table's rows now, in order of names."""
        entries = self._entries()
        gone = {r for e in entries.values() for r in e["replaces"]}
        return [e for n, e in sorted(entries.items()) if n not in gone]

    def append(self, df: DataFrame, name: str) -> bool:
        """Adds rows under a name, once: False, and nothing added, where the name is in the log."""
        if self.has(name):
            return False
        folder = f"data/{name}-{uuid.uuid4().hex}"
        df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{self.path}/{folder}")
        return self.commit(name, folder)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """All rows that count; a column that some folders lack is NULL there.  An empty table needs the schema."""
        folders = [f"{self.path}/{e['folder']}" for e in self.counting()]
        if not folders:
            return self.spark.createDataFrame([], schema or T.StructType([]))
        reader = self.spark.read.option("mergeSchema", "true")
        return (reader.schema(schema) if schema else reader).parquet(*folders)

    def compact(self, partitions: int = 1) -> bool:
        """Rewrites what counts now into files of ROWS_PER_FILE; batches that arrive meanwhile keep their own entries.

        Of two compactions at once one makes the entry; the other's folder is never read.
        """
        now = self.counting()
        if len(now) < 2:
            return False
        name = f"compaction-{sum(e['name'].startswith('compaction-') for e in self._entries().values()):08d}"
        folder = f"data/{name}-{uuid.uuid4().hex}"
        self.read().repartition(partitions).write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{self.path}/{folder}")
        return self.commit(name, folder, [e["name"] for e in now])

    def vacuum(self) -> int:
        """Deletes folders that don't count: replaced ones and what failed batches left.  Not beside running writers or readers."""
        kept = {e["folder"].split("/")[1] for e in self.counting()}
        old = [s.getPath() for s in self._fs.listStatus(self._at("data")) if s.getPath().getName() not in kept] if self._fs.exists(self._at("data")) else []
        for p in old:
            self._fs.delete(p, True)
        return len(old)


def write_stream(records: DataFrame, path: str, checkpoint: str, available_now: bool = True, compact_every: int = 0, before_commit: Callable[[int], None] | None = None):
    """Appends every micro-batch under the stream's own identity and the batch's number.

    The identity lies in the checkpoint, so a stream that starts again goes on with the same names.  With ``compact_every``
    the table is compacted after each so many batches.  ``before_commit`` is called between a batch's write and its entry.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        log = CommitLog(spark, path)
        name = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number:012d}"
        if log.has(name):
            return
        folder = f"data/{name}-{uuid.uuid4().hex}"
        batch.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{log.path}/{folder}")
        if before_commit:
            before_commit(number)
        log.commit(name, folder)
        if compact_every and (number + 1) % compact_every == 0:
            log.compact()

    writer = records.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
