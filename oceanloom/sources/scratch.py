"""A folder for what is written on the way, that all executors share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir.

    Where none is named, a folder in the warehouse; with a local master, as in tests, a temporary one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named:
            alone = re.fullmatch(r"local(\[[^-]*\])?", context.master)
            named = "file://" + tempfile.mkdtemp(prefix="checkpoint-") if alone else spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints"
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that was written under the shared one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
