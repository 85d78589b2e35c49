"""Cells stored by blocks: Parquet with the face and the block's row and column as partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oceanloom.schema import nan_to_null

BLOCK = 720
#: Blocks of a grid, each of which costs a folder or a call to Python; where there would be more, blocks are larger.
MOST_BLOCKS = 2048


def side_for(cells: DataFrame, least: int, most: int | None = None) -> int:
    """The side of a grid's blocks: ``least``, doubled until there are at most so many blocks, or they have BLOCK cells along a side."""
    faces = cells.groupBy("face").agg((F.max("j") + 1).alias("nj"), (F.max("i") + 1).alias("ni")).collect()  # a row for each face
    side, most = least, most or MOST_BLOCKS
    while side < BLOCK and sum(-(-r["nj"] // side) * -(-r["ni"] // side) for r in faces) > most:
        side = min(2 * side, BLOCK)
    return side


def write_blocks(df: DataFrame, path: str, block: int = BLOCK, mode: str = "overwrite") -> None:
    """One folder for each face and block of ``block x block`` cells, in order of rows; a task holds blocks, never a face."""
    placed = df.withColumns({b: F.floor(F.col(c) / block).cast("int") for b, c in (("jb", "j"), ("ib", "i"))})
    placed.repartition("face", "jb", "ib").sortWithinPartitions("face", "jb", "ib", "j", "i").write.mode(mode).partitionBy("face", "jb", "ib").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The cells with ``jb, ib``: joins on these and the face read only the blocks that the other side names."""
    return nan_to_null(spark.read.parquet(path))
