"""The data behind face mosaics and per-face pictures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oceanloom.operators.stats import log_magnitude, log_range

# Fixed values: (row, column) of faces 0 to 12 in the 5 x 5 mosaic.
FACE_SLOTS = [(4, 0), (3, 0), (2, 0), (4, 1), (3, 1), (2, 1), (1, 1), (1, 2), (1, 3), (1, 4), (0, 2), (0, 3), (0, 4)]


def layout(spark: SparkSession) -> DataFrame:
    rows = [(face, row, col, row * 5 + col) for face, (row, col) in enumerate(FACE_SLOTS)]
    return spark.createDataFrame(rows, "face INT, slot_row INT, slot_col INT, slot INT")


def place(df: DataFrame) -> DataFrame:
    """Adds the mosaic slot; faces without one are not shown."""
    return df.join(F.broadcast(layout(df.sparkSession)), "face")


def colour_range(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.min(value).alias("vmin"), F.max(value).alias("vmax"))


def log_mosaic(df: DataFrame, value: str) -> DataFrame:
    """``face, j, i, slot, log_v, vmin, vmax``: log magnitude with its colour range, zeros missing."""
    limits = log_range(df, value)
    placed = place(df.select("face", "j", "i", log_magnitude(value).alias("log_v")))
    return placed.join(F.broadcast(limits), F.lit(True), "left").select("face", "j", "i", "slot", "log_v", "vmin", "vmax")


def face_slice(df: DataFrame, face: int, *values: str) -> DataFrame:
    return df.where(F.col("face") == face).select("face", "j", "i", *values)


def two_variables(left: DataFrame, right: DataFrame, face: int, left_value: str, right_value: str) -> DataFrame:
    a = face_slice(left, face, F.col(left_value).alias("left_v"))
    b = face_slice(right, face, F.col(right_value).alias("right_v"))
    return a.join(b, ["face", "j", "i"], "full_outer")
