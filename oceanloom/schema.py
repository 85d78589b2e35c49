"""Declared schemas, key columns and the NaN to NULL rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL_KEY = ("face", "j", "i")
STATE_VARIABLES = ("eta", "u", "v", "w", "theta", "salt")
SURFACE_FLUX_VARIABLES = ("kpphbl", "phibot", "ocetaux", "ocetauy", "siarea")
GEOMETRY_VARIABLES = ("xc", "yc", "dxc", "dyc", "dxg", "dyg", "raz", "ra", "depth", "hfacc", "sn", "cs")

_KEY = [T.StructField(c, T.IntegerType(), False) for c in CELL_KEY]


def _doubles(names: tuple[str, ...]) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType(), True) for n in names]


SNAPSHOT_SCHEMA = T.StructType([T.StructField("iter", T.LongType(), False), *_KEY, *_doubles(STATE_VARIABLES)])
FLUX_SCHEMA = T.StructType([T.StructField("iter", T.LongType(), False), *_KEY, *_doubles(SURFACE_FLUX_VARIABLES)])
GRID_SCHEMA = T.StructType([*_KEY, *_doubles(GEOMETRY_VARIABLES)])
SAMPLE_SCHEMA = T.StructType([T.StructField("sample_id", T.LongType(), False), *_KEY])
PATCH_SCHEMA = T.StructType(
    [T.StructField("sample_id", T.LongType(), False), T.StructField("face", T.IntegerType(), False)]
    + [T.StructField(c, T.IntegerType(), True) for c in ("i_start", "i_end", "j_start", "j_end")]
    + _doubles(("real_km_w", "real_km_h"))
    + [T.StructField("status", T.StringType(), False)]
)
PIXEL_SCHEMA = T.StructType(
    [T.StructField("sample_id", T.LongType(), False)]
    + [T.StructField(c, T.IntegerType(), False) for c in ("channel", "y", "x")]
    + [T.StructField("v", T.FloatType(), True)]
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float and double column, leaving the rest untouched."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in floats}) if floats else df


def missing_columns(df: DataFrame, wanted: T.StructType) -> list[str]:
    """Names that ``wanted`` declares and ``df`` lacks."""
    have = {c.lower() for c in df.columns}
    return [f.name for f in wanted if f.name.lower() not in have]
