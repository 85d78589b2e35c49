"""Reproducible random numbers: a hash of the row's own key, so that neither partitioning nor retries change a draw."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(*key: Column | str | int) -> Column:
    """A number in (0, 1) from the first 32 bits of the md5 of ``key[0]:key[1]:...``."""
    parts = [F.col(k) if isinstance(k, str) else k if isinstance(k, Column) else F.lit(k) for k in key]
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(4294967296.0)


def gumbel(u: Column) -> Column:
    return -F.log(-F.log(u))
