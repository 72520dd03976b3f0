"""Bounded samples for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1 << 31


def hashed_sample(df: DataFrame, key: Column, n: int) -> DataFrame:
    """About ``n`` of the rows, or all if they are fewer: those whose hash of ``key`` is small.

    Rows of one key stay or go together. No partition sends more than its share anywhere, as a top-n would.
    """
    total = df.count()
    if total <= n:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(SCALE)) < int(SCALE * n / total))
