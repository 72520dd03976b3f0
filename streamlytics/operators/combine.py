"""Putting streams together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.functions.text import tokenize


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union of same-typed inputs: duplicates stay, and uniting a stream with itself doubles it."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def connect_map(left: DataFrame, right: DataFrame, left_map: Sequence[Column],
                right_map: Sequence[Column]) -> DataFrame:
    """Two inputs of different types, each projected to the common output type."""
    return union_all(left.select(*left_map), right.select(*right_map))


def connect_flat_map(left: DataFrame, right: DataFrame, left_sep: str = " ", right_sep: str = ",") -> DataFrame:
    """Two line inputs, each split by its own separator, as one column of words."""
    return union_all(
        tokenize(left, left_sep, normalise=False), tokenize(right, right_sep, normalise=False)
    )


def tagged(df: DataFrame, tag: str, name: str = "tag") -> DataFrame:
    """Mark every row with its origin."""
    return df.select(F.lit(tag).alias(name), "*")
