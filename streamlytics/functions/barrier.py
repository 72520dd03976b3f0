"""Evaluate an expression exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, expression: Column, name: str) -> DataFrame:
    """Add a column that is computed in one place, once per row.

    The optimizer copies an ordinary column's expression into every filter it pushes down and may
    drop or reorder an error it would raise. It does neither across an explode, here of one element.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))
