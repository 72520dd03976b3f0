"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, groups: Sequence[str], by: str, ties: Sequence[str], n: int = 3,
          rank: str = "rank") -> DataFrame:
    """The ``n`` rows with the largest ``by`` in each group, ``ties`` ascending, ranked from 1.

    The rank filter sits right on the window, so each task keeps at most ``n`` rows per group
    before the shuffle, however many a group has.
    """
    order = Window.partitionBy(*groups).orderBy(F.desc(by), *[F.asc(t) for t in ties])
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= n)


def top_lists(ranked: DataFrame, groups: Sequence[str], columns: Sequence[str], rank: str = "rank",
              name: str = "top") -> DataFrame:
    """One row per group with its ranked rows as an array. Input must already be cut by :func:`top_n`."""
    items = F.array_sort(F.collect_list(F.struct(rank, *columns)))
    return ranked.groupBy(*groups).agg(items.alias(name))
