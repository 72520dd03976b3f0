"""Operators on the order of a key's records: count windows and first sightings."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.operators.running import Running, running


def average_every(df: DataFrame, key: str, value: str, order: Sequence[str], n: int = 3,
                  name: str = "avg") -> DataFrame:
    """Mean of every ``n`` consecutive values of a key; an incomplete rest gives nothing.

    Rows are numbered with the skew-safe running count, so a hot key is spread; each group that
    is averaged holds ``n`` rows.
    """
    numbered = running(df.select(key, value, *order), [key], order, [Running("__rn", "count")])
    group = F.floor((F.col("__rn") - 1) / n).cast("bigint").alias("grp")
    return (
        numbered.groupBy(key, group)
        .agg(F.count(F.lit(1)).alias("__n"), (F.sum(value) / F.lit(float(n))).alias(name))
        .filter(F.col("__n") == n)
        .select(key, "grp", name)
    )


def first_seen(df: DataFrame, identity: Sequence[str], order: Sequence[str], row_id: str,
               column: str = "nu") -> DataFrame:
    """Set ``column`` to 1 on the first row of each identity and leave the others as they are.

    First rows are found by pre-aggregating minima and matched back by ``row_id``, which is
    unique, so a device with most of the traffic does not meet in one task. ``order`` holds integral columns, nulls
    first. A target column the input lacks starts at 0.
    """
    # The least value of the first order column per identity, from which tasks send one row each; only the rows that
    # have it go on to the other columns. All are minima of single numbers, so nothing has to be sorted.
    places = [f"__o{i}" for i in range(len(order))]
    rows = df.select(*identity, F.col(row_id).alias("__id"), *[
        F.coalesce(F.col(c).cast("bigint"), F.lit(-(1 << 63))).alias(p) for c, p in zip(order, places)])
    least = rows.groupBy(*identity).agg(F.min(places[0]).alias(places[0]))
    same = functools.reduce(Column.__and__, [F.col(f"r.{c}").eqNullSafe(F.col(f"l.{c}")) for c in (*identity, places[0])])
    firsts = rows.alias("r").join(least.alias("l"), same, "left_semi")
    for i in reversed(range(1, len(places) + 1)):
        firsts = firsts.groupBy(*identity, *places[:i]).agg(
            (F.min("__id") if i == len(places) else F.min_by("__id", places[i])).alias("__id"))
    firsts = firsts.select(F.col("__id").alias(row_id), F.lit(True).alias("__new"))
    current = F.col(column) if column in df.columns else F.lit(0)
    return (
        df.join(firsts, row_id, "left")
        .withColumn(column, F.when(F.col("__new"), 1).otherwise(current).cast("int"))
        .drop("__new")
    )
