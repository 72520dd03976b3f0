"""Where rows go: chosen partitions, hash exchange, parallelism."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_id(column: str, routes: dict[str, int], default: int) -> Column:
    """Partition number of a value: its entry in ``routes``, or ``default``."""
    target = F.lit(default)
    for value, partition in routes.items():
        target = F.when(F.col(column).eqNullSafe(F.lit(value)), partition).otherwise(target)
    return target.cast("int")


def route(df: DataFrame, column: str, routes: dict[str, int], default: int, partitions: int) -> DataFrame:
    """Send each row to exactly the partition its value is routed to."""
    return df.repartitionById(partitions, route_id(column, routes, default))


def hash_exchange(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Rows with equal keys into the same partition."""
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def set_parallelism(df: DataFrame, tasks: int, shuffle: bool = True) -> DataFrame:
    """Run what follows in ``tasks`` tasks; without ``shuffle`` partitions are only merged."""
    return df.repartition(tasks) if shuffle else df.coalesce(tasks)
