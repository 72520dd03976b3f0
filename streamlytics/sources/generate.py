"""Synthetic access logs, as a live stream and as its repeatable batch twin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _pick(domains: Sequence[str], unit: Column) -> Column:
    """Choose a domain with a number in [0, 1)."""
    names = F.array(*[F.lit(d) for d in domains])
    return F.element_at(names, (F.floor(unit * len(domains)) + 1).cast("int"))


def access_stream(
    spark: SparkSession, domains: Sequence[str], time: int, base: float, tasks: int = 1, seed: int = 7
) -> DataFrame:
    """Two rows a second from each of ``tasks`` generator tasks, all at one ``time``, with traffic from ``base`` on."""
    ticks = (
        spark.readStream.format("rate")
        .option("rowsPerSecond", 2 * tasks)
        .option("numPartitions", tasks)
        .load()
    )
    return ticks.select(
        F.lit(time).cast("bigint").alias("time"),
        _pick(domains, F.rand(seed)).alias("domain"),
        (F.rand(seed + 1) + base).alias("traffic"),
    )


def access_rows(
    spark: SparkSession, n: int, domains: Sequence[str], time: int, base: float, tasks: int | None = None
) -> DataFrame:
    """``n`` rows whose values are hashes of the row number, so a recomputed task repeats them."""

    def unit(salt: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1_000_000)) / 1_000_000

    return spark.range(0, n, 1, tasks).select(
        F.lit(time).cast("bigint").alias("time"),
        _pick(domains, unit(1)).alias("domain"),
        (unit(2) + base).alias("traffic"),
    )
