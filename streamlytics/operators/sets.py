"""Compressed sets of 64-bit numbers: two levels, the lower one an array or a bitmap, whichever is shorter.

A number's upper bits name its container, its lower 15 bits its place there. A container of up to ``MOST`` numbers is a
sorted array of two bytes each, a fuller one a bitmap of 4 KB; so scattered (hashed) numbers cost some bytes each and
dense ones a bit. Containers are rows ``(keys, high, n, entries, bits)``, so a hot key is spread over its containers, and
sets are merged container by container.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACES = 15  # bits of a container
MOST = 2048  # numbers of an array, which then takes what a bitmap takes


def _built(numbers: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """Containers of distinct ``(keys, high, low)``."""
    whole = Window.partitionBy(*keys, "high")
    sized = numbers.withColumn("n", F.count(F.lit(1)).over(whole))
    few = F.col("n") <= most
    made = sized.groupBy(*keys, "high", "n").agg(
        F.sort_array(F.collect_list(F.when(few, F.col("low").cast("smallint")))).alias("entries"),
        F.bitmap_construct_agg(F.when(~few, F.col("low").cast("bigint"))).alias("bits"))
    return made.select(*keys, "high", F.col("n").cast("bigint").alias("n"), F.when(few, F.col("entries")).alias("entries"),
                       F.when(~few, F.col("bits")).alias("bits"))


def containers(df: DataFrame, keys: Sequence[str], number: str | Column, most: int = MOST) -> DataFrame:
    """The set of the numbers of each key; null is no number."""
    number = (F.col(number) if isinstance(number, str) else number).cast("bigint")
    split = df.select(*keys, number.alias("__x")).filter("__x IS NOT NULL").select(
        *keys, F.shiftright("__x", PLACES).alias("high"), F.col("__x").bitwiseAND((1 << PLACES) - 1).cast("int").alias("low"))
    return _built(split.distinct(), keys, most)


def merge_containers(parts: DataFrame, keys: Sequence[str], most: int = MOST) -> DataFrame:
    """One set for each key from the containers of several. Arrays become numbers again only where their container
    stands in several sets."""
    place = [*keys, "high"]
    same = functools.reduce(Column.__and__, [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in place])
    met = parts.groupBy(*place).agg(F.count(F.lit(1)).alias("parts"), F.max(F.col("bits").isNotNull()).alias("dense"))
    held = parts.alias("p").join(met.alias("s"), same).select("p.*", "s.parts", "s.dense")
    alone = held.filter("parts = 1").drop("parts", "dense")
    several = held.filter("parts > 1")
    numbers = several.filter("entries IS NOT NULL").select(*place, "dense", F.explode("entries").alias("low"))
    sparse = _built(numbers.filter("NOT dense").drop("dense").distinct(), keys, most)
    bits = several.filter("bits IS NOT NULL").select(*place, "bits").unionByName(
        numbers.filter("dense").groupBy(*place).agg(F.bitmap_construct_agg(F.col("low").cast("bigint")).alias("bits")))
    dense = bits.groupBy(*place).agg(F.bitmap_or_agg("bits").alias("bits")).select(
        *place, F.bitmap_count("bits").alias("n"), F.lit(None).cast("array<smallint>").alias("entries"), "bits")
    return alone.unionByName(sparse).unionByName(dense)


def cardinalities(parts: DataFrame, keys: Sequence[str], name: str = "uv") -> DataFrame:
    """How many numbers the set of each key has, from merged containers."""
    return parts.groupBy(*keys).agg(F.sum("n").alias(name))


def container_bytes() -> Column:
    """The size of a container: 8 bytes of its name, and its array or bitmap."""
    return F.lit(8) + F.coalesce(2 * F.size("entries"), F.length("bits"))


def container_counts(df: DataFrame, keys: Sequence[str], user: str | Column, pv: str = "pv", uv: str = "uv") -> DataFrame:
    """Rows and distinct users of each key, through compressed sets of the users' 64-bit ids."""
    views = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(pv)).alias("p")
    users = cardinalities(containers(df, keys, user), keys, uv).alias("s")
    same = functools.reduce(Column.__and__, [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in keys])
    return views.join(users, same, "left").select("p.*", F.coalesce(f"s.{uv}", F.lit(0)).cast("bigint").alias(uv))
