"""First sightings by a Bloom filter per group, built and probed with SQL functions.

A filter is rows: ``(group, bucket, bits)``, each a bitmap of 32,768 of the filter's positions that has any bit set. It
is made by aggregation, merged by ``bitmap_or_agg`` and probed by a join on the bucket, so a popular group's filter is
spread over its buckets and no task holds one whole.

A member that the filter holds is never taken for new. A new one is taken for known with the stated chance at most, as long
as a group has no more members than the filter's capacity.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32_768  # of a bitmap of Spark's


@dataclass(frozen=True)
class Bloom:
    """``size`` positions and ``hashes`` of them for a member, from the members a group may have and the chance of an
    error."""

    capacity: int = 100_000
    error: float = 0.03

    @property
    def size(self) -> int:
        return max(64, math.ceil(-self.capacity * math.log(self.error) / math.log(2) ** 2))

    @property
    def hashes(self) -> int:
        return max(1, round(self.size / self.capacity * math.log(2)))

    def positions(self, *member: str | Column) -> Column:
        """The positions of a member: two hashes, and sums of the one and multiples of the other."""
        first, second = F.xxhash64(*member), F.xxhash64(F.lit(1), *member)
        size = F.lit(self.size).cast("bigint")
        first, second = F.pmod(first, size), F.pmod(second, size - 1) + 1
        return F.array_distinct(F.array(*[F.pmod(first + i * second, size) for i in range(self.hashes)]))


def _bit(position: Column) -> tuple[Column, Column]:
    return F.floor(position / BITS).cast("bigint"), F.pmod(position, F.lit(BITS)).cast("bigint")


def bloom_parts(df: DataFrame, groups: Sequence[str], member: str, bloom: Bloom) -> DataFrame:
    """``(groups, bucket, bits)``: the filter of the members of each group; filters of parts of the rows merge."""
    placed = df.select(*groups, F.explode(bloom.positions(member)).alias("__at"))
    bucket, bit = _bit(F.col("__at"))
    return placed.select(*groups, bucket.alias("bucket"), bit.alias("__bit")).groupBy(*groups, "bucket").agg(
        F.bitmap_construct_agg("__bit").alias("bits"))


def merge_parts(parts: DataFrame, groups: Sequence[str]) -> DataFrame:
    return parts.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, bit: Column) -> Column:
    """Whether a bit of a bitmap is set; false without a bitmap."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("getbit", byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))


def placed(members: DataFrame, groups: Sequence[str], member: str, bloom: Bloom, *keep: str) -> DataFrame:
    """``(groups, keep, __at)``: a row for each position of a member."""
    return members.select(*groups, *keep, F.explode(bloom.positions(member)).alias("__at"))


def unset(positions: DataFrame, filters: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The rows whose position ``__at`` the filters do not have set."""
    bucket, bit = _bit(F.col("__at"))
    asked = positions.withColumns({"__bucket": bucket, "__bit": bit}).alias("m")
    same = [*(F.col(f"m.{c}").eqNullSafe(F.col(f"f.{c}")) for c in groups), F.col("m.__bucket") == F.col("f.bucket")]
    met = asked.join(filters.select(*groups, "bucket", "bits").alias("f"), same, "left")
    return met.filter(~_is_set(F.col("f.bits"), F.col("m.__bit"))).select(*[F.col(f"m.{c}") for c in positions.columns])


def first_setters(positions: DataFrame, groups: Sequence[str], order: str, row_id: str) -> DataFrame:
    """``(row_id)`` of the members that a filter takes for new when they come one by one along ``order``, ties by
    ``row_id``: those that are the first at one of their unset positions. From rows of ``(groups, __at, order, row_id)``."""
    at_once = positions.groupBy(*groups, "__at", order).agg(F.min(row_id).alias(row_id))
    return at_once.groupBy(*groups, "__at").agg(F.min_by(row_id, order).alias(row_id)).select(row_id).distinct()


def first_sightings(df: DataFrame, identity: Sequence[str], order: str, row_id: str) -> DataFrame:
    """``(identity, order, row_id)`` of the first row of each identity, ties by ``row_id``."""
    at_once = df.groupBy(*identity, order).agg(F.min(row_id).alias(row_id))
    return at_once.groupBy(*identity).agg(F.min(order).alias(order), F.min_by(row_id, order).alias(row_id))


def first_seen_bloom(df: DataFrame, groups: Sequence[str], member: str, order: str, row_id: str, column: str = "nu",
                     bloom: Bloom = Bloom(), filters: DataFrame | None = None) -> DataFrame:
    """Set ``column`` to 1 on the rows that a Bloom filter of each group takes for the first of their member, going along
    ``order`` (integral, not null), ties by ``row_id``; ``filters`` holds what earlier rows have put into it.

    Rows so marked are first rows. First rows that are not marked are the filter's errors.
    """
    members = first_sightings(df, [*groups, member], order, row_id)
    positions = placed(members, groups, member, bloom, order, row_id)
    if filters is not None:
        positions = unset(positions, filters, groups)
    new = first_setters(positions, groups, order, row_id).withColumn("__new", F.lit(True))
    current = F.col(column) if column in df.columns else F.lit(0)
    return df.join(new, row_id, "left").withColumn(
        column, F.when(F.col("__new"), 1).otherwise(current).cast("int")).drop("__new")
