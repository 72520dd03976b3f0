"""Distinct users: exact, by bitmap, by sketch, and over a long rolling window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def exact_counts(df: DataFrame, keys: Sequence[str], user: str, pv: str = "pv", uv: str = "uv") -> DataFrame:
    """Rows and distinct users per key, in two grouping steps.

    The first step groups by key and user, so neither a hot key nor a hot user meets in one task.
    """
    per_user = df.groupBy(*keys, user).agg(F.count(F.lit(1)).alias("__n"))
    return per_user.groupBy(*keys).agg(F.sum("__n").alias(pv), F.count(user).alias(uv))


def bitmap_parts(df: DataFrame, keys: Sequence[str], user: str) -> DataFrame:
    """Mergeable partial bitmaps ``(keys, bucket, bits, pv)``; merge with ``bitmap_or_agg``."""
    return df.groupBy(*keys, F.bitmap_bucket_number(user).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("bits"), F.count(F.lit(1)).alias("pv")
    )


def bitmap_counts(df: DataFrame, keys: Sequence[str], user: str, pv: str = "pv", uv: str = "uv") -> DataFrame:
    """Rows and distinct integer users per key, through bitmaps.

    A bitmap takes 4 KB for each key and each stretch of 32,768 ids in which the key has a user. It pays from some
    hundred users per key and stretch on; for hashed or scattered ids :func:`exact_counts` gives the same numbers.
    """
    parts = bitmap_parts(df, keys, user)
    return parts.groupBy(*keys).agg(F.sum("pv").alias(pv), F.sum(F.bitmap_count("bits")).alias(uv))


def hll_sketches(df: DataFrame, keys: Sequence[str], user: str, name: str = "sketch") -> DataFrame:
    """One mergeable sketch per key."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(user).alias(name))


def hll_counts(df: DataFrame, keys: Sequence[str], user: str, uv: str = "uv") -> DataFrame:
    """Approximate distinct users per key."""
    sketches = hll_sketches(df, keys, user)
    return sketches.select(*keys, F.hll_sketch_estimate("sketch").alias(uv))


def rolling_distinct(
    df: DataFrame,
    user: str,
    panes: int = 480,
    step_ms: int = 180_000,
    ms: str = "time",
    method: str = "hll",
) -> DataFrame:
    """Distinct users of the last ``panes`` steps, after every step: ``(window_end, uv)``.

    Small tumbling partials replace the long sliding window, so no row is copied ``panes`` times.
    Every window that holds an event is reported. ``hll`` keeps one sketch per step; ``exact``
    keeps the distinct (user, step) pairs.
    """
    if method not in ("hll", "exact"):
        raise ValueError(f"unknown method {method}")
    steps = df.select(F.floor(F.col(ms) / step_ms).cast("bigint").alias("step"), F.col(user).alias("user"))
    last, uv = (_rolling_sketches if method == "hll" else _rolling_exact)(steps, panes)
    return last.select(((F.col("step") + 1) * step_ms).alias("window_end"), uv.alias("uv"))


def _rolling_sketches(steps: DataFrame, panes: int) -> tuple[DataFrame, Column]:
    """Windows from two merges per step in place of ``panes``.

    With time cut into blocks of ``panes`` steps, a rolling window is the tail of one block and the
    head of the next: one running merge backwards and one forwards, each within a block.
    """
    partial = steps.groupBy("step").agg(F.hll_sketch_agg("user").alias("part"))
    partial = partial.withColumn("block", F.floor(F.col("step") / panes).cast("bigint"))

    in_block = Window.partitionBy("block")
    forward, backward = in_block.orderBy("step"), in_block.orderBy(F.desc("step"))
    merge = F.hll_union_agg("part")
    runs = partial.select(
        "step", "block",
        merge.over(forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("head"),
        merge.over(backward.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("tail"),
        F.lag("step").over(forward).alias("before"), F.lead("step").over(forward).alias("after"))
    # Steps without data repeat their neighbour's run. A head serves the windows that end from its
    # step to the next one's, a tail those that begin after the step before and up to its own.
    first, last = F.col("block") * panes, (F.col("block") + 1) * panes - 1
    served = F.explode(F.array(
        F.struct(F.sequence("step", F.coalesce(F.col("after") - 1, last)).alias("steps"),
                 F.col("head").alias("part")),
        F.struct(F.sequence(F.coalesce(F.col("before") + 1, first) + (panes - 1),
                            F.col("step") + (panes - 1)).alias("steps"), F.col("tail").alias("part")),
    )).alias("s")
    # A window that fills a block exactly is head and tail at once, which a union does not mind.
    pieces = runs.select(served).select(F.explode("s.steps").alias("step"), F.col("s.part").alias("part"))
    return pieces.groupBy("step").agg(merge.alias("part")), F.hll_sketch_estimate("part")


def _rolling_exact(steps: DataFrame, panes: int) -> tuple[DataFrame, Column]:
    """Windows by a sweep over the times at which users enter and leave.

    A user is in the windows of the ``panes`` steps from each sighting on; where these stretches
    overlap they are one. The count changes by the stretches that begin and end at a step.
    """
    sightings = steps.filter("user is not null").distinct()
    of_user = Window.partitionBy("user").orderBy("step")
    near = sightings.select(
        "step", F.lag("step").over(of_user).alias("before"), F.lead("step").over(of_user).alias("after"))
    enters = F.col("before").isNull() | (F.col("step") - F.col("before") > panes)
    leaves = F.col("after").isNull() | (F.col("after") - F.col("step") > panes)
    turns = near.select(F.explode(F.array(
        F.when(enters, F.struct(F.col("step").alias("step"), F.lit(1).alias("d"))),
        F.when(leaves, F.struct((F.col("step") + panes).alias("step"), F.lit(-1).alias("d"))),
    )).alias("t")).filter("t is not null")
    changes = turns.groupBy("t.step").agg(F.sum("t.d").alias("d"))
    # One row per step at most, however many users: years of three-minute steps fit one task.
    in_time = Window.orderBy("step")
    levels = changes.select(
        "step", F.sum("d").over(in_time.rowsBetween(Window.unboundedPreceding, 0)).alias("uv"),
        F.lead("step").over(in_time).alias("next"))
    held = levels.filter("uv > 0").select("uv", F.explode(F.sequence("step", F.col("next") - 1)).alias("step"))
    return held, F.col("uv")
