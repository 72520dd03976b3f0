"""Event-time windows. Bounds are epoch-aligned and half-open, and come out as epoch milliseconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOUNDS = ("w_start", "w_end")


def with_bounds(df: DataFrame, window: str = "w") -> DataFrame:
    """Replace a window struct with its two bounds in epoch milliseconds, in front."""
    rest = [c for c in df.columns if c != window]
    return df.select(
        F.unix_millis(f"{window}.start").alias("w_start"), F.unix_millis(f"{window}.end").alias("w_end"), *rest
    )


def windowed(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    size: str,
    slide: str | None = None,
    offset: str | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Aggregate per window and keys; without keys, per window over everything.

    Works on tables and, after a watermark, on streams. Aggregates are partial before the shuffle,
    so a window that holds most rows is no hot spot.
    """
    window = F.window(ts, size, slide, offset).alias("w")
    return with_bounds(df.groupBy(window, *keys).agg(*aggregates))


def sliding_count(df: DataFrame, keys: Sequence[str], size: str, slide: str, ts: str = "ts",
                  name: str = "cnt") -> DataFrame:
    """Counts per sliding window, from panes.

    Rows are first counted per pane of one slide; only pane counts are copied into the
    ``size / slide`` windows they belong to, not the rows. ``size`` must be a multiple of ``slide``.
    On a stream the panes leave the first state as the watermark passes them, and the windows follow.
    """
    panes = df.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(F.count(F.lit(1)).alias("__n"))
    at = F.window_time("pane") if df.isStreaming else F.col("pane.start")
    return with_bounds(panes.groupBy(F.window(at, size, slide).alias("w"), *keys).agg(F.sum("__n").alias(name)))


def cumulative_pv_uv(
    df: DataFrame,
    keys: Sequence[str],
    user: str,
    size: str = "1 day",
    step: str = "3 minutes",
    offset: str | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Views and distinct users of each window so far, refreshed every ``step``.

    One row per step in which the key saw anything: ``pv`` and ``uv`` from the window's start to
    ``fire_time``. Users count in the step that first saw them, so no user set is kept; the running
    sums go over at most ``size / step`` rows.
    """
    keys = list(keys)
    # One window expression per projection is the rule of the analyzer, hence two steps.
    steps = df.select(F.window(ts, step)["end"].alias("__fire"), ts, *keys, F.col(user).alias("__user"))
    base = steps.select(F.window(ts, size, size, offset).alias("w"), F.unix_millis("__fire").alias("fire_time"),
                        *keys, "__user")
    # Both branches start from one aggregate, so the source is read once and the exchange is shared.
    seen = base.groupBy("w", *keys, "__user", "fire_time").agg(F.count(F.lit(1)).alias("__n"))
    views = seen.groupBy("w", *keys, "fire_time").agg(
        F.sum("__n").alias("__pv"), F.lit(0).cast("bigint").alias("__uv"))
    first = F.min(F.when(F.col("__user").isNotNull() & (F.col("__n") > 0), F.col("fire_time")))
    arrivals = (
        seen.groupBy("w", *keys, "__user").agg(first.alias("fire_time")).filter("fire_time is not null")
        .groupBy("w", *keys, "fire_time").agg(
            F.lit(0).cast("bigint").alias("__pv"), F.count(F.lit(1)).alias("__uv"))
    )
    fires = views.unionByName(arrivals).groupBy("w", *keys, "fire_time").agg(
        F.sum("__pv").alias("__pv"), F.sum("__uv").alias("__uv"))
    so_far = Window.partitionBy("w", *keys).orderBy("fire_time").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return with_bounds(fires.select(
        "w", *keys, "fire_time", F.sum("__pv").over(so_far).alias("pv"), F.sum("__uv").over(so_far).alias("uv")
    ))
