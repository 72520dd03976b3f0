"""Event time and watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.functions.clock import event_ts


# Earlier than any timestamp, in microseconds.
BEFORE_ALL = -(1 << 62)


def with_event_time(df: DataFrame, ms: str = "time", delay: str | None = None, ts: str = "ts") -> DataFrame:
    """Add the event timestamp; on a stream, also a watermark ``delay`` behind the newest event."""
    out = df.withColumn(ts, event_ts(ms))
    return out.withWatermark(ts, delay) if delay is not None and df.isStreaming else out


def filter_above_watermark(df: DataFrame, condition: Column, ts: str = "ts") -> DataFrame:
    """Filter rows *after* they have moved the watermark.

    The optimizer pushes a filter that leaves the event-time column alone below the watermark, and
    the dropped rows would then no longer advance it. Tying the condition to the column keeps the
    filter above. The tie is a comparison every timestamp passes: a null test would be folded away
    where the column cannot be null. A table has no watermark, so there the plain filter can reach
    the scan.
    """
    if not df.isStreaming:
        return df.filter(condition)
    return df.filter(F.when(F.unix_micros(ts) > F.lit(BEFORE_ALL), condition).otherwise(F.lit(False)))


def unique_count_stream(df: DataFrame, user: str, size: str, ts: str = "ts", name: str = "uv") -> DataFrame:
    """Exact distinct users per window on a watermarked stream: deduplicate, then count.

    State holds one entry per (window, user), spread over both, until the watermark passes.
    """
    pairs = df.select(F.window(ts, size).alias("w"), user).dropDuplicates(["w", user])
    counts = pairs.groupBy("w").agg(F.count(user).alias(name))
    return counts.select(F.unix_millis("w.start").alias("w_start"), F.unix_millis("w.end").alias("w_end"), name)
