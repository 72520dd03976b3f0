"""Shopping behaviour: page views and unique visitors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics import schemas
from streamlytics.functions.clock import local_date
from streamlytics.functions.jsonline import parse_json
from streamlytics.operators.distinct import hll_sketches
from streamlytics.operators.window import cumulative_pv_uv, windowed
from streamlytics.streaming.eventtime import filter_above_watermark, unique_count_stream, with_event_time

PAGE_VIEW = "pv"
ZONE = "Asia/Shanghai"
# Start of the local day in epoch time for the zone above (UTC+8, no summer time).
LOCAL_DAY_OFFSET = "16 hours"


def read_behaviour(lines: DataFrame, delay: str = "1 millisecond") -> DataFrame:
    """Behaviour records with their event timestamp in ``event_time`` (watermarked on a stream)."""
    return with_event_time(parse_json(lines, schemas.SHOPPING), "ts", delay, "event_time")


def views(lines: DataFrame) -> DataFrame:
    return filter_above_watermark(read_behaviour(lines), F.col("behavior") == PAGE_VIEW, "event_time")


def dated_views(lines: DataFrame) -> DataFrame:
    """Page views with their local ``date``."""
    return views(lines).withColumn("date", F.date_format(local_date("ts", ZONE), "yyyy-MM-dd"))


def page_views(lines: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Page views per tumbling window."""
    return windowed(views(lines), [], [F.count(F.lit(1)).alias("pv")], size, ts="event_time")


def hourly_uv(lines: DataFrame, size: str = "1 hour") -> DataFrame:
    """Exact distinct visitors per tumbling window."""
    if lines.isStreaming:
        return unique_count_stream(views(lines), "user_id", size, "event_time")
    return windowed(views(lines), [], [F.countDistinct("user_id").alias("uv")], size, ts="event_time")


def item_pv_uv(lines: DataFrame, step: str = "3 minutes", local_days: bool = True) -> DataFrame:
    """Views and exact visitors per local date and item so far, refreshed every ``step``.

    ``local_days`` aligns the day window with the local date. Without it the window is the UTC
    day, and a local date is spread over the two windows it overlaps.
    """
    rows = dated_views(lines)
    offset = LOCAL_DAY_OFFSET if local_days else None
    return cumulative_pv_uv(rows, ["date", "itemId"], "user_id", "1 day", step, offset, "event_time")


def item_uv_sketches(lines: DataFrame) -> DataFrame:
    """One visitor sketch per local date and item."""
    return hll_sketches(dated_views(lines), ["date", "itemId"], "user_id")


def item_uv_approx(lines: DataFrame) -> DataFrame:
    """Approximate visitors per local date and item."""
    return item_uv_sketches(lines).select("date", "itemId", F.hll_sketch_estimate("sketch").alias("uv"))


def store_key(date: str = "date", item: str = "itemId"):
    """Date and item run together, the key form of existing stores (ambiguous without a separator)."""
    return F.concat(F.col(date), F.col(item).cast("string"))
