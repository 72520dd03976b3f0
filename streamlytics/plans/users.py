"""App events: new and returning users, top products, warehouse rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics import schemas
from streamlytics.functions.clock import day_hour
from streamlytics.functions.guards import ingest_time, not_equal
from streamlytics.functions.jsonline import parse_json
from streamlytics.operators.aggregate import count_by
from streamlytics.operators.enrich import enrich_ip
from streamlytics.operators.sequence import first_seen
from streamlytics.operators.topk import top_n
from streamlytics.operators.window import sliding_count
from streamlytics.streaming.eventtime import filter_above_watermark, with_event_time
from streamlytics.streaming.stateful import first_seen_stream, top_n_on_timer

STARTUP = "startup"


def read_app_events(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """App events of the well-formed lines."""
    return parse_json(lines, schemas.APP_EVENT, defaults=schemas.APP_EVENT_DEFAULTS, keep=keep)


def startups(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return read_app_events(lines, keep).filter(F.col("event") == STARTUP)


def os_users(lines: DataFrame) -> DataFrame:
    """Startups per operating system and new/returning flag."""
    return count_by(startups(lines), "os", "nu")


def total_users(lines: DataFrame) -> DataFrame:
    """Startups per new/returning flag."""
    return count_by(startups(lines), "nu")


def province_users(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """Startups per province of the address and new/returning flag."""
    return count_by(enrich_ip(startups(lines), ranges), "province", "nu")


def first_time_users(lines: DataFrame, row_id: str | None = None, order: Sequence[str] = ("time",),
                     column: str = "nu") -> DataFrame:
    """Startups with ``column`` set to 1 where a device shows up first within its device type.

    A table needs a unique ``row_id`` column next to ``value``, which breaks ties in ``order``. A stream goes by
    micro-batch, and within one by ``order`` and ``row_id`` where that is given.
    """
    identity = ["deviceType", "device"]
    if lines.isStreaming:
        kept = (row_id,) if row_id else ()
        return first_seen_stream(startups(lines, kept), identity, column, order=[*order, *kept])
    if row_id is None:
        raise ValueError("a table needs row_id")
    return first_seen(startups(lines, (row_id,)), identity, order, row_id, column)


PRODUCT_KEYS = ["event", "category", "product"]


def product_events(lines: DataFrame, delay: str = "20 seconds") -> DataFrame:
    """Event time, event, category and product of everything but startups.

    Events without a product keep a null category and product.
    """
    events = with_event_time(read_app_events(lines), "time", delay)
    return filter_above_watermark(events, not_equal("event", STARTUP)).select(
        "ts", "event", F.col("product.category").alias("category"), F.col("product.name").alias("product"))


def product_counts(lines: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
                   delay: str = "20 seconds") -> DataFrame:
    """Events per (event, category, product) and sliding window, startups left out."""
    return sliding_count(product_events(lines, delay), PRODUCT_KEYS, size, slide)


def top_products(lines: DataFrame, n: int = 3, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """The ``n`` most frequent products per event, category and sliding window."""
    counts = product_counts(lines, size, slide)
    return top_n(counts, ["w_start", "w_end", "event", "category"], "cnt", ["product"], n)


def top_products_on_timer(lines: DataFrame, n: int = 3, size: str = "5 minutes", slide: str | None = "1 minute",
                          delay: str = "20 seconds") -> DataFrame:
    """Streaming Top-N from keyed state, each group released by a timer at the end of its window."""
    window = F.window("ts", size, slide).alias("w")
    counts = product_events(lines, delay).groupBy(window, *PRODUCT_KEYS).agg(F.count(F.lit(1)).alias("cnt"))
    bounded = counts.withColumns({"w_start": F.unix_millis("w.start"), "w_end": F.unix_millis("w.end")})
    return top_n_on_timer(bounded, ["w_start", "w_end", "event", "category"], "cnt", "product", n)


def etl_rows(records: DataFrame, zone: str = "UTC") -> DataFrame:
    """Warehouse rows from ``(id, value)`` records: startups with day, hour and time of intake.

    A narrow plan: nothing is shuffled.
    """
    events = parse_json(records, schemas.ETL_EVENT, defaults=schemas.ETL_DEFAULTS, keep=("id",))
    rows = day_hour(events.filter(F.col("event") == STARTUP), "time", zone)
    return rows.withColumn("ingest_time", ingest_time()).select(*schemas.ETL_COLUMNS)
