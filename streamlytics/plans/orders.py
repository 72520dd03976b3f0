"""Orders and their items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from streamlytics import schemas
from streamlytics.functions.delimited import parse_delimited
from streamlytics.operators.joins import repair_late_items, windowed_left_join
from streamlytics.operators.late import flag_late
from streamlytics.streaming.eventtime import with_event_time


def read_orders(lines: DataFrame, delay: str = "0 seconds", keep: tuple[str, ...] = ()) -> DataFrame:
    return with_event_time(parse_delimited(lines, schemas.ORDER, keep=keep), "time", delay)


def read_items(lines: DataFrame, delay: str = "0 seconds", keep: tuple[str, ...] = ()) -> DataFrame:
    return with_event_time(parse_delimited(lines, schemas.ITEM, keep=keep), "time", delay)


def order_item_join(item_lines: DataFrame, order_lines: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Each item with its order of the same tumbling window, or with nulls."""
    return windowed_left_join(read_items(item_lines), read_orders(order_lines), "orderId", size)


def order_item_repair(
    item_lines: DataFrame, order_lines: DataFrame, arrival: Sequence[str], size_ms: int = 5000, delay_ms: int = 0
) -> DataFrame:
    """The join with late and unmatched items looked up in the whole order table.

    ``item_lines`` carries the order of arrival in the ``arrival`` columns.
    """
    items = read_items(item_lines, keep=tuple(arrival))
    flagged = flag_late(items, arrival, size_ms, delay_ms)
    orders = read_orders(order_lines)
    return repair_late_items(flagged, orders, orders, "orderId", f"{size_ms} milliseconds")
