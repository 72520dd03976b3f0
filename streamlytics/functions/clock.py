"""Calendar keys from epoch milliseconds. The session zone is UTC; local zones are arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_ts(ms: str | Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def _local(ms: str | Column, zone: str) -> Column:
    ts = event_ts(ms)
    return ts if zone == "UTC" else F.from_utc_timestamp(ts, zone)


def format_ms(ms: str | Column, pattern: str = "yyyy-MM-dd HH:mm:ss", zone: str = "UTC") -> Column:
    return F.date_format(_local(ms, zone), pattern)


def day_hour(df: DataFrame, ms: str = "time", zone: str = "UTC") -> DataFrame:
    """Add ``day`` (yyyyMMdd) and ``hour`` (HH)."""
    return df.withColumns({"day": format_ms(ms, "yyyyMMdd", zone), "hour": format_ms(ms, "HH", zone)})


def local_date(ms: str | Column, zone: str = "Asia/Shanghai") -> Column:
    """Calendar date in a zone."""
    return F.to_date(_local(ms, zone))


def window_label(start: str | Column, end: str | Column, key: str | Column, value: str | Column,
                 zone: str = "UTC") -> Column:
    """``[start==>end], key==>value`` with both bounds (epoch ms) written out."""
    return F.concat(
        F.lit("["), format_ms(start, zone=zone), F.lit("==>"), format_ms(end, zone=zone), F.lit("], "),
        F.col(key) if isinstance(key, str) else key, F.lit("==>"),
        (F.col(value) if isinstance(value, str) else value).cast("string"),
    )
