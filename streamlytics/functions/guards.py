"""Filters and guards with the null rules of the feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.functions.barrier import once


def not_equal(column: str | Column, value) -> Column:
    """True when the column differs from ``value``; a null column differs too."""
    column = F.col(column) if isinstance(column, str) else column
    return ~column.eqNullSafe(F.lit(value))


def poison_guard(df: DataFrame, token: str, column: str = "value") -> DataFrame:
    """Fail the job on the first value that contains ``token``."""
    value = F.col(column)
    error = F.raise_error(F.concat(F.lit("poison record: "), value))
    checked = once(df, F.when(value.contains(token), error).otherwise(value), "__checked")
    return checked.withColumn(column, F.col("__checked")).drop("__checked")


def quarantine_poison(df: DataFrame, token: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(clean rows, rows that contain token)`` instead of failing."""
    poison = F.coalesce(F.col(column).contains(token), F.lit(False))
    return df.filter(~poison), df.filter(poison)


def ingest_time() -> Column:
    """Epoch milliseconds at which the row was taken in."""
    return F.unix_millis(F.current_timestamp())
