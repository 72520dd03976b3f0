"""Kafka source and decoding of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlytics.sources.settings import JobSettings


def read_kafka(spark: SparkSession, settings: JobSettings) -> DataFrame:
    """Raw Kafka rows for the topics the job settings name."""
    return spark.readStream.format("kafka").options(**settings.reader_options).load()


def record_id() -> Column:
    """``topic_partition_offset``: unique, and the same again when a batch is replayed."""
    return F.concat_ws("_", "topic", "partition", "offset")


def kafka_lines(rows: DataFrame) -> DataFrame:
    """Kafka rows to one ``value STRING`` column."""
    return rows.select(F.col("value").cast("string").alias("value"))


def kafka_records(rows: DataFrame) -> DataFrame:
    """Kafka rows to ``(id, value)`` with the record's identity."""
    return rows.select(record_id().alias("id"), F.col("value").cast("string").alias("value"))
