"""Line, CSV and in-memory sources. Every line source yields one ``value STRING`` column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def text_lines(spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None) -> DataFrame:
    """One row per line. As a stream, ``path`` is a folder and new files are picked up."""
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP peer. Not replayable: for trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def elements(spark: SparkSession, rows: Iterable, schema: StructType | str, slices: int | None = None) -> DataFrame:
    """In-memory rows as a table."""
    df = spark.createDataFrame(list(rows), schema)
    return df.repartition(slices) if slices else df


def number_sequence(spark: SparkSession, first: int, last: int, tasks: int | None = None) -> DataFrame:
    """``first`` to ``last`` inclusive, generated by ``tasks`` tasks."""
    return spark.range(first, last + 1, 1, tasks)


def csv_view(spark: SparkSession, path: str, schema: StructType, name: str | None = None) -> DataFrame:
    """A header-less CSV table with a declared schema, registered under ``name`` if given."""
    df = spark.read.schema(schema).csv(path)
    if name:
        df.createOrReplaceTempView(name)
    return df
