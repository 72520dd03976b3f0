"""JDBC reads. Credentials only ever come from the caller's options."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession


def table_options(
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a table scan, split over ``partitions`` ranges of a numeric column."""
    options = {"dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column:
        if bounds is None or not partitions:
            raise ValueError("a partitioned read needs bounds and a partition count")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def _reader(spark: SparkSession, url: str, options: dict[str, str], connection: dict[str, str]) -> DataFrameReader:
    return spark.read.format("jdbc").option("url", url).options(**connection).options(**options)


def jdbc_table(spark: SparkSession, url: str, table: str, connection: dict[str, str] | None = None,
               **split) -> DataFrame:
    """Scan a table; see :func:`table_options` for the split arguments."""
    return _reader(spark, url, table_options(table, **split), connection or {}).load()


def jdbc_query(spark: SparkSession, url: str, query: str, connection: dict[str, str] | None = None,
               fetch_size: int = 10_000) -> DataFrame:
    """Rows of a query the database runs (one connection)."""
    return _reader(spark, url, {"query": query, "fetchsize": str(fetch_size)}, connection or {}).load()
