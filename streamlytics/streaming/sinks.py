"""Sinks. Each micro-batch lands under its own batch number, so a replayed batch replaces itself."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from streamlytics.operators.distinct import bitmap_parts
from streamlytics.streaming.keyed import KeyedTable

BATCH = "batch"
BatchWriter = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class BatchTable:
    """A Parquet table with one folder per micro-batch; one table belongs to one checkpoint.

    With a ``schema`` a table that no batch has written yet reads as one without rows.
    """

    path: str
    schema: str | None = None

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.parquet(self.path)
        except AnalysisException as error:
            if self.schema is None or error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], f"{self.schema}, {BATCH} int")

    def read_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows of one micro-batch, without looking at the others."""
        return spark.read.parquet(f"{self.path}/{BATCH}={batch_id}")


@dataclass(frozen=True)
class BatchRange:
    """The batches of a table up to a number."""

    table: BatchTable
    up_to: int

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark).filter(F.col(BATCH) <= self.up_to)


def start(writer: DataStreamWriter, checkpoint: str, trigger: dict | None = None,
          name: str | None = None) -> StreamingQuery:
    """Start a query that resumes from ``checkpoint``; the folder is kept when the query stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


# -- keyed stores -------------------------------------------------------------------------------

def hash_rows(df: DataFrame, hash_name: str, field: str | Column, value: str | Column) -> DataFrame:
    """Rows of a keyed hash ``(hash, field, value)``, both sides as text."""
    field = F.col(field) if isinstance(field, str) else field
    value = F.col(value) if isinstance(value, str) else value
    return df.select(F.lit(hash_name).alias("hash"), field.cast("string").alias("field"),
                     value.cast("string").alias("value"))


def hash_sink(table: BatchTable, hash_name: str, field: str | Column, value: str | Column) -> BatchWriter:
    """Last write wins per (hash, field). Feed it from an ``update`` mode query, which gives each
    field once per batch; :func:`read_hash` takes the newest batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(hash_rows(batch, hash_name, field, value), batch_id)

    return write


def read_hash(spark: SparkSession, table: BatchTable) -> DataFrame:
    """The newest value of each field: first the newest batch number, which needs no sort, then its row."""
    rows = table.read(spark)
    newest = rows.groupBy("hash", "field").agg(F.max(BATCH).alias("__newest"))
    same = (rows["hash"].eqNullSafe(newest["hash"]) & rows["field"].eqNullSafe(newest["field"])
            & (rows[BATCH] == newest["__newest"]))
    return rows.join(newest, same, "left_semi").select("hash", "field", "value")


def compact_hash(spark: SparkSession, table: BatchTable, target: BatchTable, up_to: int) -> None:
    """Fold the batches up to one into a snapshot under that batch's number in ``target``; later batches are to be
    written there. The old table stays until its owner drops it, so readers are not disturbed."""
    target.write(read_hash(spark, BatchRange(table, up_to)), up_to)


def set_sink(table: BatchTable, key: str | Column, member: str | Column) -> BatchWriter:
    """Add members to sets ``(key, member)``; repeats are dropped per batch here and overall on read."""
    key = F.col(key) if isinstance(key, str) else key
    member = F.col(member) if isinstance(member, str) else member

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(key.cast("string").alias("key"), member.cast("string").alias("member"))
        table.write(rows.distinct(), batch_id)

    return write


def read_set(spark: SparkSession, table: BatchTable) -> DataFrame:
    return table.read(spark).select("key", "member").distinct()


def compact_set(spark: SparkSession, table: BatchTable, target: BatchTable, up_to: int) -> None:
    """The same for a set store."""
    target.write(read_set(spark, BatchRange(table, up_to)), up_to)


def sketch_sink(table: BatchTable, keys: Sequence[str], member: str) -> BatchWriter:
    """Add members to one sketch per key: each batch writes its sketches, reading unites them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(batch.groupBy(*keys).agg(F.hll_sketch_agg(member).alias("sketch")), batch_id)

    return write


def read_sketches(spark: SparkSession, table: BatchTable, keys: Sequence[str], name: str = "uv") -> DataFrame:
    united = table.read(spark).groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    return united.select(*keys, F.hll_sketch_estimate("sketch").alias(name))


def compact_sketches(spark: SparkSession, table: BatchTable, target: BatchTable, keys: Sequence[str], up_to: int) -> None:
    """The same for a sketch store."""
    rows = BatchRange(table, up_to).read(spark)
    target.write(rows.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch")), up_to)


def bitmap_sink(table: BatchTable, keys: Sequence[str], member: str) -> BatchWriter:
    """Views and exact visitors: each batch writes mergeable bitmaps, so no state grows with the
    users, and the result so far can be read after every trigger (three minutes, say). For dense
    integer ids; see :func:`~streamlytics.operators.distinct.bitmap_counts`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(bitmap_parts(batch, keys, member), batch_id)

    return write


def read_bitmaps(spark: SparkSession, table: BatchTable, keys: Sequence[str], pv: str = "pv",
                 uv: str = "uv") -> DataFrame:
    united = table.read(spark).groupBy(*keys, "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("__n"), F.sum("pv").alias("__pv"))
    return united.groupBy(*keys).agg(F.sum("__pv").alias(pv), F.sum("__n").alias(uv))


def bitmap_state(path: str, keys: Sequence[str], buckets: int = 64) -> KeyedTable:
    """A table of the bitmaps of each key so far, for :func:`firing_sink`."""
    return KeyedTable(path, (*keys, "bucket"), buckets, by=tuple(keys))


def firing_sink(state: KeyedTable, fired: BatchTable, keys: Sequence[str], member: str) -> BatchWriter:
    """Early firing: after each micro-batch the views and exact visitors so far, as ``(keys, fire, pv, uv)``, of the keys
    that the batch saw. ``fire`` is the batch number; a replayed batch fires the same rows again. The bitmaps so far are
    kept in ``state`` (see :func:`bitmap_state`), of which a batch reads and writes what lies in the buckets of its keys."""

    def merged(parts: DataFrame) -> DataFrame:
        return parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("pv").alias("pv"))

    def write(batch: DataFrame, batch_id: int) -> None:
        parts = bitmap_parts(batch, keys, member).persist()
        try:
            state.upsert(parts, batch_id, merge=merged)
            changed = parts.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
            same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
            so_far = state.lookup(parts, parts.schema).join(changed, same, "left_semi")
            rows = so_far.groupBy(*keys).agg(
                F.sum("pv").alias("pv"), F.sum(F.bitmap_count("bits")).alias("uv"))
            fired.write(rows.withColumn("fire", F.lit(batch_id)), batch_id)
        finally:
            parts.unpersist()

    return write


def changelog_sink(state: KeyedTable, log: BatchTable, key: str, value: str, name: str = "total") -> BatchWriter:
    """A keyed sum as a changelog: for each key of a micro-batch its first total (``+I``), or the total it had (``-U``) and
    the one it has now (``+U``). Totals are kept in ``state``, a table with the key ``key``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        now = batch.groupBy(F.col(key).alias("key")).agg(F.sum(value).alias("total")).persist()
        try:
            before = state.lookup(now, now.schema, before_batch=batch_id).withColumn("there", F.lit(True))
            rows = now.alias("n").join(before.alias("b"), F.expr("n.key <=> b.key"), "left").select(
                "n.key", F.col("n.total").alias("part"), F.col("b.total").alias("old"), "there")
            fresh = F.col("there").isNull()
            total = F.when(F.col("old").isNull(), F.col("part")).when(
                F.col("part").isNull(), F.col("old")).otherwise(F.col("old") + F.col("part"))
            changes = F.array_compact(F.array(
                F.when(~fresh, F.struct(F.lit("-U").alias("kind"), F.col("old").alias(name))),
                F.struct(F.when(fresh, "+I").otherwise("+U").alias("kind"), total.alias(name))))
            log.write(rows.select(F.col("key").alias(key), F.inline(changes)), batch_id)
            state.upsert(now, batch_id, {"total": "sum"})
        finally:
            now.unpersist()

    return write


def upsert_sink(table: KeyedTable, order: Sequence[str]) -> BatchWriter:
    """Update-then-insert into a keyed table: the last row of each key by ``order``, which also tells whether the row that
    is there is the later one."""

    def merged(rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, table.keys, order)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(latest_per_key(batch, table.keys, order), batch_id, merge=merged)

    return write


# -- files --------------------------------------------------------------------------------------

def csv_sink(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Write a table as CSV."""
    (df.select(*columns) if columns else df).write.mode(mode).csv(path)


def csv_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to CSV files, exactly once."""
    return start(df.writeStream.format("csv").option("path", path).outputMode("append"), checkpoint, trigger)


def console(df: DataFrame, prefix: str | None = None, mode: str = "append") -> DataStreamWriter:
    """Print a stream, with an optional prefix column."""
    rows = df.select(F.lit(prefix).alias("prefix"), "*") if prefix else df
    return rows.writeStream.format("console").outputMode(mode)


# -- JDBC ---------------------------------------------------------------------------------------

def insert_options(url: str, table: str, batch_size: int, connection: dict[str, str] | None = None) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **(connection or {})}


def jdbc_batch_sink(url: str, table: str, columns: Sequence[str], batch_size: int = 50,
                    connection: dict[str, str] | None = None) -> BatchWriter:
    """Batched inserts in a fixed column order. Pair it with a processing-time trigger for the
    flush interval. Inserts are at-least-once: give the table a key on the record id."""
    options = insert_options(url, table, batch_size, connection)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(*columns).write.format("jdbc").options(**options).mode("append").save()

    return write


def merge_statement(target: str, staging: str, keys: Sequence[str], values: Sequence[str], dialect: str = "merge") -> str:
    """One set-based statement: update matched keys, insert the others.

    ``merge`` is standard SQL; ``duplicate_key`` is for stores with ``ON DUPLICATE KEY UPDATE`` and ``conflict`` for those
    with ``ON CONFLICT``, both of which need a unique key over ``keys``.
    """
    columns = [*keys, *values]
    listed = ", ".join(columns)
    if dialect == "duplicate_key":
        updates = ", ".join(f"{v} = s.{v}" for v in values)
        return f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging} s ON DUPLICATE KEY UPDATE {updates}"
    if dialect == "conflict":
        updates = ", ".join(f"{v} = excluded.{v}" for v in values)
        return (f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging} s WHERE true "
                f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}")
    if dialect != "merge":
        raise ValueError(f"unknown dialect {dialect}")
    matched = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    updates = ", ".join(f"{v} = s.{v}" for v in values)
    return (
        f"MERGE INTO {target} t USING {staging} s ON {matched} "
        f"WHEN MATCHED THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def latest_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``, ranked under a filter: each task keeps one row per key before the shuffle."""
    last = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return batch.withColumn("__place", F.row_number().over(last)).filter("__place = 1").drop("__place")


def jdbc_execute(spark: SparkSession, url: str, statement: str, connection: dict[str, str] | None = None) -> None:
    """Run one statement from the driver, over the JVM's own driver manager."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for key, value in (connection or {}).items():
        properties.setProperty(key, value)
    handle = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        handle.createStatement().executeUpdate(statement)
    finally:
        handle.close()


def jdbc_upsert_sink(
    url: str,
    table: str,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str] | None = None,
    connection: dict[str, str] | None = None,
    execute: Callable[[SparkSession, str, str, dict | None], None] = jdbc_execute,
    stage: Callable[[DataFrame, dict[str, str]], None] | None = None,
    dialect: str = "merge",
    query: str = "upsert",
    column_types: str | None = None,
) -> BatchWriter:
    """Upsert by key: reduce to the last row per key, stage it, merge it in one statement.

    Merging the same rows twice changes nothing, so a replayed batch is harmless. ``order`` tells
    which of several rows of a key is the last; an ``update`` mode aggregate has one row per key
    and needs none. ``query`` names the staging table, so queries on one target do not share it; ``column_types`` gives
    its column types in the target's terms where the driver's defaults do not fit the keys.
    """
    staging = f"{table}_{query}_staging"
    options = insert_options(url, staging, 1000, connection)

    def write_stage(rows: DataFrame, stage_options: dict[str, str]) -> None:
        writer = rows.write.format("jdbc").options(**stage_options).mode("overwrite")
        (writer.option("createTableColumnTypes", column_types) if column_types else writer).save()

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, keys, order) if order else batch
        (stage or write_stage)(rows.select(*keys, *values), options)
        execute(batch.sparkSession, url, merge_statement(table, staging, keys, values, dialect), connection)

    return write


# -- composition --------------------------------------------------------------------------------

def fan_out(*writers: BatchWriter) -> BatchWriter:
    """One micro-batch to several sinks, computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write
