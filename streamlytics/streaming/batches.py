"""Operators that run a batch plan on every micro-batch."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from streamlytics.operators.bloom import Bloom, bloom_parts, first_seen_bloom, first_sightings, merge_parts
from streamlytics.operators.joins import repair_late_items
from streamlytics.operators.late import flag_late
from streamlytics.operators.running import Running, running
from streamlytics.operators.sequence import first_seen
from streamlytics.operators.topk import top_n
from streamlytics.streaming.keyed import KeyedTable
from streamlytics.streaming.sinks import BatchTable, BatchWriter

# A micro-batch of up to this many rows has its keys sent to the tasks that read the table it is joined with.
LOOKED_UP = 100_000


def top_n_stream(counts: DataFrame, groups: Sequence[str], by: str, ties: Sequence[str], sink: BatchWriter,
                 n: int = 3) -> DataStreamWriter:
    """Top rows per group of a windowed aggregate, as windows close.

    In append mode all groups of a window leave the state in the same micro-batch, the one in which
    the watermark passes its end. Ranking that batch is therefore exact, keeps no list in state,
    and cuts each task to ``n`` rows per group before the shuffle.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(top_n(batch, groups, by, ties, n), batch_id)

    return counts.writeStream.outputMode("append").foreachBatch(write)


def repair_stream(items: DataFrame, orders: DataFrame, key: str, arrival: Sequence[str], size_ms: int, sink: BatchTable,
                  progress: BatchTable, delay_ms: int = 0, ms: str = "time") -> DataStreamWriter:
    """Late and unmatched items of a stream looked up in the order table, micro-batch by micro-batch.

    ``orders`` is a table, read anew for each batch. Which items are late is told as in :func:`late_split_stream`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = progress.read_batch(spark, batch_id - 1).first()[0] if batch_id else None
        batch.persist()
        try:
            flagged = flag_late(batch, arrival, size_ms, delay_ms, ms, earlier)
            placed = orders
            if batch.count() <= LOOKED_UP:
                # Only the orders of these items leave their tasks.
                keys = batch.select(F.col(key).alias("__key")).distinct()
                placed = orders.join(F.broadcast(keys), F.col(key) == F.col("__key"), "left_semi")
            sink.write(repair_late_items(flagged, placed, placed, key, f"{size_ms} milliseconds"), batch_id)
            progress.write(batch.agg(F.greatest(F.max(ms), F.lit(earlier).cast("bigint")).alias("max_ms")), batch_id)
        finally:
            batch.unpersist()

    return items.writeStream.outputMode("append").foreachBatch(write)


def late_split_stream(
    rows: DataFrame,
    arrival: Sequence[str],
    size_ms: int,
    on_time: BatchTable,
    late: BatchTable,
    progress: BatchTable,
    delay_ms: int = 0,
    ms: str = "time",
) -> DataStreamWriter:
    """Split a stream into rows on time and late rows, with the answer of one pass in ``arrival`` order.

    The stream must carry no watermark: Spark would drop late rows unseen. Each micro-batch runs
    :func:`flag_late` from the largest event time of the batches before, which it keeps in
    ``progress`` under its batch number, so a replayed batch starts from the same value.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = progress.read_batch(spark, batch_id - 1).first()[0] if batch_id else None
        batch.persist()
        flagged = flag_late(batch, arrival, size_ms, delay_ms, ms, earlier).persist()
        try:
            on_time.write(flagged.filter("not is_late").drop("is_late"), batch_id)
            late.write(flagged.filter("is_late").drop("is_late"), batch_id)
            newest = F.greatest(F.max(ms), F.lit(earlier).cast("bigint")).alias("max_ms")
            progress.write(batch.agg(newest), batch_id)
        finally:
            flagged.unpersist()
            batch.unpersist()

    return rows.writeStream.outputMode("append").foreachBatch(write)


def running_stream(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, state: KeyedTable,
                   sink: BatchTable, name: str = "total") -> DataStreamWriter:
    """Every row of a stream with the sum of its key so far, micro-batch by micro-batch and within one along ``order``.

    The sums carried from batch to batch are kept in ``state``, a table with the keys ``keys``; a batch reads and writes what
    lies in the buckets of its keys. Within a batch a hot key is spread over chunks of the order, as in
    :func:`~streamlytics.operators.running.running`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            added = batch.groupBy(*keys).agg(F.sum(value).alias(name))
            before = state.lookup(added, added.schema, before_batch=batch_id)
            out = running(batch, keys, order, [Running(name, "sum", value)], initial=before)
            sink.write(out.select(*batch.columns, name), batch_id)
            state.upsert(added, batch_id, {name: "sum"})
        finally:
            batch.unpersist()

    return rows.writeStream.outputMode("append").foreachBatch(write)


def first_seen_bloom_stream(rows: DataFrame, groups: Sequence[str], member: str, order: str, row_id: str, state: KeyedTable,
                            sink: BatchTable, column: str = "nu", bloom: Bloom = Bloom()) -> DataStreamWriter:
    """:func:`~streamlytics.operators.bloom.first_seen_bloom` micro-batch by micro-batch. The filters so far are kept in
    ``state``, a table with the keys ``(*groups, "bucket")``, of which a batch reads and writes what its members touch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            members = first_sightings(batch, [*groups, member], order, row_id)
            parts = bloom_parts(members, groups, member, bloom).persist()
            filters = state.lookup(parts, parts.schema, before_batch=batch_id)
            sink.write(first_seen_bloom(batch, groups, member, order, row_id, column, bloom, filters), batch_id)
            state.upsert(parts, batch_id, merge=lambda both: merge_parts(both, groups))
            parts.unpersist()
        finally:
            batch.unpersist()

    return rows.writeStream.outputMode("append").foreachBatch(write)


def average_every_batches(rows: DataFrame, key: str, value: str, order: Sequence[str], state: KeyedTable, sink: BatchTable,
                          n: int = 3) -> DataStreamWriter:
    """Mean of every ``n`` consecutive values per key, ``(key, avg)``, micro-batch by micro-batch and within one along
    ``order``. Of a key only the number of its values and the sum of those not averaged yet are carried, in ``state`` (a
    table with the key ``key``); within a batch its values are numbered as in
    :func:`~streamlytics.operators.running.running`, so no task holds those of a hot key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            counted = batch.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"), F.lit(0.0).alias("part"))
            before = state.lookup(counted, counted.schema, before_batch=batch_id).persist()
            numbered = running(batch, [key], order, [Running("__rn", "count")], initial=before.select(key, F.col("cnt").alias("__rn")))
            group = F.floor((F.col("__rn") - 1) / n).alias("__group")
            here = numbered.groupBy(key, group).agg(F.count(F.lit(1)).alias("__n"), F.sum(F.col(value).cast("double")).alias("__sum"))
            # The first group of a key may have begun in an earlier batch.
            same = F.col(f"h.{key}").eqNullSafe(F.col(f"b.{key}")) & (F.col("__group") == F.floor(F.col("b.cnt") / n))
            whole = here.alias("h").join(before.alias("b"), same, "left").select(
                f"h.{key}", (F.col("__n") + F.coalesce(F.col("b.cnt") % n, F.lit(0))).alias("__n"),
                (F.col("__sum") + F.coalesce("b.part", F.lit(0.0))).alias("__sum")).persist()
            sink.write(whole.filter(F.col("__n") == n).select(key, (F.col("__sum") / n).alias("avg")), batch_id)
            open_ = whole.filter(F.col("__n") < n).select(key, F.col("__sum").alias("part")).alias("o")
            left = counted.drop("part").alias("c").join(open_, F.col(f"c.{key}").eqNullSafe(F.col(f"o.{key}")), "left")
            left = left.select(f"c.{key}", "cnt", F.coalesce("part", F.lit(0.0)).alias("part"))
            state.upsert(left, batch_id, {"cnt": "sum"})
            whole.unpersist()
            before.unpersist()
        finally:
            batch.unpersist()

    return rows.writeStream.outputMode("append").foreachBatch(write)


def first_seen_batches(rows: DataFrame, identity: Sequence[str], order: Sequence[str], row_id: str, state: KeyedTable,
                       sink: BatchTable, column: str = "nu") -> DataStreamWriter:
    """Set ``column`` to 1 on the first row of each identity, that of the earliest micro-batch and within it the first along
    ``order``. The identities so far are kept in ``state``, a table with the keys ``identity``; a batch reads and writes
    what lies in the buckets of its own, and a busy identity is one row of it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            here = batch.select(*identity).distinct().withColumn("seen", F.lit(True))
            known = state.lookup(here, here.schema, before_batch=batch_id).alias("k")
            marked = first_seen(batch.withColumn("__first", F.lit(0)), identity, order, row_id, "__first").alias("m")
            same = functools.reduce(Column.__and__, [F.col(f"m.{c}").eqNullSafe(F.col(f"k.{c}")) for c in identity])
            new = (F.col("m.__first") == 1) & F.col("k.seen").isNull()
            current = F.col(f"m.{column}") if column in batch.columns else F.lit(0)
            sink.write(marked.join(known, same & (F.col("m.__first") == 1), "left").select(
                *[F.col(f"m.{c}") for c in batch.columns if c != column],
                F.when(new, 1).otherwise(current).cast("int").alias(column)), batch_id)
            state.upsert(here, batch_id)
        finally:
            batch.unpersist()

    return rows.writeStream.outputMode("append").foreachBatch(write)
