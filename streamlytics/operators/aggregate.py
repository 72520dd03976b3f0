"""Keyed sums, counts, changelogs and combines."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from streamlytics.operators.running import Running, running

# Associative combines Spark has built in; they merge map-side before the shuffle.
COMBINES = {
    "sum": F.sum, "min": F.min, "max": F.max, "product": F.product,
    "and": F.bool_and, "or": F.bool_or, "bit_and": F.bit_and, "bit_or": F.bit_or, "bit_xor": F.bit_xor,
}


# Keys a task holds while combining, and the salts a key's partial results are spread over.
HELD_KEYS = 50_000
NAN = object()


def word_count(words: DataFrame, word: str = "word", name: str = "n") -> DataFrame:
    """``(word, n)``. On a stream, write it in ``update`` or ``complete`` mode."""
    return words.groupBy(word).agg(F.sum(F.lit(1)).alias(name))


def keyed_sum(df: DataFrame, keys: str | Sequence[str], value: str, name: str | None = None) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.sum(value).alias(name or value))


def count_by(df: DataFrame, *keys: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], name: str = "cnt") -> DataFrame:
    """Several groupings in one pass; ``level`` is Spark's grouping id.

    Rows are counted by all keys first, so only those counts are copied per grouping.
    """
    keys = list(dict.fromkeys(key for group in sets for key in group))
    finest = count_by(df, *keys, name="__n")
    return finest.groupingSets([list(g) for g in sets], *keys).agg(
        F.sum("__n").alias(name), F.grouping_id().alias("level")
    )


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                name: str = "total") -> DataFrame:
    """Every input row with the total of its key so far, as a per-record stream sum emits it."""
    return running(df, keys, order, [Running(name, "sum", value)])


def changelog(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
              name: str = "total") -> DataFrame:
    """Updates of a keyed sum as ``(is_latest, keys, order, total)``.

    Each record adds its new total (true) and takes back the previous one (false), if there was one.
    """
    rows = running(df, keys, order, [
        Running("__new", "sum", value), Running("__n", "count"),
        Running("__old", "sum", value, include_current=False),
    ])
    versions = F.array(
        F.struct(F.lit(True).alias("is_latest"), F.col("__new").alias(name)),
        F.struct(F.lit(False).alias("is_latest"), F.col("__old").alias(name)),
    )
    latest = F.slice(versions, F.lit(1), F.when(F.col("__n") > 1, 2).otherwise(1))
    return rows.select(*keys, *order, F.inline(latest)).select("is_latest", *keys, *order, name)


def latest_only(changes: DataFrame) -> DataFrame:
    """The additions of a changelog."""
    return changes.filter("is_latest").drop("is_latest")


def keyed_reduce(df: DataFrame, keys: str | Sequence[str], value: str, combine: str = "sum",
                 name: str | None = None) -> DataFrame:
    """Reduce per key with a built-in associative combine (see ``COMBINES``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(COMBINES[combine](value).alias(name or value))


def keyed_combine(df: DataFrame, keys: str | Sequence[str], value: str,
                  combine: Callable[[object, object], object], name: str | None = None, salts: int = 32) -> DataFrame:
    """Reduce per key with the caller's own associative and commutative function of two values.

    Values are combined where they are read, in a table of at most ``HELD_KEYS`` keys, so a hot key
    leaves a task with few rows. Those are combined per (key, salt) and at last per key, both times
    over rows sorted by key, which holds one value at a time. ``salts`` bounds how many tasks share a key in the middle
    step. All NaN keys are one, as in a grouping.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    name = name or value
    pairs = df.select(*keys, F.col(value).alias(name))
    target = to_arrow_schema(pairs.schema)

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*[[float("nan") if x is NAN else x for x in row] for row in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array(list(column), type=f.type) for column, f in zip(columns, target)], schema=target)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, object]]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(keys) + 1)]
            for *key, item in zip(*columns):
                yield tuple(NAN if x != x else x for x in key), item

    def by_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, object] = {}
        for key, item in rows_of(batches):
            held[key] = combine(held[key], item) if key in held else item
            if len(held) >= HELD_KEYS:
                yield emit([(*k, v) for k, v in held.items()])
                held = {}
        if held:
            yield emit([(*k, v) for k, v in held.items()])

    def by_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, current, total = [], None, None
        for key, item in rows_of(batches):
            if key == current:
                total = combine(total, item)
                continue
            if current is not None:
                done.append((*current, total))
            current, total = key, item
            if len(done) >= HELD_KEYS:
                yield emit(done)
                done = []
        if current is not None:
            yield emit([*done, (*current, total)])

    salted = pairs.mapInArrow(by_hash, pairs.schema).withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    middle = salted.repartition(*keys, "__salt").sortWithinPartitions(*keys).select(*keys, name)
    partial = middle.mapInArrow(by_order, pairs.schema)
    return partial.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(by_order, pairs.schema)


def salted_count(df: DataFrame, keys: Sequence[str | Column], spread: str | Column, salts: int = 10,
                 name: str = "cnt") -> DataFrame:
    """Two-step count: per (keys, salt), then per keys.

    ``spread`` feeds the salt; it must vary within a hot key. Hashing it, rather than drawing a
    random number, keeps a recomputed task's rows in the same place.
    """
    grouped = [k if isinstance(k, str) else k.alias(f"k{i}") for i, k in enumerate(keys)]
    spread = F.col(spread) if isinstance(spread, str) else spread
    first = df.groupBy(*grouped, F.pmod(F.xxhash64(spread), F.lit(salts)).alias("__salt")).agg(
        F.count(F.lit(1)).alias(name)
    )
    columns = [c for c in first.columns if c not in ("__salt", name)]
    return first.groupBy(*columns).agg(F.sum(name).alias(name))
