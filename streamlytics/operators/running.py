"""Running aggregates over an ordered history, without one task per key.

A plain ``sum(...) OVER (PARTITION BY key ORDER BY seq)`` puts a key's whole history into one task;
a hot key, or no key at all, then decides how long the job takes. Here the order axis is cut into
chunks of about equal row counts. Each ``(key, chunk)`` is pre-aggregated, the few chunk totals of
a key are accumulated, and each chunk then starts from the total carried into it:

1. quantile cuts of the order column (one column-pruned aggregation),
2. ``groupBy(keys, chunk)`` partial totals; running totals per key over at most ``chunks`` rows,
3. the carried totals join the rows as one extra row at the head of each ``(key, chunk)``, so a
   window over ``(keys, chunk)`` continues from them. Rows move once, spread over key and chunk.

The cuts steer balance only; results do not depend on them.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_CHUNK = 2_000_000
# Quantiles taken in the pass that counts the rows; a longer history takes a second pass for more.
FIRST_CUTS = 1_000
# Chunk numbers hold three counters of this many bits.
PLACE_BITS = 20

_MERGE = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.sum}


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``kind`` (sum, count, max, min) of ``column`` into ``name``.

    ``include_current=False`` covers the rows before the current one only.
    """

    name: str
    kind: str
    column: str | None = None
    include_current: bool = True

    def input(self) -> Column:
        if self.kind == "count":
            return F.lit(1).cast("bigint") if self.column is None else F.col(self.column).isNotNull().cast("bigint")
        return F.col(self.column)


def _cuts(df: DataFrame, column: str, chunks: int | None) -> list[int]:
    """Quantiles of a column, for ``chunks`` chunks or for as many as the rows fill."""
    def quantiles(n: int, *more: Column):
        return df.agg(F.percentile_approx(F.col(column), [i / n for i in range(1, n)], 4 * n).alias("cuts"), *more).first()

    if chunks is not None:
        return quantiles(chunks)["cuts"] or []
    first = quantiles(FIRST_CUTS, F.count(F.lit(1)).alias("n"))
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(2, floor, -(-first["n"] // ROWS_PER_CHUNK))
    if chunks > FIRST_CUTS:
        return quantiles(chunks)["cuts"] or []
    cuts = first["cuts"] or []
    return [cuts[i * len(cuts) // chunks] for i in range(1, chunks)] if cuts else []


def _bucket(df: DataFrame, column: str, splits: Sequence[float], output: str) -> DataFrame:
    """Binary search of a numeric column in sorted split points. The search is on doubles: integers that share one
    share a bucket, so the bucket never decreases along the column."""
    source = f"{output}_x"
    inner = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol=source, outputCol=output,
                       handleInvalid="keep")
    return inner.transform(df.withColumn(source, F.col(column).cast("double"))).drop(source)


def _chunk(df: DataFrame, order: Sequence[str], chunks: int | None) -> DataFrame:
    """Add ``__chunk``, which never decreases along ``order``.

    A value that fills more than one chunk by itself gets a chunk of its own, split further along
    the second order column. Whether a row has such a value is told by integers, not by doubles.
    """
    cuts = _cuts(df, order[0], chunks)
    if not cuts:
        return df.withColumn("__chunk", F.lit(0).cast("bigint"))
    heavy = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    splits = sorted({float(c) for c in cuts})
    out = _bucket(df, order[0], splits, "__b0")
    place, sub = F.lit(0).cast("bigint"), F.lit(0)
    if heavy:
        # A heavy value is a cut, so a row is compared with those of its own bucket only: one, or the few that share a double.
        own: list[list[int]] = [[] for _ in range(len(splits) + 2)]  # the last is that of nulls
        for value in heavy:
            own[bisect.bisect_right(splits, float(value))].append(value)
        here = F.element_at(F.lit([x or [heavy[0]] for x in own]), F.col("__b0").cast("int") + 1)
        place = F.aggregate(here, place, lambda n, value: (  # before it, at it, behind it
            n + (F.col(order[0]) >= value).cast("bigint") + (F.col(order[0]) > value).cast("bigint")))
    if heavy and len(order) > 1:
        inner = sorted({float(c) for c in _cuts(df.filter(F.col(order[0]).isin(heavy)), order[1], len(cuts) + 1)})
        if inner:
            out = _bucket(out, order[1], inner, "__b1")
            sub = F.when(F.col(order[0]).isin(heavy), F.col("__b1")).otherwise(0)
    chunk = F.shiftleft(F.col("__b0").cast("bigint"), 2 * PLACE_BITS) + F.shiftleft(place, PLACE_BITS) + sub.cast("bigint")
    return out.withColumn("__chunk", chunk).drop("__b0", "__b1")


def _carried(kind: str, merged: Column, start: Column | None) -> Column:
    """The value at the head of a chunk: what the chunks before it make of the one carried in."""
    if start is None:
        return merged
    if kind in ("max", "min"):
        return (F.greatest if kind == "max" else F.least)(merged, start)
    return F.when(merged.isNull(), start).when(start.isNull(), merged).otherwise(merged + start)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggregates: Sequence[Running],
    chunks: int | None = None,
    initial: dict[str, object] | DataFrame | None = None,
) -> DataFrame:
    """Add running aggregates per ``keys`` along ``order``.

    ``order`` holds one or two integral, non-null columns that together identify a row's place
    within its key. ``initial`` gives values carried in from before the first row: by aggregate name where
    there are no keys, else a table with one row for each key that has any, of the keys and the aggregates' names.
    Without ``chunks`` their number follows from the rows, ``ROWS_PER_CHUNK`` each. The plan is built by reading the order column once; the input must be repeatable.
    """
    keys, order = list(keys), list(order)
    if not 1 <= len(order) <= 2:
        raise ValueError("order takes one or two columns")
    if initial is not None and bool(keys) != isinstance(initial, DataFrame):
        raise ValueError("initial values are a table with keys, and a dictionary without")
    if chunks is not None:
        chunks = max(2, chunks)

    values = [f"__v{i}" for i in range(len(aggregates))]
    rows = _chunk(df, order, chunks).withColumns({v: a.input() for v, a in zip(values, aggregates)})

    totals = rows.groupBy(*keys, "__chunk").agg(
        *[_MERGE[a.kind](v).alias(v) for v, a in zip(values, aggregates)]
    )
    # At most `chunks` rows per key (in all, when there is no key).
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    heads = totals.select(*keys, "__chunk", *[
        _MERGE[a.kind](v).over(before).alias(v) for v, a in zip(values, aggregates)], F.lit(0).alias("__row"))
    if isinstance(initial, DataFrame):
        same = functools.reduce(Column.__and__, [F.col(f"h.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys])
        given = initial.select(*keys, *[a.name for a in aggregates]).alias("i")
        heads = heads.alias("h").join(given, same, "left")
        starts = {a.name: F.col(f"i.{a.name}") for a in aggregates}
    else:
        heads = heads.alias("h")
        starts = {name: F.lit(value) for name, value in (initial or {}).items() if value is not None}
    heads = heads.select(*[F.col(f"h.{c}") for c in (*keys, "__chunk", "__row")], *[
        _carried(a.kind, F.col(f"h.{v}"), starts.get(a.name)).alias(v) for v, a in zip(values, aggregates)])

    both = rows.withColumn("__row", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    along = Window.partitionBy(*keys, "__chunk").orderBy("__row", *order)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = along.rowsBetween(Window.unboundedPreceding, -1)
    result = both.withColumns({
        a.name: _MERGE[a.kind](v).over(upto if a.include_current else prior)
        for v, a in zip(values, aggregates)
    })
    return result.filter("__row = 1").drop("__row", "__chunk", *values)
