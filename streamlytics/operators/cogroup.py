"""Two inputs brought together by key for a function of the caller's.

Both sides are dealt and sorted by key, so a task passes from key to key and hands the function the rows of each side as
Arrow batches one after another; nothing of a key is gathered unless the function does so. Where the function treats the
rows of one side one by one, that side may be dealt over several tasks for keys that have very many, each with all of the
other side's rows of the key.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from streamlytics.session import materialize

ROWS = 1_000_000  # of a dealt side and key in a task
TOGETHER = 4096  # rows of results that leave a task at once
MANY = 100_000  # rows of a key from which on it has a call of its own, where a function takes many keys at once
Batches = Iterator[pa.RecordBatch]
CoFunction = Callable[[tuple, Batches, Batches], Batches]


def _changes(column: pa.Array) -> np.ndarray:
    """Places at which a column differs from the row before; null equals null."""
    before, after = column[:-1], column[1:]
    differs = pc.fill_null(pc.not_equal(before, after), False)
    nulls = pc.xor(pc.is_null(before), pc.is_null(after))
    return np.flatnonzero(pc.or_(differs, nulls).to_numpy(zero_copy_only=False)) + 1


def _pieces(batches: Batches, n_keys: int) -> Iterator[tuple[tuple, int, pa.RecordBatch]]:
    """(key, side, rows) of stretches with one key and side; a long stretch comes in several pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        heads = [batch.column(i) for i in range(n_keys + 1)]
        cuts = functools.reduce(np.union1d, [_changes(c) for c in heads]) if batch.num_rows > 1 else []
        edges = [0, *map(int, cuts), batch.num_rows]
        for a, b in itertools.pairwise(edges):
            side = heads[-1][a].as_py()
            rows = pa.RecordBatch.from_struct_array(batch.column(n_keys + 1 + side).slice(a, b - a))
            yield tuple(c[a].as_py() for c in heads[:-1]), side, rows


def _key_edges(batch: pa.RecordBatch, n_keys: int) -> list[int]:
    """Where the keys of a sorted batch begin, and its end."""
    cuts = functools.reduce(np.union1d, [_changes(batch.column(i)) for i in range(n_keys)]) if batch.num_rows > 1 else []
    return [0, *map(int, cuts), batch.num_rows]


def _of_side(batch: pa.RecordBatch, n_keys: int, edges: list[int], side: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows of a side and the number of the key of each."""
    at = np.flatnonzero(batch.column(n_keys).to_numpy() == side)
    rows = pa.RecordBatch.from_struct_array(batch.column(n_keys + 1 + side).take(pa.array(at)))
    return rows, np.searchsorted(edges, at, "right") - 1


class _OneKey:
    """The two sides of a key; the first has to be read before the second, and what is left of it is passed over."""

    def __init__(self, pieces: Iterator[tuple[tuple, int, pa.RecordBatch]]):
        self.pieces = pieces
        self.ahead = next(pieces, None)

    def side(self, number: int) -> Batches:
        while self.ahead is not None and self.ahead[1] <= number:
            side, rows = self.ahead[1:]
            self.ahead = next(self.pieces, None)
            if side == number:
                yield rows


def co_group(left: DataFrame, right: DataFrame, keys: Sequence[str], function: CoFunction, schema: str,
             order: Sequence[str] = (), first: str = "left", deal: str | None = None, rows: int = ROWS) -> DataFrame:
    """The batches that ``function(key, left, right)`` yields for each key of either side.

    ``left`` and ``right`` are iterators over the rows of the key, all columns of a side, by the ``order`` columns (of both
    sides) if there are any. The side ``first`` is to be read before the other; the function holds what it needs of it.
    ``deal`` names a side whose rows the function treats one by one: for a key with more than ``rows`` of them, they are
    dealt over several calls, each with all rows of the other side, which must then come first. Null keys are a key.

    A function may have an attribute ``many(nulls, left, left_key, right, right_key)`` that gives the same for many keys at
    once: all rows of a side, the number of the key of each, ascending, and whether a key has a null. Keys of fewer than
    ``MANY`` rows then go through it, some thousand rows together.
    """
    if first not in ("left", "right") or deal not in (None, "left", "right") or deal == first:
        raise ValueError("first and deal name different sides")
    sides, n_keys = {"left": left, "right": right}, len(keys)
    parts = None
    if deal:
        counted = sides[deal].groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias("__parts"))
        parts = materialize(counted.filter("__parts > 1"), "hot-keys")
    shaped = []
    for name, df in sides.items():
        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        given = df.select(*keys, *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], whole.alias("__row"))
        place = F.lit(0)
        if parts is not None:
            same = functools.reduce(Column.__and__, [F.col(f"g.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys])
            given = given.alias("g").join(parts.alias("p"), same, "left").select("g.*", F.coalesce("__parts", F.lit(1)).alias("__parts"))
            place = (F.pmod(F.xxhash64("__row"), F.col("__parts")).cast("int") if name == deal
                     else F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
        # The side that is read first sorts first.
        other = F.lit(None).cast(sides["right" if name == "left" else "left"].select(F.struct("*")).schema[0].dataType)
        number = int(name != first)
        cells = {number: F.col("__row"), 1 - number: other}
        shaped.append(given.withColumn("__place", place).select(
            *keys, F.lit(number).alias("__side"), cells[0].alias("__a"), cells[1].alias("__b"), "__place",
            *[f"__o{i}" for i in range(len(order))]))
    both = shaped[0].unionByName(shaped[1]).repartition(*keys, "__place").sortWithinPartitions(
        "__place", *keys, "__side", *[f"__o{i}" for i in range(len(order))])
    both = both.select("__place", *keys, "__side", "__a", "__b")
    swapped, target = first == "right", to_arrow_schema(left.sparkSession.createDataFrame([], schema).schema)

    def fitted(made: pa.RecordBatch) -> pa.RecordBatch:
        if made.schema.equals(target):
            return made
        return pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in (
            (made.column(f.name), f) for f in target)], schema=target)

    def by_key(batches: Batches) -> Batches:
        held, n = [], 0  # small results go on together
        for (_, *key), pieces in itertools.groupby(_pieces(batches, n_keys + 1), key=lambda piece: piece[0]):
            of_key = _OneKey(pieces)
            one, two = of_key.side(0), of_key.side(1)
            for made in function(tuple(key), *((two, one) if swapped else (one, two))):
                held.append(fitted(made))
                n += made.num_rows
                if n >= TOGETHER:
                    yield pa.concat_batches(held)
                    held, n = [], 0
        if held:
            yield pa.concat_batches(held)

    def whole_keys(batch: pa.RecordBatch) -> Batches:
        edges = _key_edges(batch, n_keys + 1)
        heads = batch.take(pa.array(edges[:-1]))
        nulls = functools.reduce(np.logical_or, [pc.is_null(heads.column(1 + i)).to_numpy(zero_copy_only=False) for i in range(n_keys)])
        one, two = (_of_side(batch, n_keys + 1, edges, side) for side in (0, 1))
        for made in function.many(nulls, *(*two, *one) if swapped else (*one, *two)):
            yield fitted(made)

    def by_many(batches: Batches) -> Batches:
        ahead = None  # the last key so far, which may go on

        def of_first(batch: pa.RecordBatch) -> Batches:
            """``batch``, all of one key, and what follows of that key; the rest is left in ``ahead``."""
            nonlocal ahead
            first = batch.slice(0, 1)
            yield batch
            for batch in batches:
                if batch.num_rows:
                    edges = _key_edges(pa.concat_batches([first, batch]), n_keys + 1)
                    if edges[1] > 1:
                        yield batch.slice(0, edges[1] - 1)
                    if len(edges) > 2:
                        ahead = batch.slice(edges[1] - 1)
                        return

        batches = iter(batches)
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.concat_batches([ahead, batch]) if ahead is not None else batch
            last = _key_edges(batch, n_keys + 1)[-2]
            if last:
                yield from whole_keys(batch.slice(0, last))
            ahead = batch.slice(last)
            if not last and batch.num_rows >= MANY:
                ahead, rows_of_key = None, of_first(batch)
                yield from by_key(rows_of_key)
                for _ in rows_of_key:  # what the function did not read
                    pass
        if ahead is not None:
            yield from whole_keys(ahead)

    run = by_many if hasattr(function, "many") else by_key
    return both.mapInArrow(run, schema)


def left_outer(left_prefix: str, right_prefix: str, columns: Sequence[str]) -> CoFunction:
    """A function that gives each left row with all right rows of its key, or with nulls; right rows are held. ``columns``
    are those of the result: a prefixed name is the column of that side, any other one of the left side."""

    def joined(key: tuple, left: Batches, right: Batches) -> Batches:
        held = [] if None in key else list(right)  # a key with a null meets nothing
        table = pa.concat_batches(held) if held else None
        n = table.num_rows if held else 0
        for batch in left:
            if n > 1:
                batch = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), n)))
            place = pa.array(np.arange(batch.num_rows) % n) if n else None
            yield pa.RecordBatch.from_arrays([
                batch.column(c.removeprefix(left_prefix)) if not c.startswith(right_prefix)
                else table.column(c.removeprefix(right_prefix)).take(place) if n else pa.nulls(batch.num_rows) for c in columns],
                names=list(columns))

    def many(nulls: np.ndarray, left: pa.RecordBatch, left_key: np.ndarray, right: pa.RecordBatch, right_key: np.ndarray) -> Batches:
        met = np.bincount(right_key, minlength=len(nulls))
        met[nulls] = 0
        n, start = met[left_key], np.searchsorted(right_key, left_key)
        ends = np.cumsum(np.maximum(n, 1))
        a = 0
        while a < left.num_rows:  # some thousand rows of the result at once, and all of a left row
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 16 * TOGETHER, "right")))
            times = np.maximum(n[a:b], 1)
            at = np.repeat(np.arange(a, b), times)
            place = start[at] + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            one, two = pa.array(at), pa.array(place, mask=n[at] == 0)
            yield pa.RecordBatch.from_arrays([
                right.column(c.removeprefix(right_prefix)).take(two) if c.startswith(right_prefix)
                else left.column(c.removeprefix(left_prefix)).take(one) for c in columns], names=list(columns))
            a = b

    joined.many = many
    return joined


def count_between(time: str, tie: str, name: str) -> CoFunction:
    """A function that gives each left row, in the order of ``(time, tie)``, with the number of right rows since the left row
    before it. Only places of left rows are held."""

    def counted(key: tuple, left: Batches, right: Batches) -> Batches:
        held = list(left)
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        marks = np.rec.fromarrays([rows.column(c).to_numpy() for c in (time, tie)], names="t,i")
        counts = np.zeros(len(marks) + 1, np.int64)
        for batch in right:
            at = np.rec.fromarrays([batch.column(c).to_numpy() for c in (time, tie)], names="t,i")
            np.add.at(counts, np.searchsorted(marks, at), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * len(marks)), rows.column(tie).combine_chunks(), pa.array(counts[:-1])],
            names=["user_id", tie, name])

    return counted
