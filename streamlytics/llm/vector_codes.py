"""Vector compression by product codes, with LAESA pivots to prune exact integer distances.

Components are scaled by ``SCALE`` and floored, vectors are cut into ``parts`` equal parts, and each part position has a
codebook of ``ENTRIES`` entries, fitted by rounds of assignment and floored means. All arithmetic is on integers.

Pivots are fixed vectors of each part position, chosen from the first codebook so that they lie far apart. The distances
of all parts to the pivots are computed once and written. In each round a codebook's distances to the pivots give, for
each part and entry, the lower bound ``max |d(part, pivot) - d(entry, pivot)|``. Entries are taken in the order of these
bounds, the least ones first; entries whose bound exceeds the best exact distance found so far are never evaluated.
Bounds are doubles and are lowered by far more than their rounding, so no nearest entry is pruned; ties go to the lower
index.

A round moves, for each task, one sum for each part position and entry to Spark's aggregation; the driver holds codebooks
and pivots only, of ``parts * ENTRIES`` rows, which travel with the tasks.

Defined results: vectors that are null or hold null or non-finite components, and those whose length is not that of
most (of equally frequent lengths the smaller), are dropped. Lengths that ``parts`` does not divide are filled up with
zeros. Rows that share an id are rows of their own, in the order of their components; null ids come after all others.
Fewer than ``ENTRIES`` vectors give a codebook of one entry each. Scaled components of ``LARGEST`` or more raise an
error, as their sums of squares would leave 64 bits. No usable vectors give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.session import materialize

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
PIVOTS = 8  # for each part position
FIRST = 8  # entries evaluated before the bounds are compared with a distance
LARGEST = 1 << 27
TOGETHER = 1 << 11  # parts compared in one call


def whole_vectors(df: DataFrame, vec_id: str, vector: str, *keep: str, parts: int = PARTS) -> DataFrame:
    """``(vec_id, vector array<bigint>, *keep)``: the rows that take part, scaled and floored."""
    given = F.col(vector).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), given.alias("vector"), *(F.col(k) for k in keep))
    rows = rows.filter(F.col("vector").isNotNull() & (F.size("vector") > 0)).filter(finite)
    most = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = most["n"] if most else parts
    whole = F.transform("vector", lambda x: F.when(
        F.abs(x) * SCALE < LARGEST, F.floor(x * SCALE)).otherwise(F.raise_error("a component is too large")))
    zeros = F.array_repeat(F.lit(0).cast("bigint"), -size % parts)
    return rows.filter(F.size("vector") == size).withColumn("vector", F.concat(whole, zeros))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer arrays that broadcast."""
    z = x - y
    return np.einsum("...i,...i->...", z, z)


def _pivots(book: np.ndarray) -> np.ndarray:
    """Entries far from each other: each is the farthest (the first of equals) from those before it."""
    chosen = [0]
    least = _distances(book, book[0])
    while len(chosen) < min(PIVOTS, len(book)):
        chosen.append(int(least.argmax()))
        least = np.minimum(least, _distances(book, book[chosen[-1]]))
    return book[chosen]


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(_distances(x[:, None], pivots[None]).astype(float))


def nearest_entries(x: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each row, its squared distance, and how many distances were evaluated."""
    bound = np.zeros((len(x), len(book)))
    for mine, theirs in zip(to_pivots.T, _to_pivots(book, pivots).T, strict=True):
        np.maximum(bound, np.abs(mine[:, None] - theirs), out=bound)
    # Lowered by a part in 2**30 of the largest distance involved and squared: never above the exact distance.
    slack = (to_pivots.max(1, initial=0) + bound.max(1, initial=0) + 1) * 2.0 ** -30
    bound = np.maximum(bound - slack[:, None], 0) ** 2
    first = np.argpartition(bound, min(FIRST, len(book)) - 1, axis=1)[:, :FIRST]
    found = _distances(x[:, None], book[first])
    best = found.min(1)
    entry = np.where(found == best[:, None], first, len(book)).min(1)
    evaluated = found.size
    np.put_along_axis(bound, first, np.inf, 1)
    row, col = np.nonzero(bound <= best[:, None])
    if len(row):
        # What is left of each row goes by its bound, in steps that double, each against the best of those before.
        order = np.lexsort((bound[row, col], row))
        row, col = row[order], col[order]
        starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        place = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
        low, high = 0, FIRST
        while low <= place.max():
            now = np.flatnonzero((place >= low) & (place < high))
            now = now[bound[row[now], col[now]] <= best[row[now]]]
            if len(now):
                r, c = row[now], col[now]
                far = _distances(x[r], book[c])
                evaluated += len(far)
                order = np.lexsort((c, far, r))
                r, c, far = r[order], c[order], far[order]
                lead = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
                r, c, far = r[lead], c[lead], far[lead]
                better = (far < best[r]) | ((far == best[r]) & (c < entry[r]))
                best[r[better]], entry[r[better]] = far[better], c[better]
            low, high = high, 2 * high
    return entry, best, evaluated


@dataclass(frozen=True)
class Codes:
    """The coded vectors and the codebooks (part, entry, position) they refer to."""

    rows: DataFrame
    books: np.ndarray

    def books_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def _cut(vectors: pd.Series, parts: int) -> np.ndarray:
    """(part, row, position) of a batch."""
    whole = np.stack(vectors.to_numpy()).astype(np.int64)
    return np.ascontiguousarray(whole.reshape(len(whole), parts, -1).transpose(1, 0, 2))


def _measured(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """With ``far``, the distances of each part to its pivots."""
    parts = len(pivots)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cut = _cut(batch["vector"], parts)
                far = np.concatenate([_to_pivots(x, p) for x, p in zip(cut, pivots, strict=True)], 1)
                yield batch.assign(far=list(far))

    return vectors.mapInPandas(measure, "row string, vector array<bigint>, far array<double>")


def _assigned(batch: pd.DataFrame, books: np.ndarray, pivots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each part position the entries of a batch and their squared distances."""
    cut, far = _cut(batch["vector"], len(books)), np.stack(batch["far"].to_numpy())
    width = far.shape[1] // len(books)
    for p, (x, book) in enumerate(zip(cut, books, strict=True)):
        entry, best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for i in range(0, len(x), TOGETHER):
            here = slice(i, i + TOGETHER)
            entry[here], best[here], _ = nearest_entries(x[here], far[here, p * width:(p + 1) * width], book, pivots[p])
        yield entry, best


def _moved(measured: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    parts, entries, size = books.shape

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            if len(batch):
                cut = _cut(batch["vector"], parts)
                for p, (entry, _) in enumerate(_assigned(batch, books, pivots)):
                    np.add.at(total[p], entry, cut[p])
                    count[p] += np.bincount(entry, minlength=entries)
        p, e = np.nonzero(count)
        yield pd.DataFrame({"part": p, "entry": e, "n": count[p, e], "total": list(total[p, e])})

    sums = measured.mapInPandas(gather, "part bigint, entry bigint, n bigint, total array<bigint>")
    added = [F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(size)]
    new = books.copy()
    for part, entry, n, *total in sums.groupBy("part", "entry").agg(F.sum("n"), *added).collect():  # one row an entry
        new[part, entry] = [t // n for t in total]
    return new


def compress(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, rounds: int = ROUNDS) -> Codes:
    """``(vec_id, label, code binary, error)`` for each usable vector: an entry number for each part, and the squared
    distance to what they stand for."""
    given = whole_vectors(df.withColumn("__label", F.col(label)), vec_id, vector, "__label", parts=parts)
    given = materialize(given.withColumnRenamed("__label", "label").withColumn(
        "row", F.to_json(F.struct("vec_id", "label"))), "whole-vectors")
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector").asc()]
    start = np.array([r["vector"] for r in given.select("vec_id", "vector").orderBy(*order).limit(ENTRIES).collect()], np.int64)
    kind = dict(given.dtypes)["label"]
    if not len(start):
        empty = given.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("bigint").alias("error"))
        return Codes(empty, np.zeros((parts, 0, 0), np.int64))
    books = np.ascontiguousarray(start.reshape(len(start), parts, -1).transpose(1, 0, 2))
    pivots = np.stack([_pivots(b) for b in books])
    measured = materialize(_measured(given.select("row", "vector"), pivots), "pivot-distances")
    for _ in range(rounds):
        books = _moved(measured, books, pivots)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                entries, errors = zip(*_assigned(batch, books, pivots), strict=True)
                code = np.stack(entries, 1).astype(np.uint8)
                yield pd.DataFrame({"row": batch["row"], "code": [c.tobytes() for c in code], "error": np.sum(errors, 0)})

    named = F.from_json("row", f"vec_id bigint, label {kind}")
    coded = measured.mapInPandas(assign, "row string, code binary, error bigint").withColumn("named", named)
    return Codes(coded.select("named.vec_id", "named.label", "code", "error"), books)


def with_label_error(rows: DataFrame, label: Column | str = "label") -> DataFrame:
    """With ``label_error``, the error of all rows of a label; null labels are one. One row a label is written before
    the join, so Spark knows its size, and sends it to all tasks only where it is small; a hot label's rows are split
    otherwise."""
    held = materialize(rows.withColumn("__label", F.col(label) if isinstance(label, str) else label), "coded")
    total = materialize(held.groupBy("__label").agg(F.sum("error").alias("label_error")), "label-errors")
    return held.alias("r").join(total.alias("t"), F.expr("r.__label <=> t.__label"), "left").select(
        *(F.col(f"r.{c}") for c in rows.columns), "t.label_error")
