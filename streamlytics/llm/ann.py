"""Approximate nearest neighbours by cosine over balanced posting lists.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors and ``SAMPLE_FLOATS`` components at most, documented here) by
k-means with a penalty on large clusters. They are kept in memory as a neighbour graph, searched best-first. Every vector
is written to the lists of its nearest centroid and of all others nearly as near (boundary vectors are replicated); a
query reads the lists whose centroids are within a ratio of its nearest one.

There is a list for every ``PER_LIST`` vectors, however many vectors there are. Beyond ``FAN`` lists the centroids form
levels: those of a level split the cells of the one above, each fitted in a task on a bounded sample of its cell, and
vectors and queries descend cell by cell. Lists longer than ``PART`` are dealt over several parts, all of which
a query of the list reads, so no list meets in one task. Parts return their best candidates by exact cosine in double
precision; ties go to the smaller id. Queries that find fewer than ``k`` in their lists are compared with all vectors, in
blocks.

Of equal vectors only the ``k + 1`` with the smallest ids can be among the nearest of anything, so only they are written;
equal queries are searched once. A hot group of copies thus costs what a single vector does.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id and
vectors whose length is not that of most. Rows that share an id are one candidate with the nearest of their vectors, and
are no candidates of their own query. No usable vectors give no rows.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlytics.llm.sampling import hashed_sample
from streamlytics.session import materialize

SAMPLE, SAMPLE_FLOATS = 32_768, 1 << 23
PER_LIST, FAN = 200, 1024
PART = 4096
REPLICAS, SPREAD = 4, 1.1  # lists of a vector, and how much farther than the nearest they may be
PROBES, RATIO = 64, 1.3  # lists of a query, likewise
CELLS, PROBED = 2, 12  # cells of a vector and of a query at each level above the lists
BEAM, LINKS = 96, 24


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, vector array<double>)`` of the rows that take part."""
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(
        finite & F.exists("vector", lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (size["n"] if size else 0))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which is exact, so that their squares stay in range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Centroids:
    """Unit centroids and the graph of their neighbours."""

    def __init__(self, sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 1):
        rng = np.random.default_rng(seed)
        points = np.unique(_unit(sample), axis=0)
        lists = min(lists, len(points))
        at = points[rng.choice(len(points), lists, replace=False)]
        fill = np.zeros(lists)
        for _ in range(rounds):
            near = points @ at.T - 0.05 * fill * lists / len(points)
            own = near.argmax(1)
            fill = np.bincount(own, minlength=lists).astype(float)
            total = np.zeros_like(at)
            np.add.at(total, own, points)
            moved = (fill > 0) & (np.abs(total).max(1) > 1e-9)
            at[moved] = _unit(total[moved])
        self.at = at
        near = at @ at.T
        # The nearest others, and some at random so that every centroid can be reached.
        links = np.argsort(-near, 1, kind="stable")[:, 1:LINKS + 1]
        self.links = np.hstack([links, rng.integers(0, lists, (lists, 4)), (np.arange(lists)[:, None] + 1) % lists])
        self.entry = np.unique(rng.integers(0, lists, 16))

    def search(self, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``n`` nearest centroids of each unit vector found by best-first search, and their distances; -1 pads."""
        beam = max(n, BEAM)
        n = min(n, len(self.at))
        out, far = np.full((len(x), n), -1), np.full((len(x), n), np.inf)
        for i, vector in enumerate(x):
            near = np.full(len(self.at), -np.inf)
            near[self.entry] = self.at[self.entry] @ vector
            best = self.entry[np.argsort(-near[self.entry], kind="stable")]
            opened = np.zeros(len(self.at), bool)
            while len(fresh := best[~opened[best]][:8]):
                opened[fresh] = True
                new = np.unique(self.links[fresh])
                new = new[near[new] == -np.inf]
                near[new] = self.at[new] @ vector
                best = np.concatenate([best, new])
                best = best[np.argsort(-near[best], kind="stable")][:beam]
            best = best[:n]
            out[i, :len(best)] = best
            far[i, :len(best)] = np.sqrt(np.maximum(0, 2 - 2 * near[best]))
        return out, far


    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, at=self.at.astype(np.float32), links=self.links.astype(np.int32), entry=self.entry)
        return out.getvalue()

    @staticmethod
    def unpacked(data: bytes) -> Centroids:
        found, self = np.load(io.BytesIO(data)), Centroids.__new__(Centroids)
        self.at, self.links, self.entry = _unit(found["at"].astype(float)), found["links"], found["entry"]
        return self


def _sampled(size: int, lists: int) -> int:
    """Vectors of ``size`` components that centroids are fitted on."""
    return min(SAMPLE, 32 * lists, max(lists, SAMPLE_FLOATS // size))


def _fit(vectors: DataFrame, lists: int) -> Centroids | None:
    """Centroids of all vectors, fitted on the driver: what it gets is bounded in floats, not in rows alone."""
    first = vectors.first()
    if first is None:
        return None
    bound = _sampled(len(first["vector"]), lists)
    rows = hashed_sample(vectors, F.col("vec_id"), bound).select(
        "vec_id", F.col("vector").cast("array<float>").alias("vector")).toArrow()
    x = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
    x = x[np.lexsort((*x.T[:4], rows["vec_id"].to_numpy()))[:2 * bound]].astype(float)
    x = x[np.isfinite(x).all(1) & (x != 0).any(1)]  # components beyond a float's range
    return Centroids(x, lists) if len(x) else Centroids(np.array([first["vector"]], float), 1)


def _lists_of(batch: pd.DataFrame, centroids: Centroids, most: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) for each list of the vectors of a batch."""
    near, far = centroids.search(_unit(np.stack(batch["vector"])), most)
    row, col = np.nonzero((near >= 0) & (far <= ratio * far[:, :1] + 1e-9))
    return row, near[row, col]


def _placed(rows: DataFrame, centroids: Centroids, most: int, ratio: float) -> DataFrame:
    """``(list, id, vector)`` for each list of a vector."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                row, found = _lists_of(batch, centroids, most, ratio)
                yield pd.DataFrame({"list": found, "id": batch["id"].to_numpy()[row], "vector": batch["vector"].to_numpy()[row]})

    return rows.mapInPandas(place, f"list bigint, id {dict(rows.dtypes)['id']}, vector array<double>")


def _fitted(rows: DataFrame, fan: int) -> DataFrame:
    """``(list, centroids)``: each list split by centroids of its own, fitted on a bounded sample of it."""
    sizes = materialize(rows.groupBy("list").agg(
        F.count(F.lit(1)).alias("n"), F.first(F.size("vector")).alias("size")), "cell-sizes")

    def fit(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("id").drop_duplicates("id")
        lists = int(min(fan, max(1, cell["n"].iloc[0] // PER_LIST)))
        return pd.DataFrame({"list": cell["list"].iloc[:1], "centroids": [Centroids(np.stack(cell["vector"]), lists).packed()]})

    scale = 1 << 31
    bound = F.least(F.lit(SAMPLE), F.lit(32 * fan), F.greatest(F.lit(fan), F.lit(SAMPLE_FLOATS) / F.col("size")))
    some = rows.join(sizes, "list").filter(
        F.pmod(F.xxhash64(F.lit("cell"), F.col("id")), F.lit(scale)) < F.lit(scale) * bound / F.col("n"))
    kept = materialize(some.select("list", "id", "vector", "n"), "cell-samples")
    found = kept.groupBy("list").applyInPandas(fit, "list bigint, centroids binary")
    return materialize(found, "cells")


def _descended(rows: DataFrame, cells: DataFrame, fan: int, most: int, ratio: float) -> DataFrame:
    """As :func:`_placed`, a level down: each row goes to lists of its own list. A list is dealt over several tasks, each
    of which holds the list's centroids. Lists too small for a sample stay whole."""
    parts = materialize(rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")), "cell-parts")
    dealt = rows.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("id", "vector"), F.col("parts")).cast("int"))
    given = cells.join(parts, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    kind = dict(rows.dtypes)["id"]

    def place(batch: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        if not len(batch):
            return pd.DataFrame({"list": [], "id": [], "vector": []})
        row, found = np.arange(len(batch)), 0
        if len(cell):
            row, found = _lists_of(batch, Centroids.unpacked(cell["centroids"].iloc[0]), most, ratio)
        return pd.DataFrame({
            "list": batch["list"].to_numpy()[row] * fan + found, "id": batch["id"].to_numpy()[row],
            "vector": batch["vector"].to_numpy()[row]})

    return dealt.select("list", "part", "id", "vector").groupBy("list", "part").cogroup(
        given.select("list", "part", "centroids").groupBy("list", "part")).applyInPandas(
        place, f"list bigint, id {kind}, vector array<double>")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest ``vectors`` of each of the ``queries`` (both as from
    :func:`usable`) other than those of the query's own id."""
    copies = Window.partitionBy("vector").orderBy("vec_id")
    vectors = materialize(vectors.withColumn("copy", F.row_number().over(copies)).filter(
        F.col("copy") <= k + 1).drop("copy"), "candidates")
    n = vectors.count()
    lists = max(1, n // PER_LIST)
    levels = max(1, math.ceil(math.log(lists) / math.log(FAN) - 1e-9))
    fan = math.ceil(lists ** (1 / levels) - 1e-9)
    centroids = _fit(vectors, fan)
    if centroids is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # Equal vectors are one query; its key is that of the vector.
    key = F.concat_ws("-", F.hex(F.xxhash64("vector")), F.hex(F.xxhash64(F.lit(1), "vector")))
    named = materialize(queries.select(F.col("vec_id").alias("query_id"), key.alias("key"), "vector"), "queries")
    asking = materialize(named.groupBy("key").agg(F.first("vector").alias("vector")).withColumnRenamed("key", "id"), "asked")
    last = levels == 1
    held = materialize(_placed(vectors.withColumnRenamed("vec_id", "id"), centroids, REPLICAS if last else CELLS, SPREAD), "lists")
    asked = _placed(asking, centroids, PROBES if last else PROBED, RATIO)
    for level in range(2, levels + 1):
        last = level == levels
        cells = _fitted(held, fan)
        held = materialize(_descended(held, cells, fan, REPLICAS if last else CELLS, SPREAD).distinct(), "lists")
        asked = materialize(_descended(asked, cells, fan, PROBES if last else PROBED, RATIO).distinct(), "asked-lists")
    # A row a list, written: Spark sends it to all tasks only where it is small.
    parts = materialize(held.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")), "list-parts")

    def best(here: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(here) and len(asking):
            ids, rows = here["id"].to_numpy(), _scaled(np.stack(here["vector"]))
            length = np.sqrt((rows * rows).sum(1))
            for query, vector in zip(asking["id"], _scaled(np.stack(asking["vector"])), strict=True):
                # Sums along rows, not a matrix product: equal vectors get equal scores wherever they lie.
                score = (rows * vector).sum(1) / (length * np.sqrt((vector * vector).sum()))
                top = np.lexsort((ids, -score))
                _, first = np.unique(ids[top], return_index=True)
                out += [(query, ids[i], score[i]) for i in top[np.sort(first)[:k + 1]]]
        return pd.DataFrame(out, columns=["key", "vec_id", "score"])

    def met(held: DataFrame, asked: DataFrame) -> DataFrame:
        """``(query_id, vec_id, score)`` of what lists and queries of the same part find, without the query's own id."""
        found = held.select("list", "part", "id", "vector").groupBy("list", "part").cogroup(
            asked.select("list", "part", "id", "vector").groupBy("list", "part")).applyInPandas(
            best, "key string, vec_id bigint, score double").groupBy("key", "vec_id").agg(F.max("score").alias("score"))
        of_key = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
        found = found.withColumn("rank", F.row_number().over(of_key)).filter(F.col("rank") <= k + 1)
        return materialize(found.join(named.select("key", "query_id"), "key").filter(
            F.col("vec_id") != F.col("query_id")).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "met")

    found = met(
        held.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")),
        asked.join(parts, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    # Queries whose lists hold fewer than k others meet all vectors, in blocks.
    enough = found.groupBy("query_id").count().filter(F.col("count") >= k)
    short = materialize(named.join(enough, "query_id", "left_anti"), "short")
    if not short.isEmpty():
        blocks = -(-n // PART)
        every = vectors.withColumnRenamed("vec_id", "id").withColumn("list", F.lit(0)).withColumn(
            "part", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        again = short.groupBy("key").agg(F.first("vector").alias("vector")).withColumnRenamed("key", "id").withColumn(
            "list", F.lit(0)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        others = short.select("query_id").distinct()
        found = found.join(others, "query_id", "left_anti").unionByName(
            met(every, again).join(others, "query_id", "left_semi"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
