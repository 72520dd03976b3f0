"""MinHash near-dedup: universal-hash minima, banding, signature check, exact check, connected components.

Documents are sets of word shingles; two are linked when 100 * |A & B| >= percent * |A | B|. The steps:

1. Every text gets the minima of ``bands * rows`` universal hash functions over its shingles, in one pass.
2. Documents with equal sets form a class, named by its smallest id; only classes go on, with the class as the member's
   link. A group of copies of any size is one row from here on.
3. A class meets, in each band, the smallest class of its bucket; the meeting whose signatures agree most is checked on
   the full sets. The links found give first components.
4. Within buckets that still hold several components, classes outside the bucket's largest component meet all classes
   of other components, each pair in the first band it shares, and are checked on the full sets where their signatures
   agree enough. Large buckets are met block by block in many tasks. Only links leave the tasks, and none between
   components that the task has already joined.
5. Components over all confirmed links, by large-star and small-star.

So every pair that shares a bucket is either compared or already connected. The bands, their rows and the least agreement
follow from ``percent`` (:class:`Plan`): a pair at the threshold shares no bucket with a chance of ``UNMET`` at most, and
is dropped by the signature check with a chance of ``DROPPED`` at most.

Defined results: null or empty texts and texts of blanks have 0 shingles and are linked with nothing. Rows that share a
doc_id are one node. A null doc_id cannot be named: such rows are linked with nothing, have a null component and are
kept. Every input row gives one row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.components import components
from streamlytics.llm.shingles import Powers, mixed, shingle_numbers
from streamlytics.session import materialize

WORDS, PERCENT = 5, 80
UNMET, DROPPED = 1e-6, 1e-5  # chances of losing a pair at the threshold
ROWS, MINIMA = 5, 128  # most rows of a band, and minima of all bands unless bands of one row need more
BROADCAST_IDS = 500_000  # numbers of 8 bytes; more of them are joined by a shuffle
BLOCK = 500_000  # shingles of the classes of a bucket that one task holds, twice


@dataclass(frozen=True)
class Plan:
    """Bands, rows of each, and the least share of equal minima (of which a byte each is kept) of a pair to check."""

    bands: int
    rows: int
    least: float

    @staticmethod
    def of(percent: int) -> Plan:
        if not 1 <= percent <= 100:
            raise ValueError(f"percent {percent} is not in 1 to 100")
        share = percent / 100
        for rows in range(ROWS, 0, -1):
            bands = math.ceil(math.log(UNMET) / math.log1p(-share ** rows)) if share < 1 else 1
            if bands * rows <= MINIMA:
                break
        n = bands * rows
        # The fewest equal minima of which fewer come with a chance of DROPPED at most; the first that exceeds it.
        chance, least = 0.0, 0
        while share < 1 and least <= n:
            chance += math.exp(math.lgamma(n + 1) - math.lgamma(least + 1) - math.lgamma(n - least + 1)
                               + least * math.log(share) + (n - least) * math.log1p(-share))
            if chance > DROPPED:
                break
            least += 1
        return Plan(bands, rows, (least if share < 1 else n) / n)


def signatures(df: DataFrame, doc_id: str, text: str, words: int = WORDS, seed: int = 1,
               plan: Plan | None = None) -> DataFrame:
    """``(doc_id, n_shingles, set_a, set_b, minima binary, bands array<bigint>)`` for each row."""

    plan = plan or Plan.of(PERCENT)
    n_bands, n_rows = plan.bands, plan.rows

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng, powers = np.random.default_rng(seed), Powers()
        a = rng.integers(0, 1 << 63, n_bands * n_rows, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        b = rng.integers(0, 1 << 63, n_bands * n_rows, dtype=np.uint64)[:, None]

        for batch in batches:
            out = []
            for key, value in zip(batch["doc_id"], batch["text"], strict=True):
                x = shingle_numbers(value, words, powers)
                if not len(x):
                    out.append((key, 0, 0, 0, None, None))
                    continue
                least = np.full(n_bands * n_rows, np.iinfo(np.uint64).max, np.uint64)
                for i in range(0, len(x), 2048):
                    np.minimum(least, (a * x[i:i + 2048] + b).min(1), out=least)
                rows, band = least.reshape(n_bands, n_rows), np.zeros(n_bands, np.uint64)
                for i in range(n_rows):
                    band = mixed(band * np.uint64(31) + rows[:, i] + np.uint64(i))
                out.append((key, len(x), int(x.sum().view(np.int64)), int(mixed(x + np.uint64(5)).sum().view(np.int64)),
                            mixed(least).astype(np.uint8).tobytes(), band.view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "set_a", "set_b", "minima", "bands"])

    # Ids pass through pandas as strings: numbers with nulls among them would become floats.
    return df.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        sign, "doc_id string, n_shingles bigint, set_a bigint, set_b bigint, minima binary, bands array<bigint>"
    ).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents of some ids."""
    ids = materialize(ids.distinct(), "compared")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``(a, b)`` pairs whose full shingle sets reach the threshold."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers, last, x = Powers(), None, None
        for batch in batches:
            keep = []
            for a, b, text_a, text_b in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"], strict=True):
                if a != last:
                    last, x = a, shingle_numbers(text_a, words, powers)
                y = shingle_numbers(text_b, words, powers)
                if _linked(x, y, percent):
                    keep.append((a, b))
            yield pd.DataFrame(keep, columns=["a", "b"], dtype="int64")

    docs = _only(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    a, b = (docs.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    return pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInPandas(check, "a bigint, b bigint")


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).mean(-1)


def _agreeing(pairs: DataFrame, least: float) -> DataFrame:
    """``(a, b, agreement)`` of pairs that carry both ``minima``, if the signatures agree enough."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), -1) for c in ("x", "y"))
                batch = batch[["a", "b"]].assign(agreement=_agreement(x, y))
                yield batch[batch["agreement"] >= least]

    return pairs.mapInPandas(compare, "a bigint, b bigint, agreement double")


def _met_in_buckets(rows: DataFrame, signed: DataFrame, words: int, percent: int, least: float) -> DataFrame:
    """Links ``(a, b)`` across components, one at least for each two components that share a bucket and are linked
    within it; from rows of ``(band, key, cls, n, component)`` and ``(cls, minima, bands, text)``."""
    own = rows.groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
    buckets = materialize(own.groupBy("band", "key").agg(
        F.max_by("component", "rows").alias("major"), F.ceil(F.sum("n") / F.lit(BLOCK)).cast("int").alias("blocks"),
        F.count(F.lit(1)).alias("parts")).filter("parts > 1"), "shared")
    held = rows.join(buckets, ["band", "key"]).withColumn("minor", F.col("component") != F.col("major"))
    held = held.withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    # Block a of the classes outside the largest component visits block b of all classes; each task holds two blocks.
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    at_home = F.transform(every, lambda i: F.struct(
        i.alias("a"), F.col("own").alias("b"), (F.col("minor") & (i == F.col("own"))).alias("visits"), F.lit(True).alias("home")))
    away = F.transform(F.filter(every, lambda i: F.col("minor") & (i != F.col("own"))), lambda i: F.struct(
        F.col("own").alias("a"), i.alias("b"), F.lit(True).alias("visits"), F.lit(False).alias("home")))
    dealt = held.select("band", "key", "cls", "component", "minor", F.inline(F.concat(at_home, away))).join(signed, "cls")

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        powers, out = Powers(), []
        sign = np.frombuffer(b"".join(group["minima"]), np.uint8).reshape(len(group), -1)
        bands, band = np.stack(group["bands"]), int(group["band"].iloc[0])
        cls, minor, home, visits = (group[c].to_numpy() for c in ("cls", "minor", "home", "visits"))
        part = {c: c for c in group["component"]}  # components joined here need no second link

        def find(c: int) -> int:
            while part[c] != c:
                part[c] = c = part[part[c]]
            return c

        sets: dict[int, np.ndarray] = {}

        def shingles(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingle_numbers(group["text"].iloc[i], words, powers)
            return sets[i]

        component = group["component"].to_numpy()
        for i in np.flatnonzero(visits):
            other = np.flatnonzero(home & (component != component[i]) & (~minor | (cls > cls[i])))
            # A pair meets in the first band it shares.
            other = other[~(bands[other, :band] == bands[i, :band]).any(1)] if band else other
            agreement = _agreement(sign[other], sign[i])
            near = other[agreement >= least]
            for j in near[np.argsort(-agreement[agreement >= least], kind="stable")]:
                x, y = find(component[i]), find(component[j])
                if x != y and _linked(shingles(i), shingles(j), percent):
                    part[x] = y
                    out.append((min(cls[i], cls[j]), max(cls[i], cls[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("band", "key", "a", "b").applyInPandas(meet, "a bigint, b bigint").distinct()


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``df``."""
    plan = Plan.of(percent)
    signed = materialize(signatures(df, doc_id, text, words, plan=plan), "signatures")
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    named = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["set_a", "set_b", "n_shingles"]
    copied = materialize(
        named.groupBy(same).agg(F.min("doc_id").alias("cls"), F.count(F.lit(1)).alias("size")).filter("size > 1"),
        "classes")
    members = materialize(
        named.join(copied, same, "left").select("doc_id", F.coalesce("cls", "doc_id").alias("cls")).distinct(), "members")
    chosen = named.join(members.filter("doc_id = cls").select("cls"), F.col("doc_id") == F.col("cls"))
    signs = materialize(chosen.select("cls", "minima", "bands", F.col("n_shingles").alias("n")), "signs")
    heads = materialize(signs.select("cls", "n", F.posexplode("bands").alias("band", "key")), "buckets")

    hubs = materialize(
        heads.groupBy("band", "key").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).filter("a < z"), "hubs")
    met = heads.join(hubs, ["band", "key"]).filter("cls != a").select("a", F.col("cls").alias("b")).distinct()
    x, y = (signs.select(F.col("cls").alias(c), F.col("minima").alias(d)) for c, d in ("ax", "by"))
    best = _agreeing(met.join(x, "a").join(y, "b").select("a", "b", "x", "y"), plan.least)
    best = materialize(best.groupBy("b").agg(F.max_by("a", "agreement").alias("a")), "met")
    first = materialize(_confirmed(best, docs, words, percent), "links")

    # Rows of one doc_id with different texts tie their classes together.
    several = members.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).filter("a < z")
    tied = members.join(several, "doc_id").select("a", F.col("cls").alias("b"))
    so_far = components(first)
    placed = materialize(heads.join(so_far.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls")), "placed")
    shared = placed.join(
        placed.groupBy("band", "key").agg(F.min("component").alias("x"), F.max("component").alias("z")).filter("x < z"),
        ["band", "key"], "left_semi")
    texts = _only(docs, shared.select(F.col("cls").alias("doc_id"))).select(F.col("doc_id").alias("cls"), "text")
    second = _met_in_buckets(placed, signs.select("cls", "minima", "bands").join(texts, "cls"), words, percent,
                             plan.least)
    second = materialize(second, "links")
    found = components(tied.union(first).union(second))
    named_by = members.join(found, F.col("cls") == F.col("node"), "left").groupBy(
        "doc_id").agg(F.min(F.coalesce("component", "cls")).alias("component"))
    return (
        signed.select("doc_id", "n_shingles").join(named_by, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
