"""Source divergence audit: how far the term shares of the sources of a language lie apart.

Terms are counted in numpy, packed by length. The bytes of a few megabytes of texts are classified at once; terms of up
to 8 bytes become one uint64, those of up to 16 bytes two, most significant byte first, and are radix-sorted (stable
passes over 16-bit digits, equal digits passed over). Longer terms go to buckets of up to 32, 64, 128, ... bytes and are
sorted there as bytes. As the texts stand in the order of their (language, source) group and the sorts are stable, runs of equal terms
fall into runs of one group and one document, so that a pass over the runs gives both the occurrences and the documents of a term.
Tasks merge what they have counted, packed as it is, by the same sort before Spark groups it.

Shares are exact integers in billionths: a group's share of a kept term with ``count`` occurrences is
``1 + floor(10**9 * (count + 5) / (N + 5 * V))``, N the group's occurrences of kept terms and V the language's kept
terms, those in ``LEAST`` of its documents at least. The divergence of two sources is the sum of the differences over all
kept terms. It is summed over blocks of terms and of sources: a block is a dense table of bounded size, terms that no
source of it uses are added by their number.

Defined results: null texts, languages and sources are empty ones. Every row is a document, also a repeated one. A group
without terms has its rows like any other; a language without kept terms has divergence 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlytics.session import materialize

LEAST, TOP = 30, 50
ONE = 1_000_000_000
ADDED = 5
CHUNK = 4 << 20  # bytes of text sorted at once
HELD = 1_500_000  # counts of packed terms that a task holds before it hands them on, of 28 bytes each at most
HELD_LONG = 100_000  # likewise of long terms
TERMS, SOURCES = 4096, 256  # of a block

# The bytes of a term (all but the first 128 that are no letters), A-Z as a-z; 0 for all others.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[:128] = [ord(chr(i).lower()) if chr(i).isalpha() else 0 for i in range(128)]


def _radix(order: np.ndarray, key: np.ndarray) -> np.ndarray:
    """``order`` sorted by ``key[order]``, stable: least digits of 16 bits first."""
    for shift in range(0, 64, 16):
        digit = (key >> np.uint64(shift)).astype(np.uint16)
        if len(digit) and (digit != digit[0]).any():
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def _packed(raw: np.ndarray, start: np.ndarray, size: np.ndarray, at: int) -> np.ndarray:
    """Bytes ``at`` to ``at + 8`` of each term as a number, the first byte the most significant, zeros behind its end."""
    word = np.zeros(len(start), np.uint64)
    for i in range(at, at + 8):
        byte = np.where(i < size, raw[np.minimum(start + i, len(raw) - 1)], 0)
        word = (word << np.uint64(8)) | byte.astype(np.uint64)
    return word


def unpacked(words: list[np.ndarray]) -> np.ndarray:
    """The terms of packed words, as byte strings."""
    return np.stack(words, 1).astype(">u8").view(f"S{8 * len(words)}").ravel()


def _new(order: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Of rows in some order, those that differ from the one before."""
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    return new


def _runs(order: np.ndarray, keys: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by (keys, group, doc): the first row of each (keys, group), its rows and its documents."""
    new = _new(order, [group, *keys])
    first = np.flatnonzero(new)
    fresh = new | _new(order, [doc])
    return order[first], np.diff(np.append(first, len(order))), np.add.reduceat(fresh.astype(np.int64), first)


def _long(raw: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """Terms of at most ``width`` bytes as byte strings; a term has no zero byte."""
    out = np.zeros((len(start), width), np.uint8)
    row = np.repeat(np.arange(len(start)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, at] = raw[start[row] + at]
    return out.view(f"S{width}").ravel()


def count_terms(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[int, np.ndarray, list, np.ndarray, np.ndarray]]:
    """(words, groups, terms, occurrences, documents) of UTF-8 texts given in the order of their groups, a bucket at a
    time. Terms are arrays of their first and second word, or a list of bytes where ``words`` is 0."""
    raw = _LOWER[np.frombuffer(b"\0".join([*texts, b""]), np.uint8)]
    inside = np.concatenate(([False], raw != 0, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, size = edge[::2], edge[1::2] - edge[::2]
    if not len(start):
        return
    doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in texts]))))
    group = groups[doc]
    for words in (1, 2):
        pick = np.flatnonzero((size > 8 * (words - 1)) & (size <= 8 * words))
        if len(pick):
            keys = [_packed(raw, start[pick], size[pick], 8 * i) for i in range(words)]
            order = np.arange(len(pick))
            for key in reversed(keys):
                order = _radix(order, key)
            first, count, docs = _runs(order, keys, group[pick], doc[pick])
            yield words, group[pick][first], [key[first] for key in keys], count, docs
    low = 16
    while low < size.max():
        # No bucket takes more than twice the bytes of its terms.
        pick = np.flatnonzero((size > low) & (size <= 2 * low))
        low *= 2
        if len(pick):
            terms = _long(raw, start[pick], size[pick], low)
            order = np.argsort(terms, kind="stable")
            number = np.zeros(len(order), np.int64)
            number[order] = np.cumsum(np.concatenate(([0], terms[order[1:]] != terms[order[:-1]])))
            first, count, docs = _runs(order, [number], group[pick], doc[pick])
            yield 0, group[pick][first], terms[first].tolist(), count, docs


class Held:
    """Counts of (group, term), merged now and then."""

    def __init__(self):
        self.packed: dict[int, list[tuple]] = {1: [], 2: []}
        self.long: dict[tuple[int, bytes], list[int]] = {}
        self.pending = 0

    def add(self, words: int, group: np.ndarray, terms: list, n: np.ndarray, docs: np.ndarray) -> None:
        if words:
            self.packed[words].append((group.astype(np.int32), *terms, n, docs))
            self.pending += len(group)
            if self.pending > HELD:
                self.merge()
            return
        for key, x, d in zip(zip(group.tolist(), terms, strict=True), n.tolist(), docs.tolist(), strict=True):
            known = self.long.setdefault(key, [0, 0])
            known[0] += x
            known[1] += d

    def merge(self) -> None:
        for words, parts in self.packed.items():
            if len(parts) > 1:
                group, *keys, n, docs = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.argsort(group, kind="stable")
                for key in reversed(keys):
                    order = _radix(order, key)
                new = _new(order, [group, *keys])
                first = np.flatnonzero(new)
                at = order[first]
                parts[:] = [(group[at], *(k[at] for k in keys), np.add.reduceat(n[order], first), np.add.reduceat(docs[order], first))]
        self.pending = sum(len(p[0]) for parts in self.packed.values() for p in parts)

    def full(self) -> bool:
        return self.pending > HELD // 2 or len(self.long) > HELD_LONG

    def take(self) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
        """All of it as (groups, terms, occurrences, documents), some at a time; nothing is held afterwards."""
        self.merge()
        for parts in self.packed.values():
            for group, *keys, n, docs in parts:
                for i in range(0, len(group), 100_000):
                    here = slice(i, i + 100_000)
                    yield group[here], pa.array(unpacked([k[here] for k in keys]), pa.binary()), n[here], docs[here]
            parts.clear()
        keys, values = list(self.long), np.array(list(self.long.values()), np.int64).reshape(-1, 2)
        self.long.clear()
        self.pending = 0
        for i in range(0, len(keys), 10_000):
            part = keys[i:i + 10_000]
            yield (np.array([g for g, _ in part]), pa.array([t for _, t in part], pa.binary()),
                   values[i:i + 10_000, 0], values[i:i + 10_000, 1])


def _segments(text: bytes) -> Iterator[bytes]:
    """A text in parts of some ``CHUNK`` bytes that cut no term."""
    at = 0
    while at < len(text):
        end = min(at + CHUNK, len(text))
        while end < len(text) and _LOWER[text[end]]:
            end += 1
        yield text[at:end]
        at = end


def _counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` of rows ``(lang, source, text)``; a term may have several rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        listed: list[tuple[str, str]] = []
        held = Held()
        texts: list[bytes] = []
        groups: list[int] = []

        def add() -> None:
            order = np.argsort(np.array(groups), kind="stable")
            for found in count_terms([texts[i] for i in order], np.array(groups)[order]):
                held.add(*found)
            texts.clear()
            groups.clear()

        def add_long(text: bytes, group: int) -> None:
            """A text of more than a chunk: all its parts are one document."""
            total = Held()
            for part in _segments(text):
                for found in count_terms([part], np.array([group])):
                    total.add(*found)
            total.merge()
            for words, parts in total.packed.items():
                for of, *keys, n, _ in parts:
                    held.add(words, of, keys, n, np.ones(len(of), np.int64))
            terms, n = [t for _, t in total.long], np.array([x for x, _ in total.long.values()], np.int64)
            held.add(0, np.full(len(terms), group), terms, n, np.ones(len(terms), np.int64))

        def out() -> Iterator[pa.RecordBatch]:
            lang, source = (np.array(x, object) for x in zip(*listed, strict=True))
            for group, terms, n, docs in held.take():
                yield pa.record_batch({
                    "lang": pa.array(lang[group], pa.string()), "source": pa.array(source[group], pa.string()),
                    "term": terms.cast(pa.string()), "n": pa.array(n, pa.int64()), "docs": pa.array(docs, pa.int64())})

        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch[c].to_pylist() for c in ("lang", "source")), batch["text"], strict=True):
                key, raw = (lang, source), text.as_buffer().to_pybytes()
                if key not in names:
                    names[key] = len(listed)
                    listed.append(key)
                if len(raw) > CHUNK:
                    add_long(raw, names[key])
                else:
                    texts.append(raw)
                    groups.append(names[key])
                    size += len(raw)
                if size > CHUNK:
                    add()
                    size = 0
                if held.full():
                    yield from out()
        if texts:
            add()
        if listed:
            yield from out()

    return docs.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")


def _share(count: str, total: str, kept: str) -> Column:
    """The share of a count in billionths; exact beyond 64 bits."""
    return F.expr(f"1 + ((CAST({count} AS DECIMAL(19, 0)) + {ADDED}) * CAST({ONE} AS DECIMAL(10, 0))) div "
                  f"(CAST({total} AS DECIMAL(19, 0)) + {ADDED} * CAST({kept} AS DECIMAL(19, 0)))")


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: the divergence of each two sources of a language, in both directions."""
    block = F.floor(F.col("place") / SOURCES).cast("int")
    # Block a of the sources meets block b >= a of them; a row goes to all meetings of its block.
    meetings = F.transform(F.sequence(F.lit(0), F.col("source_blocks") - 1), lambda i: F.struct(
        F.least(i, block).alias("a"), F.greatest(i, block).alias("b")))
    held = shares.withColumn("t", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int"))
    zeros = groups.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1))).withColumn(
        "term", F.lit(None).cast("string")).withColumn("share", F.col("zero"))
    dealt = held.select("lang", "t", "place", "term", "share", "source_blocks").unionByName(
        zeros.select("lang", "t", "place", "term", "share", "source_blocks")).select(
        "lang", "t", "place", "term", "share", F.inline(meetings))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        base = rows[rows["term"].isna()].sort_values("place")
        rows = rows[rows["term"].notna()]
        places, zero = base["place"].to_numpy(), base["share"].to_numpy().astype(np.int64)
        number, terms = pd.factorize(rows["term"])
        table = np.repeat(zero[:, None], len(terms), 1)
        table[np.searchsorted(places, rows["place"].to_numpy()), number] = rows["share"].to_numpy()
        mine, out = places // SOURCES == base["a"].iloc[0], []
        other = places // SOURCES == base["b"].iloc[0]
        for i in np.flatnonzero(mine):
            j = np.flatnonzero(other & (places > places[i]))
            if len(j):
                out.append(pd.DataFrame({
                    "x": places[i], "y": places[j], "value": np.abs(table[j] - table[i]).sum(1), "seen": len(terms)}))
        return pd.concat(out) if out else pd.DataFrame({c: np.empty(0, np.int64) for c in ("x", "y", "value", "seen")})

    met = dealt.select("lang", "a", "b", "t", "place", "term", "share").groupBy("lang", "a", "b", "t").applyInPandas(
        lambda key, rows: compare(rows).assign(lang=key[0]), "x bigint, y bigint, value bigint, seen bigint, lang string")
    met = met.groupBy("lang", "x", "y").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    met = materialize(met, "met-sources")
    x, y = (groups.select("lang", F.col("place").alias(p), F.col("source").alias(f"source_{p}"), F.col("zero").alias(f"zero_{p}"),
                          *(["kept"] if p == "x" else [])) for p in "xy")
    found = met.join(x, ["lang", "x"]).join(y, ["lang", "y"]).withColumn(
        "value", F.col("value") + (F.col("kept") - F.col("seen")) * F.abs(F.col("zero_x") - F.col("zero_y")))
    way = F.array(F.struct(F.col("source_x").alias("source"), F.col("source_y").alias("item")),
                  F.struct(F.col("source_y").alias("source"), F.col("source_x").alias("item")))
    return found.select("lang", "value", F.inline(way)).select("lang", "source", "item", "value")


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST,
          top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``. Part ``pair``: the divergence of a source from each other one of its
    language, all of them. Part ``term``: the ``top`` terms of which a source has more than its language has."""
    docs = df.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    counts = materialize(_counts(docs).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms-of-sources")
    kept = materialize(counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs")).filter(
        F.col("docs") >= least).drop("docs"), "kept-terms")
    used = materialize(counts.drop("docs").join(kept, ["lang", "term"]), "used-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("all").alias("lang_total"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(
        langs, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("bigint") - 1
    sources = F.count(F.lit(1)).over(Window.partitionBy("lang"))
    groups = groups.withColumn("place", place).withColumn(
        "source_blocks", F.ceil(sources / SOURCES).cast("int")).withColumn(
        "term_blocks", F.greatest(F.ceil(F.col("kept") / TERMS), F.lit(1)).cast("int"))
    zero = F.when(F.col("kept") > 0, _share("0", "total", "kept")).otherwise(0)
    # A row a source: Spark sees how large the written table is, and sends it to all tasks only where it is small.
    groups = materialize(groups.withColumn("zero", zero), "sources")
    shares = used.join(groups, ["lang", "source"]).withColumn("share", _share("n", "total", "kept"))
    pair = _pairs(groups, shares).withColumn("part", F.lit("pair"))
    more = shares.withColumn("value", F.col("share") - _share("all", "lang_total", "kept")).filter(
        "value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [part.withColumn("rank", F.row_number().over(order)) for part in (pair, more)]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
