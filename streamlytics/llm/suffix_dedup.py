"""Exact substring dedup by prefix doubling.

A byte is removed when it lies in a string of ``length`` bytes that also starts anywhere else. Positions are ranked by
the string that starts there, and ranks of length n give ranks of length n + step from the pair at ``(i, i + step)``.
A rank is a 64-bit name, equal for equal strings, so the early doublings (1, 2, 4, ... bytes up to ``length / 2``) need
no exchange and run within a text. From there on Spark ranks, and positions whose name is unique drop out:

1. Names of half the length: of these only the least of each ``length`` window is kept (equal windows keep equal
   names), which leaves about one in 50 positions. The windows that share such a place are a run and one row. Spark
   counts the names; runs with a unique name hold no repeat and are gone.
2. Whole runs: runs of one name with equal content are repeated in all their windows. Where all runs of a name are
   equal, nothing is left to do.
3. The last doubling, half the length to the whole: one run of each content left is ranked window by window against
   the other contents of its name, many names in a call. Names with more than ``GROUP`` contents are ranked by a
   distributed count of their windows.

Ranking all positions by plain rounds would sort every byte of the input as a row of two ranks and a position, some
fifteen times the input in each round; see the README for figures.

Names are compared only with names of the same least name, so two different strings count as equal only if two
64-bit names collide at once. Every row of the input gives a row. Null texts are empty. Rows with the same id and text
(null ids are one id) are copies of each other like any other rows: all their windows are repeated, so they need no spans
of their own, however many they are. Names are made for ``SEGMENT`` bytes of a text at a time, in some 60 bytes for each;
beyond that a text takes its own length a few times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.session import materialize

LENGTH = 200
GROUP = 10_000  # runs of a name, of some 300 bytes each, that one task ranks
TOGETHER = 2_000  # runs ranked in one call, of as many names as it takes
SEGMENT = 4 << 20  # bytes of a text whose windows are named at once
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The name of a pair of names."""
    z = x * _A
    z += y
    z ^= z >> np.uint64(31)
    z *= _B
    z ^= z >> np.uint64(29)
    return z


def _names(raw: np.ndarray, n: int) -> np.ndarray:
    """The names of all strings of ``n`` bytes, by doubling."""
    names, size = _pair(raw.astype(np.uint64) + np.uint64(1), np.uint64(7)), 1
    while size < n:
        step = min(size, n - size)
        names = _pair(names[:-step], names[step:])
        size += step
    return names


def _least(names: np.ndarray, n: int) -> np.ndarray:
    """The place of the least name (of its upper half, the first of equals) among each ``n`` neighbours, by doubling."""
    best, size = (names >> np.uint64(32) << np.uint64(32)) | np.arange(len(names), dtype=np.uint64), 1
    while size < n:
        step = min(size, n - size)
        best = np.minimum(best[:-step], best[step:])
        size += step
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _half(length: int) -> int:
    return (length + 1) // 2


def _runs(df: DataFrame, length: int) -> DataFrame:
    """``(name, content, doc_id, text_hash, s, e)``: windows s .. e - length share the place of their least
    half-length name, so no two windows of a run are equal."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        half, powers, inverse = _half(length), np.ones(1, np.uint64), np.ones(1, np.uint64)
        for batch in batches:
            out = []
            for key, mark, text in zip(batch["doc_id"], batch["text_hash"], batch["text"], strict=True):
                data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
                # Windows that start within a segment; a run cut by its end is two runs, which the last step compares.
                for offset in range(0, len(data) - length + 1, SEGMENT):
                    raw = data[offset:offset + SEGMENT + length - 1]
                    names = _names(raw, half)
                    if len(names) >= len(powers):
                        powers, inverse = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(
                            2 * len(names), x, np.uint64)))) for x in (int(_A), pow(int(_A), -1, 1 << 64)))
                    least = _least(names, length - half + 1)
                    cut = np.flatnonzero(least[1:] != least[:-1]) + 1
                    first = np.concatenate(([0], cut))
                    last = np.concatenate((cut, [len(least)])) - 1  # the last window of each run
                    total = np.zeros(len(names) + 1, np.uint64)
                    np.cumsum(names * powers[:len(names)], out=total[1:])
                    end = last + length - half + 1
                    content = _pair((total[end] - total[first]) * inverse[first], (last - first).astype(np.uint64))
                    out.append((names[least[first]].view(np.int64), content.view(np.int64), np.full(len(first), key),
                                np.full(len(first), mark), (offset + first).astype(np.int32),
                                (offset + last + length).astype(np.int32)))
            if out:
                found = pd.DataFrame(dict(zip(
                    ("name", "content", "doc_id", "text_hash", "s", "e"), map(np.concatenate, zip(*out, strict=True)), strict=True)))
                for i in range(0, len(found), 50_000):
                    yield found[i:i + 50_000]

    return df.mapInPandas(find, "name bigint, content bigint, doc_id bigint, text_hash bigint, s int, e int")


def _windows(group: pd.DataFrame, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row number, position, name) of every window of the ``bytes``."""
    half = _half(length)
    sizes = group["bytes"].map(len).to_numpy()
    names = _names(np.frombuffer(b"".join(group["bytes"]), np.uint8), half)
    row = np.repeat(np.arange(len(group)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    start = np.flatnonzero(at <= sizes[row] - length)
    return row[start], at[start], _pair(names[start], names[start + length - half])


def _contents(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """``(name, content, bytes)``: the bytes of one run for each row of ``reps``."""
    wanted = reps.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("name", "content", "s", "e")).alias("runs"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, runs in zip(batch["text"], batch["runs"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                out += [(r["name"], r["content"], raw[r["s"]:r["e"]]) for r in runs]
            yield pd.DataFrame(out, columns=["name", "content", "bytes"])

    return docs.alias("d").join(
        wanted.alias("w"), ["doc_id", "text_hash"]
    ).select("d.text", "w.runs").mapInPandas(cut, "name bigint, content bigint, bytes binary")


def _repeated_windows(contents: DataFrame, length: int) -> DataFrame:
    """``(name, content, s, e)``: windows (relative spans) that occur in two contents of a name."""

    def within(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["name", "content"]).reset_index(drop=True)
        row, at, names = _windows(group, length)
        _, number, count = np.unique(
            _pair(group["name"].to_numpy().view(np.uint64)[row], names), return_inverse=True, return_counts=True)
        hit = count[number] > 1
        row, at = row[hit], at[hit]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(row) != 0) | (np.diff(at) != 1)))) if len(at) else at
        stop = np.concatenate((new[1:], [len(at)])) - 1 if len(at) else at
        return pd.DataFrame({
            "name": group["name"].to_numpy()[row[new]], "content": group["content"].to_numpy()[row[new]],
            "s": at[new].astype(np.int32), "e": (at[stop] + length).astype(np.int32)})

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                row, at, names = _windows(batch, length)
                yield pd.DataFrame({
                    "name": batch["name"].to_numpy()[row], "content": batch["content"].to_numpy()[row],
                    "window": names.view(np.int64), "s": at.astype(np.int32)})

    sizes = materialize(contents.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "contents-of-names")
    held = contents.join(sizes, "name")
    calls = max(1, contents.count() // TOGETHER)
    few = held.filter(F.col("n") <= GROUP).select("name", "content", "bytes").groupBy(
        F.pmod(F.xxhash64("name"), F.lit(calls)).alias("call")).applyInPandas(
        within, "name bigint, content bigint, s int, e int")
    many = held.filter(F.col("n") > GROUP).select("name", "content", "bytes").dropDuplicates(["name", "content"]).mapInPandas(
        spread, "name bigint, content bigint, window bigint, s int")
    twice = materialize(
        many.groupBy("name", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "windows")
    return few.union(many.join(twice, ["name", "window"]).select(
        "name", "content", "s", (F.col("s") + length).cast("int").alias("e")))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, text_hash, spans array<struct<s, e>>)`` for texts with repeated strings, from rows of
    ``(doc_id, text_hash, text)`` without null ids; spans may overlap. Texts in several rows of an id have null spans: all
    of such a text is repeated if it has a window at all."""
    key = ["doc_id", "text_hash"]
    copied = materialize(docs.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "copied")
    runs = materialize(_runs(docs.select("doc_id", "text_hash", "text"), length), "runs")
    shared = materialize(
        runs.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "shared-names")
    met = materialize(runs.join(shared, "name"), "shared-runs")
    sizes = materialize(met.groupBy("name", "content").agg(F.count(F.lit(1)).alias("n")), "sizes-of-runs")
    solid = met.join(sizes.filter("n > 1").drop("n"), ["name", "content"]).select("doc_id", "text_hash", "s", "e")
    several = materialize(
        sizes.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "open-names")
    rep = F.min(F.struct("doc_id", "text_hash", "s", "e")).alias("rep")
    reps = materialize(met.join(several, "name").groupBy("name", "content").agg(rep).select("name", "content", "rep.*"), "reps")
    contents = materialize(_contents(reps, docs), "contents")
    part = _repeated_windows(contents, length).withColumnRenamed("s", "from").withColumnRenamed("e", "to")
    part = part.join(reps, ["name", "content"]).select(
        "doc_id", "text_hash", (F.col("s") + F.col("from")).alias("s"), (F.col("s") + F.col("to")).alias("e"))
    found = solid.union(part).join(copied, key, "left_anti").groupBy(*key).agg(
        F.collect_list(F.struct("s", "e")).alias("spans"))
    return found.unionByName(copied, allowMissingColumns=True)


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, spans array<struct<s, e>>, kept binary)`` for each row: the maximal removed runs of bytes
    and what is left of the text."""
    # A key without nulls; the id itself passes through pandas as a string, as nulls would make floats of numbers.
    given = F.col(doc_id).cast("bigint")
    docs = df.select(F.coalesce(given, F.lit(0)).alias("doc_id"), F.xxhash64(text, given.isNull()).alias("text_hash"),
                     F.col(text).alias("text"), given.cast("string").alias("given"))
    found = materialize(repeated_spans(docs, length).withColumn("met", F.lit(True)), "spans")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, spans, met in zip(batch["given"], batch["text"], batch["spans"], batch["met"], strict=True):
                raw, merged = (text or "").encode("utf-8", "surrogatepass"), []
                if met is True and spans is None and len(raw) >= length:
                    merged = [[0, len(raw)]]
                for s, e in sorted((x["s"], x["e"]) for x in (spans if spans is not None else ())):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                edges = [0, *(x for pair in merged for x in pair), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((key, len(raw), [{"s": s, "e": e} for s, e in merged], kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])

    return docs.join(found, ["doc_id", "text_hash"], "left").select("given", "text", "spans", "met").mapInPandas(
        cut, "doc_id string, n_bytes bigint, spans array<struct<s: int, e: int>>, kept binary"
    ).withColumn("doc_id", F.col("doc_id").cast("bigint"))
