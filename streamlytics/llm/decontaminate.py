"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window is ``length`` consecutive words of a benchmark item (the whole item where it is shorter). Each window is
represented by the least hash of its ``gram``-word grams, so equal windows have equal representatives: documents and
items are joined on these fingerprints, of which neighbouring windows share most. In the documents that share one, the
windows it stands for are compared on all their words (by SHA-256), and hits are extended to the union of the windows
that occur. No shared window is missed.

The benchmark's windows have a fixed width (two hashes, a number, an id). They are broadcast in blocks of at most
about ``BLOCK`` rows; a larger benchmark takes more passes over the documents, with the same result.

Defined results: null texts have no words. Items without words or without an id take no part; repeated items count
once. Every document row gives one row, repeated rows and null ids included.
"""

from __future__ import annotations

import functools
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LENGTH = 13
GRAM = 8
BLOCK = 100_000
BROADCAST_DOCS = 20_000  # texts that share a fingerprint; more of them are joined by a shuffle


def words(text: str) -> Column:
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _neighbours(a: str, b: str, step: int, combine) -> Column:
    """``combine(a[i], b[i + step])`` for every i at which both exist."""
    size = F.greatest(F.size(b) - F.lit(step), F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), size), F.slice(b, F.lit(step + 1), size), combine)


def _spread(df: DataFrame, base: str, n: int, combine, keep: str) -> DataFrame:
    """Column ``keep``: ``base`` combined over every run of ``n`` entries, by doubling. Runs may overlap, as the
    combination of the last step does unless ``n`` is a power of two; ``keep`` is a function of the run alone."""
    df, size, last = df.withColumn(keep, F.col(base)), 1, keep
    while size < n:
        step = min(size, n - size)
        df = df.withColumn(keep, _neighbours(last, last, step, combine))
        size += step
    return df


def _hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _lesser(a: Column, b: Column) -> Column:
    return F.least(a, b)


def with_windows(df: DataFrame, lengths: list[int], length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Adds, for every window length n, the array ``at_<n>`` of the windows' fingerprints; needs ``words``."""
    df = df.withColumn("at_1", F.transform("words", lambda w: F.xxhash64(w)))
    for n in sorted(lengths, reverse=True):
        if n == length:
            df = _spread(_spread(df, "at_1", gram, _hash, "grams"), "grams", length - gram + 1, _lesser, f"at_{n}")
            df = df.drop("grams")
        elif n > 1:
            df = _spread(df, "at_1", n, _hash, f"at_{n}")
    return df if 1 in lengths else df.drop("at_1")


def _sha(start: Column, n: Column) -> Column:
    """The exact window: its words hold no blank, so joining them by blanks loses nothing."""
    return F.sha2(F.concat_ws(" ", F.slice("words", start + 1, n)), 256)


def _at(n: Column, lengths: list[int]) -> Column:
    return F.coalesce(*[F.when(n == k, F.col(f"at_{k}")) for k in lengths])


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", length: int = LENGTH,
                 gram: int = GRAM) -> tuple[DataFrame, list[int]]:
    """The distinct ``(item_id, n, fp, sha)`` of all windows, and the window lengths that occur (``length`` at most)."""
    items = benchmark.select(F.col(item_id).alias("item_id"), words(text).alias("words")).filter(
        F.col("item_id").isNotNull() & (F.size("words") > 0))
    items = items.withColumn("n", F.least(F.size("words"), F.lit(length)))
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect()) or [length]
    items = with_windows(items, lengths, length, gram).withColumn("at", _at(F.col("n"), lengths))
    # Outer: a plain explode would infer a filter on the size of the array and push the whole computation, many
    # times over, into it.
    spots = items.select("item_id", "n", "words", F.posexplode_outer("at").alias("i", "fp")).filter("fp IS NOT NULL")
    return spots.select("item_id", "n", "fp", _sha(F.col("i"), F.col("n")).alias("sha")).distinct(), lengths


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """``(doc_id, text_hash, n_words, n_hit, items array<string>)`` for each row of ``docs``; items in string order."""
    windows, lengths = item_windows(benchmark, length=length, gram=gram)
    windows = materialize(windows, "benchmark-windows")
    blocks = max(1, -(-windows.count() // block))
    parts = [F.broadcast(windows.filter(F.pmod(F.xxhash64("item_id", "sha"), F.lit(blocks)) == k)) for k in range(blocks)]
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    # Fingerprints alone meet the benchmark; a null one per row stands for the row itself.
    marked = with_windows(texts.select("doc_id", "text_hash", words("text").alias("words")), lengths, length, gram)
    marks = F.concat(F.array(F.lit(None).cast("bigint")), F.array_distinct(F.concat(*[f"at_{n}" for n in lengths])))
    spots = marked.select("doc_id", "text_hash", F.size("words").alias("n_words"), F.explode_outer(marks).alias("mark"))
    met = functools.reduce(DataFrame.union, [
        spots.join(F.broadcast(part.select("fp").distinct()), F.col("mark") == F.col("fp"), "left" if k == 0 else "inner")
        .filter("fp IS NOT NULL OR mark IS NULL").drop("fp") for k, part in enumerate(parts)])
    base = materialize(met.groupBy("doc_id", "text_hash", "n_words").agg(
        F.count_if(F.col("mark").isNull()).alias("rows"), F.collect_set("mark").alias("marks")), "fingerprints")

    # Only texts that share a fingerprint are looked at again, and only at the windows it stands for.
    near = base.filter(F.size("marks") > 0).select("doc_id", "text_hash", "marks")
    if near.count() <= BROADCAST_DOCS:
        near = F.broadcast(near)
    same = F.expr("t.doc_id <=> m.doc_id AND t.text_hash = m.text_hash")
    again = texts.alias("t").join(near.alias("m"), same).select(
        "t.doc_id", "t.text_hash", "m.marks", words("t.text").alias("words"))
    again = with_windows(again, lengths, length, gram)

    def starts(n: int) -> Column:
        return F.filter(F.transform(f"at_{n}", lambda x, i: F.when(F.array_contains("marks", x), F.struct(
            i.alias("s"), F.lit(n).alias("n"), x.alias("fp")))), lambda x: x.isNotNull())

    found = F.concat(*[starts(n) for n in lengths])
    spans = F.transform(found, lambda x: F.struct(
        x["s"].alias("s"), (x["s"] + x["n"]).alias("e"), x["fp"].alias("mark"), _sha(x["s"], x["n"]).alias("window")))
    spans = again.select("doc_id", "text_hash", spans.alias("spans")).select(
        "doc_id", "text_hash", F.explode_outer("spans").alias("span")).select("doc_id", "text_hash", "span.*")
    hits = functools.reduce(DataFrame.union, [
        spans.join(part, (F.col("mark") == F.col("fp")) & (F.col("window") == F.col("sha"))) for part in parts])
    hits = hits.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("s", "e")).alias("spans"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
    merged = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["e"]).alias("end"),
            (acc["hit"] + F.greatest(F.lit(0), x["e"] - F.greatest(acc["end"], x["s"]))).alias("hit")),
        lambda acc: acc["hit"])
    return base.alias("t").join(hits.alias("m"), same, "left").select(
        "t.doc_id", "t.text_hash", F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce(merged, F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.array_sort("items"), F.array().cast("array<string>")).alias("items"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("row")).drop("row")


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words, at least one, lies in windows of the benchmark."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
