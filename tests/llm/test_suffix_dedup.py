from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from streamlytics.llm import suffix_dedup
from streamlytics.llm.suffix_dedup import remove_repeats


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((len(r), bytes(gone).replace(b"\0", b" ").split(), bytes(b for b, g in zip(r, gone) if not g)))
    return [(n, len(runs), kept) for n, runs, kept in out]


@pytest.mark.parametrize("length,group,segment", [(200, 512, 1 << 20), (20, 512, 1 << 20), (20, 1, 64), (7, 512, 100)])
def test_equal_to_brute_force(spark, monkeypatch, length, group, segment):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    rng = random.Random(length)
    pool = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(5, 450))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh é") for _ in range(
            rng.randrange(1, 150))) for _ in range(rng.randrange(0, 5))]
        text = "".join(p[rng.randrange(3):] for p in parts)
        if text and rng.random() < 0.4:
            i = rng.randrange(len(text))
            text = text[:i] + "#" + text[i + 1:]
        texts.append(text)
    texts += ["a" * 1000, "ab" * 300, "a" * 199, "xyz" * 67 + "q", "", None, texts[0], texts[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, len(r.spans), bytes(r.kept)) for r in remove_repeats(df, length=length).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_nulls_repeats_and_no_rows(spark):
    schema = "doc_id bigint, text string, name int, spans string"
    text = "".join(chr(97 + i * i % 23) for i in range(300))
    rows = [(None, text, 1, "x"), (None, text, 1, "x"), (5, None, 1, "x"), (5, "b", None, None)]
    got = sorted((repr((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept))) for r in remove_repeats(
        spark.createDataFrame(rows, schema)).collect()))
    assert got == sorted(map(repr, [(None, 300, 1, b""), (None, 300, 1, b""), (5, 0, 0, b""), (5, 1, 0, b"b")]))
    assert remove_repeats(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("doc_id", [None, 7])
def test_ten_thousand_equal_rows(spark, doc_id):
    text = " ".join(f"word{i * i % 7919}" for i in range(700))
    other = "head " + text[100:400] + " tail"  # shares a passage with them, but is no copy
    rows = spark.range(10_000).selectExpr(f"CAST({'NULL' if doc_id is None else doc_id} AS BIGINT) AS doc_id", f"'{text}' AS text").unionByName(
        spark.createDataFrame([(8, other), (9, "short"), (9, "short")], "doc_id bigint, text string"))
    got = {(r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)): r.n for r in remove_repeats(rows).groupBy(
        "doc_id", "n_bytes", "spans", "kept").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(doc_id, len(text), 1, b""): 10_000, (8, len(other), 1, b"head  tail"): 1, (9, 5, 0, b"short"): 2}
