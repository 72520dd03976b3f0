from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from streamlytics.llm.components import components
from streamlytics.llm.line_dedup import drop_boilerplate
from streamlytics.llm.minhash import Plan, near_duplicates, signatures

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(rows):
    """doc_id -> (n_shingles, component) by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def varied(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for _ in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(30, 300))]
        for _ in range(rng.randrange(1, 25)):
            rows.append((n, varied(rng, words, rng.randrange(0, 6))))
            n += 1
    rows += [(n, "one two"), (n + 1, "ONE\ttwo "), (n + 2, ""), (n + 3, None), (n + 4, " \n"), (n + 5, "x " * 30000),
             (n + 6, "x " * 20000), (n + 7, "Été noir"), (n + 8, "été noir")]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), percent=85).collect()}
    assert got == brute(rows)


def test_near_duplicates_over_a_hot_bucket_in_blocks(spark, monkeypatch):
    from streamlytics.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK", 2000)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, varied(rng, words, rng.randrange(0, 9))) for i in range(150)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), percent=85).collect()}
    assert got == brute(rows)


def test_near_duplicates_with_nulls_repeats_and_no_rows(spark):
    schema = "doc_id bigint, text string, component int, cls string"
    text = "a b c d e f g h i j"
    rows = [(4, text, 1, "x"), (4, text, 1, "x"), (None, text, 2, None), (3, "k l m n o p", 1, "x"),
            (4, "k l m n o p", 1, "x"), (9, None, None, None)]
    got = sorted((repr(tuple(r)) for r in near_duplicates(spark.createDataFrame(rows, schema)).collect()))
    assert got == sorted(map(repr, [
        (4, 6, 3, False), (4, 6, 3, False), (None, 6, None, True), (3, 2, 3, True), (4, 2, 3, False), (9, 0, 9, True)]))
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(5, 4), (4, 5), (4, 3)], [(i, i + 1) for i in range(40)], [(100, i) for i in range(50)],
    [(1, 2), (3, 4), (2, 3), (9, 8), (None, 8)]])
def test_components(spark, edges):
    parent = {}
    for a, b in edges:
        if a is None or a == b:
            continue
        low = min(parent.get(a, a), parent.get(b, b))
        old = {parent.get(a, a), parent.get(b, b)}
        parent |= {a: low, b: low} | {k: low for k, v in parent.items() if v in old}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == parent


def test_line_dedup(spark):
    rows = [(i, f"own {i}\nmenu\n\nlast {i}", "a", i) for i in range(12)]
    rows += [(100 + i, "copy line", "a", 0) for i in range(30)]  # one page, however often
    rows += [(200, "menu", "b", 0), (201, "", "a", 0), (202, None, "a", 0), (203, "menu", None, 0), (203, "menu", None, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_lines int")
    got = drop_boilerplate(df, min_pages=10)
    assert got.columns == ["doc_id", "text", "source", "n_lines", "n_dropped"]
    by = {(r.doc_id, r.source): (r.text, r.n_lines, r.n_dropped) for r in got.collect()}
    assert got.count() == len(rows)
    assert by[3, "a"] == ("own 3\n\nlast 3", 4, 1)
    assert by[101, "a"] == ("copy line", 1, 0)
    assert by[200, "b"] == ("menu", 1, 0) and by[203, None] == ("menu", 1, 0)
    assert by[201, "a"] == ("", 1, 0) and by[202, "a"] == (None, 0, 0)
    assert drop_boilerplate(df.limit(0)).collect() == []


def test_line_dedup_takes_the_same_share_at_every_size(spark):
    rows = []
    for n in (3, 9, 50, 5000):
        rows += [(f"h{n}", "\n".join([f"own {n} {i}"] + ["menu"] * (3 * i < 2 * n))) for i in range(n)]
    got = drop_boilerplate(spark.createDataFrame(rows, "source string, text string")).groupBy("source").sum("n_dropped")
    assert {r[0]: r[1] for r in got.collect()} == {"h3": 2, "h9": 6, "h50": 34, "h5000": 3334}


@pytest.mark.parametrize("percent", [1, 40, 60, 80, 85, 95, 99, 100])
def test_bands_and_agreement_follow_the_threshold(percent):
    plan, share = Plan.of(percent), percent / 100
    n = plan.bands * plan.rows
    assert (1 - share ** plan.rows) ** plan.bands <= 1e-6
    below = sum(math.comb(n, i) * share ** i * (1 - share) ** (n - i) for i in range(round(plan.least * n)))
    assert below <= 1e-5
    assert percent != 85 or (plan.bands, plan.rows) == (24, 5)


def test_near_duplicates_at_a_lower_threshold(spark):
    import corpus_pipeline

    rng, rows = random.Random(4), []
    for i in range(150):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(64)]
        # Six new words at the end: 54 of 66 shingles; at 60 percent, fifteen: 45 of 75.
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(words[:-6] + [f"x{k}{i}" for k in range(6)])),
                 (3 * i + 2, " ".join(words[:-15] + [f"y{k}{i}" for k in range(15)]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(df, percent=60).collect()}
    assert got == {i: i - i % 3 for i in range(450)}
    docs = df.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    assert {r.doc_id: r.component_id for r in near_duplicates(df).collect()} == {i: i - (i % 3 == 1) for i in range(450)}
    left = dict(corpus_pipeline.STAGES)["minhash_dedup"](spark, docs, "")
    assert left.count() == 300


def test_signatures_of_unrelated_long_texts_do_not_agree(spark):
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n)) for n in (60, 400, 2000, 2000, 20_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    minima = [np.frombuffer(bytes(r.minima), np.uint8) for r in signatures(df, "doc_id", "text").orderBy("doc_id").collect()]
    share = [(x == y).mean() for i, x in enumerate(minima) for y in minima[:i]]
    assert max(share) < 0.05 and np.mean(share) < 3 / 256
