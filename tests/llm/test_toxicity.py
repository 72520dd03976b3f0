from __future__ import annotations

import random

import numpy as np
import pytest

from streamlytics.llm import toxicity as T

BAD = [f"{a}{b}" for a in ("grobz", "vlax") for b in ("", "en", "ish", "or", "ita", "um")]


def sample(n, seed, bad=BAD):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice(["ta", "lo", "mi", "er", "na", "so"]) for _ in range(rng.randrange(1, 5)))
                 for _ in range(rng.randrange(5, 150))]
        toxic = i % 6 == 0
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        out.append((" ".join(words).capitalize() + ".", int(toxic)))
    return out


@pytest.fixture(scope="module")
def scorer():
    rows = sample(900, 1)
    return T.fit([t for t, _ in rows], np.array([y for _, y in rows]))


def test_held_out_accuracy_and_unseen_word_forms(scorer):
    rows = sample(300, 2) + sample(60, 3, ["grobzal", "vlaxta"])
    score = scorer([t for t, _ in rows])
    y = np.array([y for _, y in rows])
    assert ((score >= 0.3) == y).mean() > 0.97
    assert score[y == 1].mean() > 0.8 > 0.1 > score[y == 0].mean()


def test_every_window_counts(scorer):
    clean = sample(5, 4)[1][0]
    for place in (0, 700, 1999):
        words = (clean.split() * 200)[:2000]
        words[place] = "grobzen"
        assert scorer([" ".join(words)])[0] > 0.3
    for n in (1, 23, 24, 25, 43, 44, 45, 200):
        at = T.windows(n)
        assert {i for a in at for i in range(a, a + T.WINDOW)} >= set(range(n)) and all(a < n for a in at)


def test_passages_are_whole_in_some_window_at_every_place(scorer):
    assert 2 * T.STRIDE <= T.WINDOW
    clean = (sample(5, 4)[1][0].split() * 20)[:200]
    passage = ["grobzen", *clean[:9], "vlaxum"]
    for place in range(60, 60 + T.STRIDE):
        at = T.windows(200)
        assert any(a <= place and place + len(passage) <= a + T.WINDOW for a in at)
        assert scorer([" ".join(clean[:place] + passage + clean[place + len(passage):])])[0] > 0.3


def plain_score(scorer, text):
    """The score of a text by plain loops: window by window, word by word, one gate at a time."""
    words, net = T.words_of(text), {k: x.astype(float) for k, x in scorer.net.items()}
    if not words:
        return 0.0

    def states(inputs, s):
        h, out = np.zeros(T.HIDDEN), []
        for x in inputs:
            gate, before = x @ net[f"W{s}"] + net[f"c{s}"], h @ net[f"U{s}"]
            new_h = np.empty(T.HIDDEN)
            for k in range(T.HIDDEN):
                z = 1 / (1 + np.exp(-(gate[k] + before[k])))
                r = 1 / (1 + np.exp(-(gate[T.HIDDEN + k] + before[T.HIDDEN + k])))
                new_h[k] = (1 - z) * np.tanh(gate[2 * T.HIDDEN + k] + r * before[2 * T.HIDDEN + k]) + z * h[k]
            h = new_h
            out.append(h)
        return out

    logits, first = [], 0
    while True:
        inputs = [scorer.features([w])[0][0].astype(float) for w in words[first:first + T.WINDOW]]
        both = [np.concatenate(x) for x in zip(states(inputs, "f"), states(inputs[::-1], "b")[::-1], strict=True)]
        weight = np.exp([x @ net["v"] for x in both])
        logits.append(sum(a * x for a, x in zip(weight / weight.sum(), both, strict=True)) @ net["w"] + net["b"][0])
        first += T.STRIDE
        if first >= max(1, len(words) - T.WINDOW + T.STRIDE):
            break
    return 1 / (1 + np.exp(-(scorer.scale[0] * max(logits) + scorer.scale[1])))


def test_scores_equal_plain_loops(spark, scorer):
    words = " ".join(t for t, _ in sample(12, 6)).split()
    texts = [" ".join(words[:n]) for n in (1, 2, 12, 23, 24, 25, 36, 37, 200)] + [t for t, _ in sample(14, 7)] + [
        "", None, " \n", "?!", "Ünïcode grobzen 12 漢字", "grobzen " * 90, "x" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in T.score(df, scorer).collect()}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(plain_score(scorer, text), abs=1e-4), text


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = {k: x.astype(float) for k, x in T.initial(5).items()}
    inputs = np.vstack([np.zeros(5), rng.normal(size=(6, 5))])
    at = rng.integers(1, 7, (4, 9))
    at[1, 5:] = 0
    y = np.array([0, 1, 1, 0.0])

    def loss():
        p = T._sigmoid(T.forward({s: inputs @ net[f"W{s}"] + net[f"c{s}"] for s in "fb"}, at, net).astype(float))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grad, _ = T.gradients(inputs, at, y, net)
    for k, p in net.items():
        place = tuple(0 for _ in p.shape)
        kept, p[place] = p[place], p[place] + 1e-2
        up = loss()
        p[place] = kept - 1e-2
        down = loss()
        p[place] = kept
        assert grad[k][place] == pytest.approx((up - down) / 2e-2, abs=2e-3)


def test_frames(spark):
    rows = [(i, t) for i, (t, _) in enumerate(sample(150, 5))] + [(900, ""), (901, None), (902, "?!"), (None, "grobzen"), (3, "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "0 AS toxic", "1D AS score")
    labels = spark.createDataFrame([(i, int(i % 6 == 0), 1) for i in range(150)] + [(7, None, 1), (900, 0, 1)],
                                   "doc_id bigint, toxic int, quality int")
    got = T.score(df, T.train(df, labels))
    assert got.count() == len(rows) and got.columns == ["doc_id", "text", "toxic", "score"]
    by = {(r.doc_id, r.text): r.score for r in got.collect()}
    assert all(0 <= x <= 1 for x in by.values())
    assert by[900, ""] == by[901, None] == by[902, "?!"] == 0
    assert T.train(df, labels.filter("toxic = 0")) is None
    assert {r.score for r in T.score(df, None).collect()} == {0.0}
    assert T.train(df.limit(0), labels) is None and T.score(df.limit(0), None).collect() == []
