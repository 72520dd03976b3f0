from __future__ import annotations

import numpy as np
import pytest

from streamlytics.llm import vector_codes
from streamlytics.llm.vector_codes import compress, nearest_entries, with_label_error

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """(codes, errors, label errors) in the order of ids, and the codebooks."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [int(np.floor(1024 * x)) for x in r[1]]))
    x = [[int(np.floor(1024 * v)) for v in r[1]] for r in rows]
    width = -(-len(x[0]) // parts)
    x = [v + [0] * (parts * width - len(v)) for v in x]
    cut = [[v[p * width:(p + 1) * width] for v in x] for p in range(parts)]
    books = [[list(v) for v in c[:entries]] for c in cut]

    def assign():
        out = []
        for c, book in zip(cut, books, strict=True):
            far = [[sum((a - b) ** 2 for a, b in zip(v, e, strict=True)) for e in book] for v in c]
            out.append([(f.index(min(f)), min(f)) for f in far])
        return out

    for _ in range(rounds):
        for c, book, found in zip(cut, books, assign(), strict=True):
            for e in range(len(book)):
                mine = [v for v, (k, _) in zip(c, found, strict=True) if k == e]
                if mine:
                    book[e] = [sum(t) // len(mine) for t in zip(*mine, strict=True)]
    found = assign()
    error = [sum(found[p][i][1] for p in range(parts)) for i in range(len(rows))]
    total = {}
    for r, e in zip(rows, error, strict=True):
        total[r[2]] = total.get(r[2], 0) + e
    return [(r[0], r[2], bytes(found[p][i][0] for p in range(parts)), e, total[r[2]])
            for i, (r, e) in enumerate(zip(rows, error, strict=True))], books


def check(spark, monkeypatch, rows, usable, entries=256):
    monkeypatch.setattr(vector_codes, "ENTRIES", entries)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS vector", "2 AS `row`", "3 AS far", "4 AS code", "5 AS error")
    coded = compress(df)
    got = sorted((tuple(r) for r in with_label_error(coded.rows).collect()), key=repr)
    want, books = brute(usable, entries=entries)
    assert [(a, b, bytes(c), d, e) for a, b, c, d, e in got] == sorted(want, key=repr)
    assert coded.books.tolist() == books


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(size=8).round(2).tolist(), [None, 1, 2, 3][i % 4]) for i in rng.permutation(300) * 3]
    check(spark, monkeypatch, rows, rows, entries=32)


def test_ties_repeats_and_what_is_dropped(spark, monkeypatch):
    rng, nan = np.random.default_rng(2), float("nan")
    rows = [(i // 2, rng.integers(-2, 3, 6).astype(float).tolist(), i % 3 or None) for i in range(120)]
    rows += [(500, [1.0] * 6, 1)] * 40 + [(None, [2.0] * 6, None), (None, [-1.0] * 6, 2)]
    bad = [(-1, None, 1), (-2, [nan] * 6, 1), (-3, [float("inf")] + [0.0] * 5, 1), (-4, [None] + [0.0] * 5, 1), (-5, [], 1), (-6, [1.0], 1)]
    check(spark, monkeypatch, rows + bad, rows, entries=16)


def test_fewer_vectors_than_entries_and_none(spark, monkeypatch):
    rows = [(2, [0.5, -0.0001, 3.0, 4.0], None), (1, [0.0, 0.0, 0.0, 0.0], 7)]
    check(spark, monkeypatch, rows, rows)
    coded = compress(spark.createDataFrame([(1, None, 1)], SCHEMA))
    assert with_label_error(coded.rows).collect() == [] and coded.books.size == 0


def test_components_beyond_exact_sums_raise(spark):
    with pytest.raises(Exception, match="too large"):
        compress(spark.createDataFrame([(1, [1e30, 0.0, 0.0, 0.0], 1)], SCHEMA)).rows.collect()


@pytest.mark.parametrize("spread", [1, 30, 100_000])
def test_pruning_never_loses_the_nearest(spread):
    rng = np.random.default_rng(spread)
    book = rng.integers(-spread, spread + 1, (256, 4))
    x = np.concatenate([rng.integers(-spread, spread + 1, (500, 4)), book[::3] + rng.integers(-1, 2, (86, 4))])
    pivots = vector_codes._pivots(book)
    entry, best, evaluated = nearest_entries(x, vector_codes._to_pivots(x, pivots), book, pivots)
    far = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (best == far.min(1)).all() and (entry == far.argmin(1)).all()
    assert spread == 1 or evaluated < far.size / 2  # most are pruned


def test_pivots_lie_apart():
    book = np.array([[0, 0], [1, 0], [9, 0], [0, 9], [9, 9], [5, 5]] + [[0, 1]] * 20)
    assert vector_codes._pivots(book)[:4].tolist() == [[0, 0], [9, 9], [9, 0], [0, 9]]
