from __future__ import annotations

import numpy as np
import pytest

from streamlytics.llm import ann
from streamlytics.llm.ann import nearest, usable


def brute(rows, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q, v in rows:
        if q % 50:
            continue
        score = (x * np.array(v, float)).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((np.array(v, float) ** 2).sum()))
        top = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), score[i]) for i in top]
    return out


def recall(spark, df):
    vectors = usable(df)
    rows = [(r.vec_id, r.vector) for r in vectors.collect()]
    want = brute(rows)
    got = {}
    for r in nearest(vectors, vectors.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(want)
    assert all(sorted(g) == list(range(1, len(want[q]) + 1)) for q, g in got.items())
    hits = [len({i for i, _ in w} & {i for i, _ in got[q].values()}) / len(w) for q, w in want.items()]
    return float(np.mean(hits)), got, want


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, sf):
    assert recall(spark, spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet"))[0] >= 0.95


@pytest.mark.parametrize("fan,levels", [(8, 2), (3, 3)])
def test_recall_over_levels_of_centroids(spark, monkeypatch, fan, levels):
    """2,000 vectors in 40 lists below 2 or 3 levels of cells."""
    for name, value in (("FAN", fan), ("PER_LIST", 50 if fan == 8 else 80), ("PART", 300), ("CELLS", 2), ("PROBED", 4), ("PROBES", 5)):
        monkeypatch.setattr(ann, name, value)
    built = []
    monkeypatch.setattr(ann, "_descended", lambda *a, real=ann._descended: built.append(a) or real(*a))
    share, got, want = recall(spark, spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").filter("vec_id < 2000"))
    assert len(built) == 2 * (levels - 1)
    assert share >= 0.9


def test_lists_grow_with_the_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "FAN", 4)
    monkeypatch.setattr(ann, "PER_LIST", 20)
    seen = []
    monkeypatch.setattr(ann, "materialize", lambda df, label, real=ann.materialize: seen.append((label, real(df, label))) or seen[-1][1])
    rng = np.random.default_rng(5)
    for n, least in ((300, 8), (1200, 30)):
        seen.clear()
        rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(n, 8)))]
        df = usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
        nearest(df, df.filter("vec_id % 50 = 0")).collect()
        held = [t for label, t in seen if label == "lists"][-1]
        assert held.select("list").distinct().count() >= least


def test_components_beyond_floats_and_scaled_copies(spark):
    rows = [(50 * i, [float(i + 1), 1e-40, 0.0]) for i in range(4)] + [(1, [1e300, 0.0, 1.0]), (2, [1e-300, 0.0, 0.0]), (3, [2e-300, 0.0, 0.0])]
    vectors = usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = nearest(vectors, vectors.filter("vec_id = 50")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(0, 1.0), (1, 1.0), (2, 1.0), (3, 1.0), (100, 1.0)]


def test_hot_list_of_equal_vectors_is_split_and_ties_go_to_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 64)
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0, 0.5]) for i in range(700)] + [(1000 + i, rng.normal(size=4).tolist()) for i in range(300)]
    share, got, want = recall(spark, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert share >= 0.95
    assert [got[0][r][0] for r in range(1, 6)] == [1, 2, 3, 4, 5]
    assert [got[50][r][0] for r in range(1, 6)] == [0, 1, 2, 3, 4]


def test_isolated_vectors_that_are_centroids_find_k_others(spark, monkeypatch):
    monkeypatch.setattr(ann, "PER_LIST", 20)
    monkeypatch.setattr(ann, "PART", 100)
    rng = np.random.default_rng(3)
    rows = [(1001 + 50 * i, (np.eye(12)[0] + rng.normal(0, 0.05, 12)).tolist()) for i in range(400)]
    alone = [(50 * i, (-np.eye(12)[i]).tolist()) for i in range(1, 8)]  # single ones, and pairs
    pairs = [(50 * (10 + i) + k, np.eye(12)[8 + i].tolist()) for i in range(3) for k in (0, 1)]
    share, got, want = recall(spark, spark.createDataFrame(rows + alone + pairs, "vec_id bigint, embedding array<double>"))
    assert len(got) == 10 and share >= 0.95


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 0.0]),
            (6, [1.0]), (7, [1e-200, 1e-200]), (8, [-1.0, 0.0]), (8, [1.0, 0.1]), (50, []), (0, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS list", "2 AS score")
    vectors = usable(df)
    assert sorted(r.vec_id for r in vectors.collect()) == [0, 0, 7, 8, 8]
    got = nearest(vectors, vectors.filter("vec_id % 50 = 0")).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 8), (2, 7)]
    assert nearest(usable(df.limit(0)), usable(df.limit(0))).collect() == []
