"""The running primitive against brute force, hot keys and tied order values included."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from streamlytics.operators import Running, running
from streamlytics.operators.running import _chunk

ALL = [
    Running("total", "sum", "v"), Running("n", "count"), Running("non_null", "count", "v"),
    Running("top", "max", "v"), Running("low", "min", "v"), Running("before", "max", "v", include_current=False),
]


def brute(data):
    out, state = [], {}
    for k, a, b, v in sorted(data, key=lambda r: (r[1], r[2])):
        seen = state.setdefault(k, [])
        earlier = [x for x in seen if x is not None]
        seen.append(v)
        known = [x for x in seen if x is not None]
        out.append((k, a, b, v, sum(known) if known else None, len(seen), len(known), max(known, default=None),
                    min(known, default=None), max(earlier, default=None)))
    return sorted(out, key=repr)


def check(spark, data, chunks):
    df = spark.createDataFrame(data, "k string, a bigint, b bigint, v bigint")
    assert rows(running(df, ["k"], ["a", "b"], ALL, chunks)) == brute(data)


def test_hot_key_and_null_key(spark):
    rng = random.Random(1)
    data = [(rng.choice(["hot", "hot", "hot", "x", None]), rng.randrange(1000), i, rng.choice([None, 1, 5, -3]))
            for i in range(800)]
    check(spark, data, 16)


def test_one_order_value_holds_most_rows(spark):
    data = [("k", 7 if i % 3 else i, i, i % 11) for i in range(600)]
    check(spark, data, 16)
    df = spark.createDataFrame(data, "k string, a bigint, b bigint, v bigint")
    sizes = [r["count"] for r in _chunk(df, ["a", "b"], 16).groupBy("__chunk").count().collect()]
    assert max(sizes) < 200, "the hot order value must be split further"


def test_chunks_follow_the_order(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.randrange(50), i) for i in range(500)], "a bigint, b bigint")
    placed = sorted((r.a, r.b, r["__chunk"]) for r in _chunk(df, ["a", "b"], 8).collect())
    chunks = [c for *_, c in placed]
    assert chunks == sorted(chunks) and len(set(chunks)) > 4


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-4, 4), st.one_of(st.none(), st.integers(-9, 9))),
                min_size=1, max_size=40), st.integers(2, 6))
def test_random_histories(spark, values, chunks):
    check(spark, [(k, a, i, v) for i, (k, a, v) in enumerate(values)], chunks)


def test_without_keys_and_with_initial_value(spark):
    df = spark.createDataFrame([(i, i * 10 % 70) for i in range(20)], "s bigint, v bigint")
    aggs = [Running("top", "max", "v", include_current=False), Running("n", "count")]
    got = rows(running(df, [], ["s"], aggs, 5, initial={"top": 25, "n": 100}))
    top = 25
    for i, (s, v, seen, n) in enumerate(sorted(got)):
        assert (s, seen, n) == (i, top, 101 + i)
        top = max(top, v)
    with pytest.raises(ValueError):
        running(df, ["v"], ["s"], aggs, initial={"top": 1})


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, a bigint, b bigint, v bigint")
    assert running(df, ["k"], ["a", "b"], ALL).count() == 0


def test_neighbours_of_a_heavy_value_beyond_exact_doubles(spark):
    top = -(1 << 60)
    data = [("k", top, i, 1) for i in range(40)] + [("k", top + 1, 40, 1), ("k", 5, 41, 1), ("k", top - 1, 42, 1), ("k", (1 << 60) + 1, 43, 1)]
    check(spark, data, 5)
    check(spark, [("k", a, i, 1) for i, a in enumerate([top] * 30 + [top + 1] * 30 + [top + 2] * 3)], 6)


def test_many_heavy_values_make_a_small_plan(spark):
    data = [("k", a * 10 + b % 2, a * 30 + b, 1) for a in range(40) for b in range(30)]
    check(spark, data, 200)
    df = spark.createDataFrame(data, "k string, a bigint, b bigint, v bigint")
    made = _chunk(df, ["a", "b"], 200)
    placed = sorted((r.a, r.b, r["__chunk"]) for r in made.collect())
    assert [c for *_, c in placed] == sorted(c for *_, c in placed) and len({c for *_, c in placed}) > 60
    assert made._jdf.queryExecution().optimizedPlan().toString().count(">=") < 5


def test_chunks_follow_the_rows(spark, monkeypatch):
    import sys

    module = sys.modules["streamlytics.operators.running"]

    monkeypatch.setattr(module, "ROWS_PER_CHUNK", 10)
    monkeypatch.setattr(module, "FIRST_CUTS", 20)
    for n in (150, 900):
        placed = module._chunk(spark.range(n), ["id"], None)
        sizes = [r["count"] for r in placed.groupBy("__chunk").count().collect()]
        assert len(sizes) >= n // 20 and max(sizes) <= 40
