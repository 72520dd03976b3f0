"""Bloom filters and compressed sets against plain Python."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streamlytics.operators import bloom as B
from streamlytics.operators import sets as C
from streamlytics.operators.distinct import bitmap_parts

SCHEMA = "id bigint, t bigint, g string, m bigint"


def sightings(seed, n, members):
    rng = random.Random(seed)
    return [(i, rng.randrange(n), rng.choice(["a", "a", "a", "b", None]), rng.randrange(members)) for i in range(n)]


def positions(spark, bloom, members):
    df = spark.createDataFrame([(m,) for m in members], "m bigint")
    return {r.m: r.p for r in df.select("m", bloom.positions("m").alias("p")).collect()}


def one_by_one(data, bloom, at, filters=None):
    """Ids that a filter for each group takes for new, row after row in order."""
    filters, new = filters if filters is not None else {}, set()
    for i, _, g, m in sorted(data, key=lambda r: (r[1], r[0])):
        held = filters.setdefault(g, set())
        if not held.issuperset(at[m]):
            new.add(i)
            held.update(at[m])
    return new


@pytest.mark.parametrize("bloom", [B.Bloom(2000, 0.01), B.Bloom(60, 0.3), B.Bloom(1, 0.5)])
def test_marks_are_those_of_a_filter_filled_row_by_row(spark, bloom):
    data = sightings(1, 1500, 300)
    at = positions(spark, bloom, {r[3] for r in data})
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.id for r in B.first_seen_bloom(df, ["g"], "m", "t", "id", "nu", bloom).filter("nu = 1").collect()}
    assert got == one_by_one(data, bloom, at)
    exact = {}
    for i, _, g, m in sorted(data, key=lambda r: (r[1], r[0])):
        exact.setdefault((g, m), i)
    assert got <= set(exact.values())
    if bloom.capacity == 2000:
        assert len(got) >= 0.97 * len(exact)


def test_filters_of_parts_merge_and_hold_what_came_before(spark):
    bloom = B.Bloom(400, 0.05)
    data = sightings(2, 1200, 500)
    at = positions(spark, bloom, {r[3] for r in data})
    parts = [[r for r in data if lo <= r[1] < hi] for lo, hi in ((0, 300), (300, 800), (800, 1200))]
    filters, held, stored = {}, None, set()
    for part in parts:
        df = spark.createDataFrame(part, SCHEMA)
        got = {r.id for r in B.first_seen_bloom(df, ["g"], "m", "t", "id", "nu", bloom, held).filter("nu = 1").collect()}
        assert got == one_by_one(part, bloom, at, filters)
        new = B.bloom_parts(df, ["g"], "m", bloom)
        held = new if held is None else B.merge_parts(held.unionByName(new), ["g"])
        held = spark.createDataFrame(held.collect(), held.schema)
    bits = {r.g: r.n for r in held.groupBy("g").agg(F.sum(F.bitmap_count("bits")).alias("n")).collect()}
    # A member that is taken for known adds no bit, so the filters hold the same bits either way.
    assert bits == {g: len(x) for g, x in filters.items()}


def test_errors_stay_within_the_stated_chance(spark):
    bloom = B.Bloom(5000, 0.03)
    df = spark.range(5000).selectExpr("id", "id AS t", "'a' AS g", "xxhash64(id) AS m")
    missed = 5000 - B.first_seen_bloom(df, ["g"], "m", "t", "id", "nu", bloom).filter("nu = 1").count()
    assert missed <= 0.03 * 5000 + 5 * (0.03 * 5000) ** 0.5


def test_bloom_without_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert B.first_seen_bloom(df, ["g"], "m", "t", "id").collect() == []


# -- compressed sets ------------------------------------------------------------------------------

def sets(seed, dense=True):
    rng = random.Random(seed)
    big = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(300)]
    near = [rng.randrange(40_000) for _ in range(600)] if dense else []
    return [(rng.choice(["x", "x", "y", None]), rng.choice([*big, *near, None, -1, 0, 32_767, 32_768])) for _ in range(2500)]


def want_of(data):
    out = {}
    for k, x in data:
        if x is not None:
            out.setdefault(k, set()).add(x)
    return {k: len(x) for k, x in out.items()}


@pytest.mark.parametrize("most", [1, 40, 2048])
def test_cardinalities_and_merges(spark, most):
    data = [sets(1), sets(2), sets(3, dense=False)]
    parts = [C.containers(spark.createDataFrame(d, "k string, x bigint"), ["k"], "x", most) for d in data]
    for part, d in zip(parts, data, strict=True):
        assert {r.k: r.uv for r in C.cardinalities(part, ["k"]).collect()} == want_of(d)
    merged = C.merge_containers(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["k"], most)
    assert {r.k: r.uv for r in C.cardinalities(merged, ["k"]).collect()} == want_of([r for d in data for r in d])
    shapes = merged.select("n", F.size("entries").alias("size"), F.bitmap_count("bits").alias("bits")).collect()
    assert all((s.size == s.n <= most) if s.bits is None else s.bits == s.n for s in shapes)
    again = C.merge_containers(merged.unionByName(parts[0]), ["k"], most)
    assert {r.k: r.uv for r in C.cardinalities(again, ["k"]).collect()} == want_of([r for d in data for r in d])


def test_arrays_and_bitmaps_hold_the_numbers(spark):
    data = [("k", x) for x in [*range(0, 70_000, 3), 1 << 40, (1 << 40) + 5, -7]]
    parts = C.containers(spark.createDataFrame(data, "k string, x bigint"), ["k"], "x")
    got = set()
    for r in parts.collect():
        low = r.entries if r.bits is None else [i for i, byte in enumerate(r.bits) for i in range(8 * i, 8 * i + 8) if byte >> i % 8 & 1]
        assert len(low) == r.n and list(low) == sorted(low) and (r.n <= C.MOST) == (r.bits is None)
        got |= {(r.high << C.PLACES) + x for x in low}
    assert got == {x for _, x in data}


def test_scattered_numbers_take_bytes_not_kilobytes(spark):
    df = spark.range(20_000).selectExpr("id % 50 AS k", "xxhash64(id) AS x", "id + 1 AS plain")
    each = C.containers(df, ["k"], "x").agg(F.sum(C.container_bytes()).alias("n")).first().n / 20_000
    plain = bitmap_parts(df, ["k"], "x").agg(F.sum(F.length("bits")).alias("n")).first().n / 20_000
    assert each == 10 and plain > 4000
    dense = C.containers(spark.range(100_000).selectExpr("1 AS k", "id AS x"), ["k"], "x")
    assert dense.agg(F.sum(C.container_bytes()).alias("n")).first().n < 100_000 / 6


def test_counts_of_rows_and_users(spark):
    df = spark.createDataFrame(sets(4), "k string, x bigint")
    want = {}
    for k, x in sets(4):
        pv, users = want.setdefault(k, [0, set()])
        want[k][0] += 1
        users.update([] if x is None else [x])
    assert rows(C.container_counts(df, ["k"], "x")) == sorted(((k, n, len(u)) for k, (n, u) in want.items()), key=repr)
