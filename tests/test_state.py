"""Event-time timers, co-groups, committed inserts and metrics of streams."""

from __future__ import annotations

import os
import random
from collections import Counter

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_streaming import Feed, run, to_table

from streamlytics.operators import cogroup
from streamlytics.streaming import eventtime, inserts, sinks, stateful
from streamlytics.streaming.metrics import MetricsTable, observed
from streamlytics.streaming.sinks import BatchTable

MINUTE, HOUR = 60_000, 3_600_000
AHEAD = 400 * 24 * HOUR


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


def timed(feed):
    """``(time, key, user)`` from lines, watermarked."""
    parts = F.split("value", ",")
    df = feed.stream().select(*[F.nullif(parts[i], F.lit("")).cast("bigint").alias(c) for i, c in enumerate(("time", "key", "user"))])
    return eventtime.with_event_time(df, "time", "1 second")


def deal(feed, rng, events, batches):
    """Events in batches by time, each batch in any order, and then one far ahead."""
    events = sorted(events)
    for i in range(batches):
        part = events[i * len(events) // batches:(i + 1) * len(events) // batches]
        rng.shuffle(part)
        feed.add(*[",".join("" if x is None else str(x) for x in e) for e in part])
    feed.add(f"{AHEAD},0,0")
    feed.add(f"{AHEAD + 1},0,0")


def test_firing_in_event_time(spark, feed, tmp_path):
    rng = random.Random(1)
    events = [(rng.randrange(30 * HOUR), rng.randrange(3), rng.choice([None, *range(12)])) for _ in range(400)]
    deal(feed, rng, events, 4)
    df = stateful.fire_in_event_time(timed(feed), ["key"], "user", 10 * MINUTE, 12 * HOUR, 2 * HOUR, "time", "ts")
    want = set()
    for key in range(3):
        for end in range(2 * HOUR, 50 * HOUR, 12 * HOUR):
            mine = [(t, u) for t, k, u in events if k == key and end - 12 * HOUR <= t < end]
            for fire in {t // (10 * MINUTE) * 10 * MINUTE + 10 * MINUTE for t, _ in mine}:
                so_far = [u for t, u in mine if t < fire]
                want.add((key, end, fire, len(so_far), len({u for u in so_far if u is not None})))
    got = rows(to_table(spark, df, tmp_path), "key", "w_end", "fire_time", "pv", "uv")
    assert len(got) == len(set(got)) and {g for g in got if g[1] < AHEAD} == want


def test_lives_expire_in_event_time(spark, feed, tmp_path):
    rng = random.Random(2)
    events = [(rng.randrange(60 * HOUR), rng.randrange(4), rng.randrange(9)) for _ in range(120)]
    events += [(100 * HOUR, 1, 1), (103 * HOUR, 1, 1), (106 * HOUR - 1, 1, 1)]  # exactly the time to live apart, and a bit less
    deal(feed, rng, events, 5)
    df = stateful.lives_in_event_time(timed(feed), "key", "user", 3 * HOUR)
    want = []
    for key in range(4):
        mine = sorted((t, v) for t, k, v in events if k == key)
        for i, (t, v) in enumerate(mine):
            if not i or t - mine[i - 1][0] >= 3 * HOUR:
                want.append([key, t, t, 0, 0])
            want[-1][2:] = [t, want[-1][3] + 1, want[-1][4] + v]
    got = rows(to_table(spark, df, tmp_path), "key", "born", "last", "n", "total")
    assert [g for g in got if g[1] < AHEAD] == sorted(map(tuple, want), key=repr)


class Handle:
    """States and timers of one key in memory, with the number of calls."""

    def __init__(self):
        self.calls, self.timers, self.value, self.map = 0, set(), None, {}

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, *schemas):
        return Users(self)

    def called(self, value=None):
        self.calls += 1
        return value

    def get(self):
        return self.called(self.value)

    def update(self, value):
        self.value = self.called(value)

    def clear(self):
        self.value = self.called()

    def registerTimer(self, at):
        self.timers.add(at)


class Users:
    def __init__(self, handle):
        self.handle = handle

    def getValue(self, key):
        return self.handle.called(self.handle.map.get(key))

    def updateValue(self, key, value):
        self.handle.map[self.handle.called(key)] = value

    def clear(self):
        self.handle.map.clear()


class Now:
    def __init__(self, at):
        self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: at


def test_firing_looks_users_up_by_the_bucket(spark):
    rng, handle, seen, fired = random.Random(5), Handle(), [], []
    steps = stateful.FireSteps(["k", "w_end"], "user", "ms", 10, "bigint")
    steps.BUCKET, steps.CACHED = 64, 500
    steps.init(handle)
    for batch in range(4):
        here = [{"ms": rng.randrange(100 * batch, 100 * batch + 100), "user": rng.choice([None, *range(3000)])} for _ in range(2000)]
        seen += here
        list(steps.handleInputRows((1, 1000), iter(here), Now(100 * batch)))
        fired += steps.handleExpiredTimer((1, 1000), Now(100 * batch + 95), Now(min(handle.timers)))
    fired += steps.handleExpiredTimer((1, 1000), Now(1000), Now(1000))
    want = [(fire, len(so_far := [r["user"] for r in seen if r["ms"] < fire]), len({*so_far} - {None})) for fire in range(10, 401, 10)]
    assert [(r.fire_time, r.pv, r.uv) for r in fired] == want
    assert handle.value is None and not handle.map
    assert handle.calls < 2500  # three for each user and micro-batch would be 24,000


def test_timer_holds_many_groups_in_a_state(spark):
    handle = Handle()
    top = stateful.TopOnTimer(["w_end", "g"], "w_end", "n", "tie", 2, "")
    top.init(handle)
    given = [{"w_end": end, "g": g, "tie": t, "n": n} for end in (10, 20, 30) for g in range(50) for t, n in (("b", 1), ("a", 1), (None, 1), ("c", 5))]
    for part in (given[::2], given[1::2]):
        list(top.handleInputRows((0,), iter(part), Now(0)))
    assert handle.timers == {11} and handle.calls == 4
    got = [*top.handleExpiredTimer((0,), Now(25), Now(11)), *top.handleExpiredTimer((0,), Now(31), Now(31))]
    assert [tuple(r) for r in got if r.g == 7] == [(end, 7, t, n, i) for end in (10, 20, 30) for t, n, i in (("c", 5, 1), (None, 1, 2))]
    assert len(got) == 300 and handle.timers == {11, 31} and handle.value is None


# -- co-group -------------------------------------------------------------------------------------

def sides(spark, seed=3):
    rng = random.Random(seed)
    left = [(rng.choice([1, 2, 2, 2, 2, 3, None]), i) for i in range(200)]
    right = [(rng.choice([1, 2, 4, None]), f"r{i}") for i in range(30)]
    return left, right, spark.createDataFrame(left, "k bigint, a bigint"), spark.createDataFrame(right, "k bigint, b string")


def outer(left, right):
    by = {}
    for k, b in right:
        by.setdefault(k, []).append(b)
    return sorted(((k, a, b) for k, a in left for b in (by.get(k) if k is not None and k in by else [None])), key=repr)


@pytest.mark.parametrize("rows_", [7, 10 ** 6])
def test_left_outer_by_function(spark, monkeypatch, rows_):
    left, right, a, b = sides(spark)
    function = cogroup.left_outer("l_", "r_", ["l_k", "l_a", "r_b"])
    got = cogroup.co_group(a, b, ["k"], function, "l_k bigint, l_a bigint, r_b string", first="right", deal="left", rows=rows_)
    assert rows(got) == outer(left, right)
    if rows_ == 7:  # the busy key is dealt over several tasks
        placed = cogroup.co_group(a, b, ["k"], lambda key, x, y: (pa.RecordBatch.from_pydict(
            {"k": [key[0]], "n": [sum(t.num_rows for t in (list(y), list(x))[1])]}) for _ in (0,)),
            "k bigint, n bigint", first="right", deal="left", rows=7)
        of_two = [r.n for r in placed.collect() if r.k == 2]
        assert len(of_two) > 5 and sum(of_two) == sum(k == 2 for k, _ in left)


@pytest.mark.parametrize("many,size", [(1, 3), (20, 7), (10 ** 5, 7), (10 ** 5, 1000)])
def test_left_outer_of_many_keys_at_once(spark, monkeypatch, many, size):
    monkeypatch.setattr(cogroup, "MANY", many)
    left, right, a, b = sides(spark)
    more = [(k, k) for k in range(10, 300)], [(k, f"m{k}") for k in range(11, 300, 3)] * 2
    a, b = a.union(spark.createDataFrame(more[0], a.schema)), b.union(spark.createDataFrame(more[1], b.schema))
    function, calls = cogroup.left_outer("l_", "r_", ["l_k", "l_a", "r_b"]), spark.sparkContext.accumulator(0)

    def one(*args):
        calls.add(1)
        return function(*args)

    one.many = function.many
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        got = rows(cogroup.co_group(a, b, ["k"], one, "l_k bigint, l_a bigint, r_b string", first="right", deal="left"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == outer(left + more[0], right + more[1])
    assert calls.value <= 4 or many == 1  # a call for each of the 290 keys before


def test_every_key_of_either_side_once_and_sides_in_order(spark):
    left, right, a, b = sides(spark, 4)

    def seen(key, x, y):
        mine = [v for t in x for v in t.column("a").to_pylist()]
        yield pa.RecordBatch.from_pydict({"k": [key[0]], "sorted": [mine == sorted(mine)], "n": [len(mine)], "m": [sum(t.num_rows for t in y)]})

    got = cogroup.co_group(a, b.withColumn("a", F.lit(0)), ["k"], seen, "k bigint, sorted boolean, n bigint, m bigint", order=["a"])
    n, m = Counter(k for k, _ in left), Counter(k for k, _ in right)
    assert rows(got) == sorted(((k, True, n[k], m[k]) for k in {*n, *m}), key=repr)
    skips = cogroup.co_group(a, b, ["k"], lambda key, x, y: (pa.RecordBatch.from_pydict({"m": [sum(t.num_rows for t in y)]}) for _ in (0,)), "m bigint")
    assert sum(r.m for r in skips.collect()) == len(right)  # the first side is passed over
    empty = cogroup.co_group(a.limit(0), b.limit(0), ["k"], seen, "k bigint, sorted boolean, n bigint, m bigint")
    assert empty.collect() == []
    with pytest.raises(ValueError):
        cogroup.co_group(a, b, ["k"], seen, "k bigint", deal="left")


def test_count_between(spark):
    left = spark.createDataFrame([(1, 10, 1), (1, 20, 2), (1, 20, 3), (2, 5, 9)], "u bigint, t bigint, i bigint")
    right = spark.createDataFrame([(1, 1, 5), (1, 10, 0), (1, 10, 7), (1, 20, 1), (1, 99, 1), (3, 1, 1)], "u bigint, t bigint, i bigint")
    got = cogroup.co_group(left, right, ["u"], cogroup.count_between("t", "i", "n"), "user_id bigint, i bigint, n bigint", order=["t", "i"])
    assert rows(got) == [(1, 1, 2), (1, 2, 2), (1, 3, 0), (2, 9, 0)]


# -- inserts --------------------------------------------------------------------------------------

def test_table_inserts_flush_by_rows_and_show_when_committed(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 130, numPartitions=3).selectExpr("id", "string(id) AS s")
    inserts.insert_table(df, path, rows=20)
    (commit,) = inserts.commits(path)
    assert commit["rows"] == 130 and len(commit["files"]) == 3 and commit["flushes"] >= 7
    inserts.insert_table(df.limit(0), path)
    assert rows(inserts.read_inserted(spark, path, df.schema)) == rows(df)
    failing = df.withColumn("s", F.when(F.col("id") == 120, F.raise_error("dead")).otherwise(F.col("s")))
    with pytest.raises(Exception, match="dead"):
        inserts.insert_table(failing, path, rows=5)
    assert len(os.listdir(f"{path}/data")) > 3  # files of the tasks that came through are there, but in no commit
    assert rows(inserts.read_inserted(spark, path, df.schema)) == rows(df)
    assert inserts.read_inserted(spark, str(tmp_path / "none"), df.schema).collect() == []


def test_stream_inserts_are_exactly_once_over_failures(spark, feed, tmp_path):
    path, marker = str(tmp_path / "t"), tmp_path / "met"
    feed.add("a", "b", "c")
    feed.add("d", "poison", "e")

    def once(batches):
        for batch in batches:
            if "poison" in batch.column("value").to_pylist() and not marker.exists():
                yield batch.slice(0, 1)
                marker.write_text("")
                raise ValueError("poison")
            yield batch

    writer = inserts.insert_stream(feed.stream().select("value").mapInArrow(once, "value string"), path, rows=1)
    with pytest.raises(StreamingQueryException):
        run(writer, tmp_path / "cp")
    assert rows(inserts.read_inserted(spark, path, "value string")) == [("a",), ("b",), ("c",)]
    run(writer, tmp_path / "cp")
    assert rows(inserts.read_inserted(spark, path, "value string")) == [(x,) for x in ("a", "b", "c", "d", "e", "poison")]
    inserts._commit(path, f"{1:012d}", [inserts.Written("other.parquet", 1, 1)])  # the same micro-batch again
    assert [c["rows"] for c in inserts.commits(path)] == [3, 3]


# -- metrics --------------------------------------------------------------------------------------

def test_metrics_of_each_micro_batch(spark, feed, tmp_path):
    table = BatchTable(str(tmp_path / "m"))
    for lines in (("a", "b"), ("c",), ("d", "e", "f")):
        feed.add(*lines)
    listener = MetricsTable(spark, table, "seen")
    spark.streams.addListener(listener)
    try:
        counted = observed(feed.stream(), "seen", F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
        query = sinks.start(counted.writeStream.format("noop"), str(tmp_path / "cp"), {"availableNow": True})
        query.awaitTermination()
        listener.wait(query.runId)
    finally:
        spark.streams.removeListener(listener)
    assert rows(table.read(spark), "batch", "n", "top") == [(0, 2, "b"), (1, 1, "c"), (2, 3, "f")]
