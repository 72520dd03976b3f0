"""Versioned keyed tables, and the sinks and streams that carry state in them."""

from __future__ import annotations

import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streamlytics.operators.running import Running, running
from streamlytics.streaming import batches, sinks
from streamlytics.streaming.keyed import KeyedTable
from streamlytics.streaming.sinks import BatchTable

SCHEMA = "k bigint, v string, n bigint"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def folders(table):
    return sorted(os.listdir(f"{table.path}/data"))


def test_update_insert_replay_and_versions(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("k",), buckets=8)
    assert table.version(spark) is None and table.read(spark, frame(spark, []).schema).collect() == []
    rng, want = random.Random(1), {}
    for batch in range(4):
        new = {rng.choice([*range(30), None]): (f"b{batch}", batch) for _ in range(15)}
        before = dict(want)
        for _ in range(2):  # the second time it is a replay
            made = table.upsert(frame(spark, [(k, *v) for k, v in new.items()]), batch)
            assert (made.number, made.batch) == (batch, batch)
        want |= new
        assert rows(table.read(spark)) == sorted(((k, *v) for k, v in want.items()), key=repr)
        assert rows(table.read(spark, frame(spark, []).schema, before_batch=batch)) == sorted(((k, *v) for k, v in before.items()), key=repr)
    assert table.upsert(frame(spark, [(1, "x", 1)]), 2).batch == 3  # an older batch changes nothing
    assert len(os.listdir(f"{table.path}/commits")) <= 2 * 2  # two versions and their checksums


@pytest.mark.parametrize("combine,want", [
    ({}, [(1, "new", None), (2, "old", 5), (3, "in", 7)]), ({"n": "sum"}, [(1, "new", 4), (2, "old", 5), (3, "in", 7)]),
    ({"n": "max", "v": "first"}, [(1, "old", 4), (2, "old", 5), (3, "in", 7)])])
def test_how_values_combine(spark, tmp_path, combine, want):
    table = KeyedTable(str(tmp_path / "t"), ("k",), buckets=4)
    table.upsert(frame(spark, [(1, "old", 4), (2, "old", 5)]), 0)
    table.upsert(frame(spark, [(1, "new", None), (3, "in", 7)]), 1, combine)
    assert rows(table.read(spark)) == sorted(want, key=repr)


def test_what_is_written_follows_the_batch(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("k",), buckets=64, kept=0)
    table.upsert(spark.range(200_000).selectExpr("id AS k", "sha2(string(id), 256) AS v", "id AS n"), 0)
    whole, before = size(table.path), set(folders(table))
    table.upsert(frame(spark, [(5, "x", 1), (9, "y", 2)]), 1)
    (new,) = set(folders(table)) - before
    assert 0 < size(f"{table.path}/data/{new}") < whole / 16
    assert table.read(spark).count() == 200_000
    touched = table.lookup(frame(spark, [(5, None, None)]), frame(spark, []).schema)
    assert touched.count() < 200_000 / 32 and rows(touched.filter("k = 5")) == [(5, "x", 1)]
    table.vacuum(spark, 1)
    assert table.read(spark).count() == 200_000 and rows(table.read(spark).filter("k = 9")) == [(9, "y", 2)]


def test_vacuum_drops_what_no_kept_version_names(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("k",), buckets=2, kept=2)
    for batch in range(6):
        table.upsert(frame(spark, [(k, f"{batch}", batch) for k in range(40)]), batch)
    assert len(folders(table)) == 2 and {r.n for r in table.read(spark).collect()} == {5}


def test_a_batch_that_dies_before_its_commit_never_shows(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("k",), buckets=4)
    table.upsert(frame(spark, [(1, "a", 1)]), 0)
    failing = frame(spark, [(1, "b", 2)]).withColumn("v", F.when(F.col("n") == 2, F.raise_error("dead")).otherwise("b"))
    with pytest.raises(Exception, match="dead"):
        table.upsert(failing, 1)
    assert rows(table.read(spark)) == [(1, "a", 1)] and table.version(spark).batch == 0
    table.upsert(frame(spark, [(1, "b", 2)]), 1)
    assert rows(table.read(spark)) == [(1, "b", 2)]


def test_a_second_writer_fails_at_the_commit(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("k",), buckets=4)
    table.upsert(frame(spark, [(1, "a", 1)]), 0)

    class Behind(KeyedTable):  # sees the table as it was before another writer's commit
        def version(self, spark, before_batch=None):
            return None

    with pytest.raises(FileExistsError):
        Behind(table.path, ("k",), 4).upsert(frame(spark, [(1, "b", 2)]), 1)
    assert rows(table.read(spark)) == [(1, "a", 1)]


def test_upsert_sink_keeps_the_later_row(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("k",), buckets=4)
    write = sinks.upsert_sink(table, ["n"])
    write(frame(spark, [(1, "a", 5), (1, "b", 3), (2, "c", 1)]), 0)
    write(frame(spark, [(1, "late", 4), (2, "d", 2), (None, "e", 1)]), 1)
    assert rows(table.read(spark)) == sorted([(1, "a", 5), (2, "d", 2), (None, "e", 1)], key=repr)


def replayed(write, *parts):
    """Each batch twice, as after a failure between a sink's commit and the stream's."""
    for i, part in enumerate(parts):
        write(part, i)
        write(part, i)


def test_changelog_over_replayed_batches(spark, tmp_path):
    log = BatchTable(str(tmp_path / "log"))
    write = sinks.changelog_sink(KeyedTable(str(tmp_path / "s"), ("key",), 4), log, "k", "n")
    replayed(write, frame(spark, [(1, "", 2), (1, "", 3), (None, "", 1)]), frame(spark, [(1, "", 4), (2, "", None)]),
             frame(spark, [(None, "", 1), (2, "", 7)]))
    assert rows(log.read(spark), "batch", "k", "kind", "total") == sorted([
        (0, 1, "+I", 5), (0, None, "+I", 1), (1, 1, "-U", 5), (1, 1, "+U", 9), (1, 2, "+I", None),
        (2, None, "-U", 1), (2, None, "+U", 2), (2, 2, "-U", None), (2, 2, "+U", 7)], key=repr)


def test_firing_over_replayed_batches(spark, tmp_path):
    fired = BatchTable(str(tmp_path / "f"))
    write = sinks.firing_sink(sinks.bitmap_state(str(tmp_path / "s"), ["k"], 4), fired, ["k"], "n")
    replayed(write, frame(spark, [(1, "", 2), (1, "", 2), (2, "", 70_000)]), frame(spark, [(1, "", 70_000), (3, "", 1)]),
             frame(spark, [(1, "", 2)]))
    assert rows(fired.read(spark), "k", "fire", "pv", "uv") == [
        (1, 0, 2, 1), (1, 1, 3, 2), (1, 2, 4, 2), (2, 0, 1, 1), (3, 1, 1, 1)]


def test_running_totals_carried_by_key(spark):
    rng = random.Random(2)
    data = [(i, rng.choice([None, 1, 1, 1, 2, 3]), rng.randrange(-5, 9)) for i in range(400)]
    df = spark.createDataFrame(data, "i bigint, k bigint, x bigint")
    start = {None: (10, 4), 2: (-3, 0)}
    initial = spark.createDataFrame([(k, *v) for k, v in start.items()], "k bigint, total bigint, top bigint")
    got = running(df, ["k"], ["i"], [Running("total", "sum", "x"), Running("top", "max", "x")], chunks=5, initial=initial)
    want, state = [], {k: list(v) for k, v in start.items()}
    for i, k, x in data:
        s = state.setdefault(k, [0, -99])
        s[0], s[1] = s[0] + x, max(s[1], x)
        want.append((i, k, x, *s))
    assert rows(got, "i", "k", "x", "total", "top") == sorted(want, key=repr)
    with pytest.raises(ValueError):
        running(df, ["k"], ["i"], [Running("total", "sum", "x")], initial={"total": 1})


class Rows:
    """Stands for a stream: hands the function of foreachBatch back."""

    writeStream = property(lambda self: self)

    def outputMode(self, mode):
        return self

    def foreachBatch(self, write):
        return write


def test_running_stream_with_replays(spark, tmp_path):
    out, state = BatchTable(str(tmp_path / "out")), KeyedTable(str(tmp_path / "s"), ("k",), 4)
    replayed(batches.running_stream(Rows(), ["k"], ["n"], "n", state, out),
             frame(spark, [(1, "", 1), (1, "", 3), (2, "", 2)]), frame(spark, [(1, "", 5), (None, "", 4)]),
             frame(spark, [(1, "", 7), (None, "", 8)]))
    assert rows(out.read(spark), "k", "n", "total") == sorted(
        [(1, 1, 1), (1, 3, 4), (2, 2, 2), (1, 5, 9), (None, 4, 4), (1, 7, 16), (None, 8, 12)], key=repr)


def test_averages_and_first_sightings_with_replays(spark, tmp_path):
    rng, n = random.Random(6), 0
    parts = []
    for size_ in (40, 1, 25, 34):
        parts.append([(rng.choice([None, 1, 1, 1, 2, 3 + n]), "", n := n + 1) for _ in range(size_)])
    out, first = BatchTable(str(tmp_path / "out")), BatchTable(str(tmp_path / "first"))
    frames = [frame(spark, p) for p in parts]
    replayed(batches.average_every_batches(Rows(), "k", "n", ["n"], KeyedTable(str(tmp_path / "s"), ("k",), 4), out, 3), *frames)
    replayed(batches.first_seen_batches(Rows(), ["k"], ["n"], "n", KeyedTable(str(tmp_path / "f"), ("k",), 4), first), *frames)
    by = {}
    for k, _, x in (r for p in parts for r in p):
        by.setdefault(k, []).append(x)
    assert rows(out.read(spark), "k", "avg") == sorted(
        ((k, sum(v[i:i + 3]) / 3) for k, v in by.items() for i in range(0, len(v) - 2, 3)), key=repr)
    assert rows(first.read(spark), "k", "n", "nu") == sorted(((k, x, int(x == v[0])) for k, v in by.items() for x in v), key=repr)
