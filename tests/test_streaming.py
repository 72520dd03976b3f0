"""Streams give what the batch operators give; sinks replay and restart cleanly."""

from __future__ import annotations

import json
import os
import random
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streamlytics import operators as ops
from streamlytics import plans, schemas
from streamlytics.catalog import inputs, streams
from streamlytics.functions import not_equal
from streamlytics.functions.delimited import parse_delimited
from streamlytics.plans import users
from streamlytics.sources import text_lines
from streamlytics.streaming import batches, eventtime, sinks, stateful
from streamlytics.streaming.sinks import BatchTable


class Feed:
    """A folder of text files read as a stream, one file per micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.count = spark, root, 0
        root.mkdir(parents=True, exist_ok=True)

    def add(self, *lines):
        self.count += 1
        path = self.root / f"{self.count:05d}.txt"
        path.write_text("\n".join(lines) + "\n")
        import os

        os.utime(path, (self.count, self.count))    # files are taken in order of modification

    def stream(self):
        return text_lines(self.spark, str(self.root), stream=True, max_files=1)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


def run(writer, checkpoint):
    sinks.start(writer, str(checkpoint), {"availableNow": True}).awaitTermination()


def to_memory(df, tmp_path, mode="append"):
    name = f"m{uuid.uuid4().hex}"
    run(df.writeStream.format("memory").queryName(name).outputMode(mode), tmp_path / "cp")
    return df.sparkSession.table(name)


def to_table(spark, df, tmp_path, mode="append"):
    """Through a batch table (memory sinks cannot resume in append mode)."""
    store = BatchTable(str(tmp_path / f"t{uuid.uuid4().hex}"))
    run(df.writeStream.outputMode(mode).foreachBatch(store.write), tmp_path / f"c{uuid.uuid4().hex}")
    return store.read(spark)


def click(t, name, event="view", category="c"):
    return json.dumps({"event": event, "time": t, "product": {"category": category, "name": name}})


# -- watermarks -----------------------------------------------------------------------------------

def test_filtered_rows_still_move_the_watermark(feed, spark, tmp_path):
    feed.add(click(1000, "a"))
    feed.add(click(10_000_000, "z", event="startup"))     # filtered, but closes the first windows
    feed.add(click(10_000_001, "z", event="startup"))
    counts = to_table(spark, users.product_counts(feed.stream()), tmp_path)
    assert counts.filter("product = 'a'").count() == 5


def test_guard_stays_above_the_watermark(feed, capsys, spark):
    feed.add(click(1, "a"))
    events = eventtime.with_event_time(users.read_app_events(feed.stream()), "time", "20 seconds")
    eventtime.filter_above_watermark(events, not_equal("event", "startup")).explain(True)
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical")[0]
    assert 0 <= optimized.find("startup") < optimized.find("EventTimeWatermark")


def test_page_views_and_uv_batch_equals_stream(feed, spark, tmp_path):
    rng = random.Random(11)
    lines = [json.dumps({"user_id": rng.randrange(9), "itemId": 1, "behavior": rng.choice(["pv", "pv", "buy"]),
                         "ts": i * 2500}) for i in range(60)]
    for i in range(0, 60, 20):
        feed.add(*lines[i:i + 20])
    feed.add(json.dumps({"user_id": 1, "itemId": 1, "behavior": "buy", "ts": 50_000_000}))
    whole = spark.read.text(str(feed.root))
    assert rows(to_table(spark, plans.page_views(feed.stream()), tmp_path).drop("batch")) == rows(plans.page_views(whole))
    uv = to_table(spark, plans.hourly_uv(feed.stream(), "30 seconds"), tmp_path).drop("batch")
    assert rows(uv) == rows(plans.hourly_uv(whole, "30 seconds"))


def test_late_split_over_batches_equals_one_pass(feed, spark, tmp_path):
    rng = random.Random(12)
    data = [(i, max(0, i * 300 - rng.randrange(12_000))) for i in range(120)]
    for i in range(0, 120, 15):
        feed.add(*[f"{seq},{t}" for seq, t in data[i:i + 15]])
    schema = schemas._schema("seq BIGINT, time BIGINT")
    tables = [BatchTable(str(tmp_path / n)) for n in ("on_time", "late", "progress")]
    run(batches.late_split_stream(parse_delimited(feed.stream(), schema), ["seq"], 5000, *tables, 1000),
        tmp_path / "cp")
    on_time, late = ops.split_late(parse_delimited(spark.read.text(str(feed.root)), schema), ["seq"], 5000, 1000)
    assert rows(tables[0].read(spark), "seq", "time") == rows(on_time)
    assert rows(tables[1].read(spark), "seq", "time") == rows(late) != []


def test_order_item_stream_keys_are_narrow(feed, spark, tmp_path):
    """State is kept by the key and one moment of the window, not by both of its ends."""
    feed.add("1,o1,1000,s,1,2")
    orders = feed.stream().select(F.lit("o1,4000,10").alias("value"))
    joined = plans.order_item_join(feed.stream(), orders)
    left = joined._jdf.queryExecution().analyzed().toString()
    assert "window_time" in left and joined.columns[0] == "w_start"
    assert dict(joined.dtypes)["w_start"] == "bigint"


def test_far_row_comes_with_the_last_part(spark, tmp_path):
    """One run for each part, and the same rows as with a run for the row far ahead."""
    path = tmp_path / "data"
    spark.range(20).selectExpr("id", "timestamp_millis(id * 1000) ts").coalesce(1).write.parquet(str(path / "t.parquet"))
    got = []
    for together in (False, True):
        numbers = inputs.Feed(spark, str(path), "t", "ts", {"id": -1})
        counts = numbers.stream().withWatermark("ts", "0 seconds").groupBy(F.window("ts", "4 seconds").alias("w")).agg(F.sum("id").alias("n"))
        got.append(rows(streams._collect(spark, "far", counts, numbers, together=together)))
    assert got[0] == got[1] and len(got[0]) == 5
    assert sorted(int(x) for x in os.listdir(numbers.folder)) == [0, 1, 2]


@pytest.mark.parametrize("looked_up", [0, 100_000])
def test_repair_over_batches_equals_one_pass(feed, spark, tmp_path, monkeypatch, looked_up):
    """Batches above and below the size whose keys are sent to the order table."""
    monkeypatch.setattr(batches, "LOOKED_UP", looked_up)
    rng = random.Random(29)
    data = [(i, rng.randrange(12), max(0, i * 300 - rng.randrange(12_000))) for i in range(90)]
    for i in range(0, 90, 30):
        feed.add(*[f"{seq},{order},{t}" for seq, order, t in data[i:i + 30]])
    schema = schemas._schema("seq BIGINT, orderId STRING, time BIGINT")
    orders = spark.range(10).selectExpr("cast(id as string) orderId", "id * 2500 time", "timestamp_millis(id * 2500) ts")
    items = [parse_delimited(x, schema).withColumn("ts", F.timestamp_millis("time"))
             for x in (feed.stream(), spark.read.text(str(feed.root)))]
    store, progress = BatchTable(str(tmp_path / "repaired")), BatchTable(str(tmp_path / "progress"))
    run(batches.repair_stream(items[0], orders, "orderId", ["seq"], 5000, store, progress), tmp_path / "cp")
    whole = ops.repair_late_items(ops.flag_late(items[1], ["seq"], 5000), orders, orders, "orderId", "5000 milliseconds")
    assert rows(store.read(spark).drop("batch")) == rows(whole)
    assert {r.source for r in whole.select("source").collect()} == {"window", "table", "none"}


def test_top_products_stream_equals_batch(feed, spark, tmp_path):
    rng = random.Random(13)
    for start in range(0, 600_000, 200_000):
        feed.add(*[click(start + rng.randrange(200_000), rng.choice("abcdef"), rng.choice(["view", "buy"]))
                   for _ in range(60)])
    feed.add(click(9_000_000, "a", event="startup"))
    store = BatchTable(str(tmp_path / "top"))
    counts = users.product_counts(feed.stream(), delay="10 minutes")
    run(batches.top_n_stream(counts, ["w_start", "w_end", "event", "category"], "cnt", ["product"], store.write),
        tmp_path / "cp")
    assert rows(store.read(spark).drop("batch")) == rows(plans.top_products(spark.read.text(str(feed.root))))


def test_top_products_on_timer(feed, spark, tmp_path):
    feed.add(*[click(1000, p) for p in "aabbbcd"])
    feed.add(*[click(2000, p) for p in "ddddx"], click(1, None, category=None))
    feed.add(click(900_000, "z"))
    top = plans.top_products_on_timer(feed.stream(), size="5 minutes", slide=None)
    got = to_table(spark, top, tmp_path).filter("category = 'c'")
    assert rows(got, "w_start", "rank", "product", "cnt") == [(0, 1, "d", 5), (0, 2, "b", 3), (0, 3, "a", 2)]


def test_order_item_join_stream_equals_batch(spark, tmp_path):
    items, orders = Feed(spark, tmp_path / "items"), Feed(spark, tmp_path / "orders")
    items.add("1,o1,1000,s,1,2", "2,o2,6000,s,1,2", "3,o1,2000,s,1,2")
    orders.add("o1,4000,10", "o2,4000,20", "o3,1000,30")
    items.add("9,end,90000,s,1,2")
    orders.add("end,90000,1")
    joined = to_table(spark, plans.order_item_join(items.stream(), orders.stream()), tmp_path)
    got = rows(joined.filter("w_start < 90000"), "item_itemId", "order_orderId", "order_money")
    assert got == [(1, "o1", 10.0), (2, None, None), (3, "o1", 10.0)]


# -- keyed state ----------------------------------------------------------------------------------

@pytest.mark.parametrize("keep_values", [False, True])
def test_average_every_three_stream(feed, spark, tmp_path, keep_values):
    for line in ["1,3", "1,7", "2,4", "1,5", "2,2", "2,5", "1,9"]:
        feed.add(line)
    numbers = parse_delimited(feed.stream(), schemas.KEYED_NUMBER)
    got = to_table(spark, stateful.average_every_stream(numbers, "key", "value", 3, keep_values), tmp_path)
    assert rows(got, "key", "avg") == [(1, 5.0), (2, 11 / 3)]


def test_first_seen_stream(feed, spark, tmp_path):
    def start(device, kind, nu=0):
        return json.dumps({"event": "startup", "device": device, "deviceType": kind, "nu": nu, "time": 1})

    feed.add(start("d1", "phone"))
    feed.add(start("d1", "phone"), "broken{", start("d1", "tv"))
    feed.add(start("d1", "phone", 3), start("d2", "tv"))
    got = to_table(spark, plans.first_time_users(feed.stream(), column="nu"), tmp_path)
    assert rows(got, "batch", "device", "deviceType", "nu") == [
        (0, "d1", "phone", 1), (1, "d1", "phone", 0), (1, "d1", "tv", 1), (2, "d1", "phone", 3), (2, "d2", "tv", 1)]


@pytest.mark.parametrize("ttl_ms, second", [(stateful.DAY_MS, 7.0), (1, 4.0)])
def test_state_expires(feed, spark, tmp_path, ttl_ms, second):
    store = BatchTable(str(tmp_path / "ttl"))
    for line in ["1,3", "1,4"]:
        feed.add(line)
        numbers = parse_delimited(feed.stream(), schemas.KEYED_NUMBER)
        totals = stateful.expiring_totals(numbers, "key", "value", ttl_ms)
        # One batch per run: state with an expiry time keeps an available-now query going for ever.
        sinks.start(totals.writeStream.outputMode("update").foreachBatch(store.write), str(tmp_path / "cp"),
                    {"once": True}).awaitTermination(60)
    assert rows(store.read(spark), "batch", "total") == [(0, 3.0), (1, second)]


# -- sinks ----------------------------------------------------------------------------------------

def test_hash_sink_restarts_without_loss_or_repeat(feed, spark, tmp_path):
    store = BatchTable(str(tmp_path / "hash"))

    def job():
        counts = plans.count_words_stream(feed.stream())
        return counts.writeStream.outputMode("update").foreachBatch(sinks.hash_sink(store, "wc", "word", "n"))

    feed.add("a,b", "a")
    run(job(), tmp_path / "cp")
    feed.add("a,c")
    run(job(), tmp_path / "cp")
    run(job(), tmp_path / "cp")
    assert rows(sinks.read_hash(spark, store)) == [("wc", "a", "3"), ("wc", "b", "1"), ("wc", "c", "1")]
    # A replayed batch replaces itself.
    batch = store.read(spark).filter("batch = 0").select("field", "value").toDF("word", "n").collect()
    sinks.hash_sink(store, "wc", "word", "n")(spark.createDataFrame(batch), 0)
    assert rows(sinks.read_hash(spark, store)) == [("wc", "a", "3"), ("wc", "b", "1"), ("wc", "c", "1")]


def test_word_count_hash_reads_a_file_and_a_folder(spark, tmp_path):
    from streamlytics.catalog import streams

    docs = spark.createDataFrame([(i, "a b" if i % 2 else "a  c") for i in range(10)], "doc_id bigint, text string")
    docs.repartition(3).write.parquet(str(tmp_path / "folder" / "documents.parquet"))
    docs.coalesce(1).write.parquet(str(tmp_path / "one"))
    (tmp_path / "file").mkdir()
    next((tmp_path / "one").glob("*.parquet")).rename(tmp_path / "file" / "documents.parquet")
    for kind in ("folder", "file"):
        got = rows(streams.stream_word_count_hash(spark, str(tmp_path / kind)))
        assert got == [("wc", "a", "10"), ("wc", "b", "5"), ("wc", "c", "5")], kind


def test_failed_batch_is_taken_again(feed, spark, tmp_path):
    store = BatchTable(str(tmp_path / "set"))
    feed.add("k,m1", "k,m1")
    feed.add("k,m2")
    write = sinks.set_sink(store, "word", "n")
    broken = {"left": 1}

    def flaky(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and broken["left"]:
            broken["left"] = 0
            raise RuntimeError("sink went away after writing")

    def job():
        pairs = feed.stream().select(F.split_part("value", F.lit(","), F.lit(1)).alias("word"),
                                     F.split_part("value", F.lit(","), F.lit(2)).alias("n"))
        return pairs.writeStream.foreachBatch(flaky)

    with pytest.raises(Exception, match="sink went away"):
        run(job(), tmp_path / "cp")
    run(job(), tmp_path / "cp")
    assert rows(sinks.read_set(spark, store)) == [("k", "m1"), ("k", "m2")]
    assert store.read(spark).count() == 2


def test_sketches_and_bitmaps_unite_over_batches(spark, tmp_path):
    one = spark.createDataFrame([("k", 1), ("k", 2), ("j", 1)], "key string, u bigint")
    two = spark.createDataFrame([("k", 2), ("k", 3)], "key string, u bigint")
    sketches, bitmaps = BatchTable(str(tmp_path / "s")), BatchTable(str(tmp_path / "b"))
    for i, part in enumerate((one, two)):
        sinks.sketch_sink(sketches, ["key"], "u")(part, i)
        sinks.bitmap_sink(bitmaps, ["key"], "u")(part, i)
    assert rows(sinks.read_sketches(spark, sketches, ["key"])) == [("j", 1), ("k", 3)]
    assert rows(sinks.read_bitmaps(spark, bitmaps, ["key"])) == [("j", 1, 1), ("k", 4, 3)]


def test_csv_stream(feed, spark, tmp_path):
    feed.add("1,x,2.5")
    out = str(tmp_path / "csv")
    df = parse_delimited(feed.stream(), schemas.ACCESS).select("domain", "traffic")
    sinks.csv_stream(df, out, str(tmp_path / "cp"), {"availableNow": True}).awaitTermination()
    assert rows(spark.read.schema("domain string, traffic double").csv(out)) == [("x", 2.5)]


def test_fan_out_and_console(feed, spark, tmp_path):
    feed.add("a")
    seen = []
    run(feed.stream().writeStream.foreachBatch(sinks.fan_out(
        lambda b, i: seen.append(("one", b.count())), lambda b, i: seen.append(("two", b.count())))), tmp_path / "cp")
    assert seen == [("one", 1), ("two", 1)]
    run(sinks.console(feed.stream(), "order"), tmp_path / "cp2")


def test_update_mode_emits_running_totals(feed, spark, tmp_path):
    feed.add("a,1")
    feed.add("a,2")
    rows_ = feed.stream().select(F.split_part("value", F.lit(","), F.lit(1)).alias("k"),
                                 F.split_part("value", F.lit(","), F.lit(2)).cast("int").alias("v"))
    got = to_table(spark, ops.keyed_sum(rows_, "k", "v"), tmp_path, "update")
    assert rows(got, "batch", "k", "v") == [(0, "a", 1), (1, "a", 3)]


# -- JDBC, without a database ---------------------------------------------------------------------

def test_upsert_stages_last_rows_and_merges_once(spark):
    staged, statements = [], []
    write = sinks.jdbc_upsert_sink(
        "jdbc:x", "traffic", ["domain"], ["traffic"], order=["seq"],
        execute=lambda session, url, sql, connection: statements.append((url, sql)),
        stage=lambda df, options: staged.append((rows(df), options["dbtable"])))
    batch = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 5), ("b", 3.0, 2)], "domain string, traffic double, seq int")
    write(batch, 0)
    assert staged == [([("a", 2.0), ("b", 3.0)], "traffic_upsert_staging")]
    assert statements == [("jdbc:x", (
        "MERGE INTO traffic t USING traffic_upsert_staging s ON t.domain = s.domain "
        "WHEN MATCHED THEN UPDATE SET traffic = s.traffic "
        "WHEN NOT MATCHED THEN INSERT (domain, traffic) VALUES (s.domain, s.traffic)"))]


def test_upsert_dialects():
    args = ("t", "t_s", ["a", "b"], ["v", "w"])
    assert sinks.merge_statement(*args, "duplicate_key") == (
        "INSERT INTO t (a, b, v, w) SELECT a, b, v, w FROM t_s s ON DUPLICATE KEY UPDATE v = s.v, w = s.w")
    assert sinks.merge_statement(*args, "conflict") == (
        "INSERT INTO t (a, b, v, w) SELECT a, b, v, w FROM t_s s WHERE true "
        "ON CONFLICT (a, b) DO UPDATE SET v = excluded.v, w = excluded.w")
    with pytest.raises(ValueError):
        sinks.merge_statement(*args, "other")


def test_empty_store_and_compaction(spark, tmp_path):
    store = BatchTable(str(tmp_path / "h"), "hash string, field string, value string")
    assert sinks.read_hash(spark, store).collect() == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        BatchTable(str(tmp_path / "none")).read(spark)
    for i in range(4):
        frame = spark.createDataFrame([("a", str(i)), (f"b{i}", "x"), (None, str(i))], "f string, v string")
        sinks.hash_sink(store, "h", "f", "v")(frame, i)
    folded = BatchTable(str(tmp_path / "folded"))
    sinks.compact_hash(spark, store, folded, 2)
    folded.write(store.read_batch(spark, 3), 3)
    assert rows(sinks.read_hash(spark, folded)) == rows(sinks.read_hash(spark, store))
    assert rows(sinks.read_hash(spark, store), "field", "value") == sorted(
        [("a", "3"), (None, "3"), *((f"b{i}", "x") for i in range(4))], key=repr)


def test_compacted_sets_and_sketches_read_alike(spark, tmp_path):
    names = ("set", "folded_set", "sketch", "folded_sketch")
    members, folded, sketches, united = (BatchTable(str(tmp_path / n)) for n in names)
    for i in range(3):
        frame = spark.createDataFrame([("a", f"u{i}"), ("a", "u0"), (f"k{i}", "x")], "k string, u string")
        sinks.set_sink(members, "k", "u")(frame, i)
        sinks.sketch_sink(sketches, ["k"], "u")(frame, i)
    sinks.compact_set(spark, members, folded, 2)
    sinks.compact_sketches(spark, sketches, united, ["k"], 2)
    assert rows(sinks.read_set(spark, folded)) == rows(sinks.read_set(spark, members))
    assert rows(sinks.read_sketches(spark, united, ["k"])) == rows(sinks.read_sketches(spark, sketches, ["k"]))


def test_insert_options():
    assert sinks.insert_options("jdbc:x", "t", 50, {"user": "u"}) == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "50", "user": "u"}


def test_etl_rows(spark):
    line = json.dumps({"event": "startup", "time": 1706716800000, "device": "d"})
    df = spark.createDataFrame([("t_0_1", line), ("t_0_2", "bad"), ("t_0_3", '{"event":"view"}')], "id string, value string")
    out = plans.etl_rows(df, "Asia/Shanghai")
    assert out.columns == ["id", "device", "deviceType", "os", "event", "net", "channel", "uid", "nu", "ip", "time",
                           "version", "province", "city", "day", "hour", "ingest_time"]
    row = out.first()
    assert out.count() == 1 and (row.id, row.nu, row.day, row.hour) == ("t_0_1", 0, "20240201", "00")
    assert row.ingest_time > 1_700_000_000_000
