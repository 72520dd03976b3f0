from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streamlytics import operators as ops
from streamlytics import plans, schemas
from streamlytics.functions.clock import event_ts
from streamlytics.operators import distinct as distinct_ops
from streamlytics.operators.combine import tagged


def table(spark, data, schema):
    return spark.createDataFrame(data, schema)


# -- aggregates -----------------------------------------------------------------------------------

def test_word_count_golden(lines):
    assert rows(plans.count_words(lines("a,a,a,b,b", "a,a,a,b,b"))) == [("a", 6), ("b", 4)]
    assert rows(plans.count_words(lines("a,,b,"))) == [("", 1), ("a", 1), ("b", 1)]
    assert rows(plans.count_words_stream(lines("a,,b,"))) == [("a", 1), ("b", 1)]


def test_domain_traffic(lines):
    df = lines("1,x,10.5", "2,y,1", "3,x,2")
    assert rows(plans.domain_traffic(df)) == [("x", 12.5), ("y", 1.0)]
    assert rows(plans.heavy_access(lines("1,x,4000", "2,y,4000.5"))) == [(2, "y", 4000.5)]


def test_changelog(spark):
    df = table(spark, [("a", 1, 2), ("b", 2, 5), ("a", 3, 4)], "k string, s bigint, v bigint")
    changes = ops.changelog(df, ["k"], ["s"], "v")
    assert rows(changes) == sorted([(True, "a", 1, 2), (True, "b", 2, 5), (True, "a", 3, 6), (False, "a", 3, 2)], key=repr)
    assert rows(ops.latest_only(changes)) == [("a", 1, 2), ("a", 3, 6), ("b", 2, 5)]


@pytest.mark.parametrize("combine, expect", [("sum", 6), ("max", 3), ("min", 1), ("product", 6.0), ("bit_or", 3)])
def test_keyed_reduce(spark, combine, expect):
    df = table(spark, [("a", 1), ("a", 2), ("a", 3)], "k string, v bigint")
    assert ops.keyed_reduce(df, "k", "v", combine).first()["v"] == expect


def test_keyed_combine_with_own_function(spark, monkeypatch):
    monkeypatch.setattr("streamlytics.operators.aggregate.HELD_KEYS", 3)
    rng = random.Random(2)
    data = [(rng.choice(["hot", "hot", None, "b", "c", "d"]), rng.randrange(100)) for _ in range(500)]
    expect = {}
    for k, v in data:
        expect[k] = expect.get(k, 0) ^ v
    df = table(spark, data, "k string, v bigint").repartition(6)
    got = {r.k: r.v for r in ops.keyed_combine(df, "k", "v", lambda a, b: a ^ b).collect()}
    assert got == expect


def startup(os, nu, n):
    return [f'{{"event":"startup","os":"{os}","nu":{nu}}}'] * n


def test_user_counts_golden(lines):
    feed = startup("iOS", 1, 38) + startup("Android", 1, 29) + startup("iOS", 0, 17) + startup("Android", 0, 16)
    df = lines(*feed, "broken{", '{"event":"view","os":"iOS","nu":1}')
    assert rows(plans.os_users(df)) == [("Android", 0, 16), ("Android", 1, 29), ("iOS", 0, 17), ("iOS", 1, 38)]
    assert rows(plans.total_users(df)) == [(0, 33), (1, 67)]
    sets = ops.count_grouping_sets(plans.read_app_events(df).filter("event = 'startup'"), [["os", "nu"], ["nu"]])
    assert rows(sets.filter("level > 0"), "nu", "cnt") == [(0, 33), (1, 67)]


def test_salted_count_equals_plain(spark):
    df = table(spark, [("hot" if i % 3 else "cold", i) for i in range(300)], "k string, i bigint")
    assert rows(ops.salted_count(df, ["k"], "i")) == rows(ops.count_by(df, "k"))


# -- windows --------------------------------------------------------------------------------------

PURCHASES = [(1000, "u1", "b1", 75.0), (2000, "u1", "b2", 65.0), (2000, "u2", "b3", 3.0), (3000, "u1", "b4", 65.0),
             (9999, "u2", "b5", 3.0), (19999, "u1", "b6", 45.0)]


def test_tumble_golden(spark):
    df = table(spark, PURCHASES, schemas.PURCHASE).withColumn("ts", event_ts("time"))
    expect = [(0, 10000, "u1", 205.0), (0, 10000, "u2", 6.0), (10000, 20000, "u1", 45.0)]
    assert rows(plans.tumble_purchases(df)) == expect
    assert rows(plans.tumble_purchases_sql(df)) == expect


def test_window_bounds_are_half_open(spark):
    df = table(spark, [(0,), (4999,), (5000,), (-1,)], "time bigint").withColumn("ts", event_ts("time"))
    got = ops.windowed(df, [], [F.count("*").alias("n")], "5 seconds")
    assert rows(got) == [(-5000, 0, 1), (0, 5000, 2), (5000, 10000, 1)]


def test_sliding_count_equals_direct_windows(spark):
    rng = random.Random(3)
    df = table(spark, [(rng.randrange(3_600_000), rng.choice("ab")) for _ in range(400)], "time bigint, k string")
    df = df.withColumn("ts", event_ts("time"))
    direct = ops.windowed(df, ["k"], [F.count("*").alias("cnt")], "5 minutes", "1 minute")
    assert rows(ops.sliding_count(df, ["k"], "5 minutes", "1 minute")) == rows(direct)


def test_cumulative_counts_against_brute_force(spark):
    rng = random.Random(4)
    data = [(rng.randrange(600_000), rng.randrange(6), rng.randrange(2)) for _ in range(150)]
    df = table(spark, data, "time bigint, user bigint, item bigint").withColumn("ts", event_ts("time"))
    got = rows(ops.cumulative_pv_uv(df, ["item"], "user", "5 minutes", "1 minute"))
    expect = set()
    for t, _, item in data:
        start, fire = t - t % 300_000, t - t % 60_000 + 60_000
        so_far = [u for t2, u, i2 in data if i2 == item and start <= t2 < fire]
        expect.add((start, start + 300_000, item, fire, len(so_far), len(set(so_far))))
    assert got == sorted(expect, key=repr)


def test_local_and_utc_day_windows(lines):
    # Two views on one Shanghai date, on either side of midnight UTC.
    feed = lines('{"user_id":1,"itemId":5,"behavior":"pv","ts":1706745600000}',   # 2024-02-01 00:00 UTC
                 '{"user_id":2,"itemId":5,"behavior":"pv","ts":1706738400000}')   # 2024-01-31 22:00 UTC
    local = plans.item_pv_uv(feed).groupBy("date", "w_start").agg(F.max("uv").alias("uv"))
    assert rows(local) == [("2024-02-01", 1706716800000, 2)]
    utc = plans.item_pv_uv(feed, local_days=False).groupBy("date", "w_start").agg(F.max("uv").alias("uv"))
    assert [r[2] for r in rows(utc)] == [1, 1]


# -- distinct -------------------------------------------------------------------------------------

def test_bitmap_and_exact_counts_agree(spark):
    rng = random.Random(6)
    data = [(rng.choice("xy"), rng.choice([None, *range(-40_000, 40_000, 997)])) for _ in range(500)]
    df = table(spark, data, "k string, u bigint")
    expect = sorted((k, sum(1 for a, _ in data if a == k), len({u for a, u in data if a == k and u is not None}))
                    for k in "xy")
    assert rows(distinct_ops.exact_counts(df, ["k"], "u")) == expect
    assert rows(distinct_ops.bitmap_counts(df, ["k"], "u")) == expect


def test_sketch_error_stays_small(spark):
    df = spark.range(60_000).withColumn("k", F.lit("a")).withColumn("u", F.col("id") % 20_000)
    estimate = distinct_ops.hll_counts(df, ["k"], "u").first()["uv"]
    assert abs(estimate - 20_000) < 20_000 * 0.05


@pytest.mark.parametrize("method", ["exact", "hll"])
def test_rolling_distinct_against_brute_force(spark, method):
    rng = random.Random(7)
    panes, step = 6, 1000
    data = [(rng.randrange(20_000) + (90_000 if rng.random() < 0.3 else 0), rng.randrange(12)) for _ in range(60)]
    df = table(spark, data, "time bigint, u bigint")
    got = dict(rows(distinct_ops.rolling_distinct(df, "u", panes, step, method=method)))
    expect = {}
    for end in range(0, 130_000, step):
        users = {u for t, u in data if end - panes * step <= t < end}
        if users:
            expect[end] = len(users)
    assert got == expect


# -- late rows ------------------------------------------------------------------------------------

def test_late_rows_golden(spark):
    data = [(1, 1000, "a", 1), (2, 4999, "a", 1), (3, 3000, "a", 5), (4, 6000, "b", 1)]
    df = table(spark, data, "seq bigint, time bigint, word string, n int")
    on_time, late = ops.split_late(df, ["seq"], 5000)
    assert rows(late, "word", "n") == [("a", 5)]
    sums = ops.windowed(on_time.withColumn("ts", event_ts("time")), ["word"], [F.sum("n").alias("n")], "5 seconds")
    assert rows(sums) == [(0, 5000, "a", 2), (5000, 10000, "b", 1)]


def test_delay_two_seconds_closes_at_6999(spark):
    df = table(spark, [(1, 6998), (2, 1000), (3, 6999), (4, 1001)], "seq bigint, time bigint")
    _, late = ops.split_late(df, ["seq"], 5000, 2000)
    assert rows(late) == [(4, 1001)]


def test_late_flags_against_brute_force(spark):
    rng = random.Random(8)
    data = [(i, rng.randrange(0, 60_000)) for i in range(400)]
    df = table(spark, data, "seq bigint, time bigint")
    got = {r.seq: r.is_late for r in ops.flag_late(df, ["seq"], 5000, 3000).collect()}
    top = None
    for seq, t in data:
        assert got[seq] == (top is not None and top - 3000 >= t - t % 5000 + 4999)
        top = t if top is None else max(top, t)


@pytest.mark.parametrize("delay, initial", [(0, None), (3000, None), (0, 31_000)])
def test_late_flags_with_shared_arrival_numbers(spark, delay, initial):
    """Two arrival columns, the first with few values; times at the last millisecond of a window among them."""
    rng = random.Random(28)
    data = [(rng.randrange(6), i, rng.choice([rng.randrange(0, 60_000), 5000 * rng.randrange(1, 12) - 1])) for i in range(300)]
    data.append((3, 1000, None))
    df = table(spark, data, "day bigint, seq bigint, time bigint")
    got = {r.seq: r.is_late for r in ops.flag_late(df, ["day", "seq"], 5000, delay, initial_max=initial).collect()}
    top = initial
    for _, seq, t in sorted(data, key=lambda x: x[:2]):
        assert got[seq] == (t is not None and top is not None and top - delay >= t - t % 5000 + 4999)
        top = max((x for x in (top, t) if x is not None), default=None)
    assert len(got) == 301


def test_late_flags_leave_rows_in_their_tasks(spark):
    df = spark.range(1000).select("id", (F.col("id") * 700 % 90_001).alias("time"))
    plan = ops.flag_late(df, ["id"], 5000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Sort [" not in plan


# -- sequences ------------------------------------------------------------------------------------

NUMBERS = [(1, 3), (1, 7), (2, 4), (1, 5), (2, 2), (2, 5)]


def test_average_of_three_golden(spark):
    df = table(spark, [(k, v, i) for i, (k, v) in enumerate(NUMBERS)], "key bigint, value bigint, seq bigint")
    assert rows(ops.average_every(df, "key", "value", ["seq"]), "key", "avg") == [(1, 5.0), (2, 11 / 3)]
    assert ops.average_every(df.filter("seq < 5"), "key", "value", ["seq"]).count() == 1


def test_first_seen(spark):
    data = [(1, "phone", "d1", 10, 0), (2, "phone", "d1", 5, 0), (3, "tv", "d1", 99, 7), (4, None, None, 1, 0),
            (5, None, None, 2, 3)]
    df = table(spark, data, "id bigint, deviceType string, device string, time bigint, nu int")
    got = ops.first_seen(df, ["deviceType", "device"], ["time"], "id")
    assert rows(got, "id", "nu") == [(1, 0), (2, 1), (3, 1), (4, 1), (5, 3)]
    extra = ops.first_seen(df, ["deviceType", "device"], ["time"], "id", "nu2")
    assert rows(extra, "id", "nu", "nu2") == [(1, 0, 0), (2, 0, 1), (3, 7, 1), (4, 0, 1), (5, 3, 0)]


# -- joins ----------------------------------------------------------------------------------------

def test_order_item_join_golden(lines):
    items = lines("1,o1,1000,s,1,2", "2,o2,6000,s,1,2", "3,o1,2000,s,1,2")
    orders = lines("o1,4000,10", "o2,4000,20", "o3,1000,30")
    got = rows(plans.order_item_join(items, orders), "item_itemId", "order_orderId", "order_money")
    assert got == [(1, "o1", 10.0), (2, None, None), (3, "o1", 10.0)]


def test_late_items_are_looked_up(spark):
    feed = [(1, "1,o1,1000,s,1,2"), (2, "2,o2,6000,s,1,2"), (3, "3,o1,2000,s,1,2"), (4, "4,o9,6500,s,1,2")]
    items = table(spark, feed, "seq bigint, value string")
    orders = table(spark, [("o1,4000,10",), ("o2,4000,20",)], "value string")
    got = rows(plans.order_item_repair(items, orders, ["seq"]), "item_itemId", "order_money", "source")
    assert got == [(1, 10.0, "window"), (2, 20.0, "table"), (3, 10.0, "table"), (4, None, "none")]


@pytest.mark.parametrize("one_table", [True, False])
def test_repair_with_repeated_and_missing_keys(spark, one_table):
    """Against plain loops: keys that come more than once, in one window or several, or are null on either side."""
    rng = random.Random(30)
    keys = [None, "a", "b", "c", "d"]
    item = [(i, rng.choice([*keys, "e"]), rng.randrange(20_000), rng.random() < 0.4) for i in range(60)]
    seen, kept = ([(n + j, rng.choice(keys), rng.randrange(20_000), j / 2) for j in range(12)] for n in (0, 100))
    order_type = "no bigint, orderId string, time bigint, money double"
    items = table(spark, item, "id bigint, orderId string, time bigint, is_late boolean").withColumn("ts", event_ts("time"))
    orders, order_table = (table(spark, x, order_type).withColumn("ts", event_ts("time")) for x in (seen, kept))
    if one_table:
        kept, order_table = seen, orders
    got = ops.repair_late_items(items, orders, order_table, "orderId")
    want = []
    for i, key, t, late in item:
        here = [o for o in seen if key is not None and o[1] == key and o[2] // 5000 == t // 5000 and not late]
        found = here or [o for o in kept if key is not None and o[1] == key]
        source = "window" if here else "table" if found else "none"
        want += [(i, key, t, *o, source) for o in found or [(None,) * 4]]
    assert rows(got) == sorted(want, key=repr)
    assert got.columns == ["item_id", "item_orderId", "item_time", "order_no", "order_orderId", "order_time", "order_money", "source"]


def test_repair_moves_items_once(spark):
    items = spark.range(1000).selectExpr(
        "id", "cast(id % 50 as string) orderId", "id * 100 time", "false is_late", "timestamp_millis(id * 100) ts")
    orders = spark.range(50).selectExpr("cast(id as string) orderId", "id * 900 time", "timestamp_millis(id * 900) ts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ops.repair_late_items(items, orders, orders, "orderId")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("SortMergeJoin") == 1


@pytest.mark.parametrize("way", ["prefix", "merge"])
def test_enrich_ip(spark, lines, way):
    wide = 1 << 16
    ranges = table(spark, [(10, 20, "P", "C"), (21, 40, "Q", "D"), (wide - 5, 3 * wide, "W", "E")], schemas.IP_RANGE)
    ips = lines("0.0.0.10", "0.0.0.20", "0.0.0.21", "0.0.0.41", "0.0.0.9", "0.2.7.7", "0.0.255.255", "bad", None,
                "0.0.0.10").withColumnRenamed("value", "ip")
    got = rows(ops.enrich_ip(ips, ranges, way=way), "ip", "province", "city")
    assert got == sorted([
        ("0.0.0.10", "P", "C"), ("0.0.0.10", "P", "C"), ("0.0.0.20", "P", "C"), ("0.0.0.21", "Q", "D"),
        ("0.0.0.41", "-", "-"), ("0.0.0.9", "-", "-"), ("0.2.7.7", "W", "E"), ("0.0.255.255", "W", "E"),
        ("bad", "-", "-"), (None, "-", "-")], key=repr)


@pytest.mark.parametrize("way", ["prefix", "merge"])
def test_enrich_ip_with_overlaps_gives_one_row_and_the_innermost(spark, lines, way):
    rng = random.Random(3)
    ranges = [(0, 100, "A", "a"), (50, 60, "B", "b"), (50, 60, "B", "b"), (50, 55, "C", "c"), (65_000, 200_000, "D", "d"),
              (131_000, 131_100, "E", "e"), (9, 3, "X", "x")]
    ranges += [(s, s + rng.randrange(40), f"P{i}", f"c{i}") for i, s in enumerate(rng.choices(range(300, 500), k=25))]
    numbers = [*range(0, 120), *range(295, 560), 64_999, 65_000, 65_535, 65_536, 131_050, 131_101, 200_000, 200_001]
    ips = lines(*(f"0.{n >> 16}.{n >> 8 & 255}.{n & 255}" for n in numbers)).withColumnRenamed("value", "ip")
    want = []
    for n in numbers:
        inside = sorted(((-s, e, p, c) for s, e, p, c in ranges if s <= n <= e))
        want.append((f"0.{n >> 16}.{n >> 8 & 255}.{n & 255}", *(inside[0][2:] if inside else ("-", "-"))))
    assert rows(ops.enrich_ip(ips, table(spark, ranges, schemas.IP_RANGE), way=way), "ip", "province", "city") == sorted(want, key=repr)


def test_enrich_ip_with_empty_dimension(spark, lines):
    empty = table(spark, [], schemas.IP_RANGE)
    assert rows(ops.enrich_ip(lines("1.1.1.1").withColumnRenamed("value", "ip"), empty), "province") == [("-",)]


# -- top-k, routing -------------------------------------------------------------------------------

def test_top_products(lines):
    def buy(name, t, event="view", category="c"):
        return f'{{"event":"{event}","time":{t},"product":{{"category":"{category}","name":"{name}"}}}}'

    feed = [buy("a", 0)] * 3 + [buy("b", 1000)] * 3 + [buy("c", 2000)] * 5 + [buy("d", 3000)] + [
        buy("s", 1, event="startup"), '{"event":"view","time":5}', '{"time":6,"product":{"category":"c","name":"z"}}']
    got = plans.top_products(lines(*feed)).filter("w_start = 0")
    assert rows(got.filter("event = 'view' and category = 'c'"), "rank", "product", "cnt") == [
        (1, "c", 5), (2, "a", 3), (3, "b", 3)]
    assert rows(got.filter("category is null"), "event", "product", "cnt") == [("view", None, 1)]
    assert rows(got.filter("event is null"), "product") == [("z",)]
    lists = ops.top_lists(got.filter("category = 'c' and event = 'view'"), ["w_start", "event", "category"],
                          ["product", "cnt"])
    assert [tuple(x) for x in lists.first()["top"]] == [(1, "c", 5), (2, "a", 3), (3, "b", 3)]


def test_route(spark):
    df = table(spark, [("www.a.com",), ("a.com",), ("zzz",), (None,)], "domain string")
    placed = ops.route(df, "domain", {"www.a.com": 0, "a.com": 1}, 2, 3).withColumn("p", F.spark_partition_id())
    assert rows(placed) == sorted([("www.a.com", 0), ("a.com", 1), ("zzz", 2), (None, 2)], key=repr)


def test_exchange_and_parallelism(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    spread = ops.hash_exchange(df, "k", partitions=5).withColumn("p", F.spark_partition_id())
    assert spread.groupBy("k").agg(F.countDistinct("p").alias("n")).filter("n > 1").count() == 0
    assert ops.set_parallelism(df, 3).rdd.getNumPartitions() == 3
    assert ops.set_parallelism(ops.set_parallelism(df, 6), 2, shuffle=False).rdd.getNumPartitions() == 2


def test_tagged(lines):
    assert rows(tagged(lines("a"), "x")) == [("x", "a")]


def test_keyed_combine_takes_nan_keys_as_one(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1), (1.0, 2), (nan, 3), (None, 4), (1.0, 5), (nan, 6), (None, 7)], "k double, v bigint").repartition(5)
    got = ops.keyed_combine(df, "k", "v", lambda a, b: a + b, "t", salts=2)
    assert sorted(repr(tuple(r)) for r in got.collect()) == ["(1.0, 7)", "(None, 11)", "(nan, 10)"]
