"""Batch queries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlytics import operators as ops
from streamlytics import plans, schemas
from streamlytics.catalog import inputs
from streamlytics.catalog.inputs import APP, DAY, DIM, MINUTE, SHOP
from streamlytics.catalog.registry import query
from streamlytics.functions import clock, delimited, guards, jsonline, udfs
from streamlytics.plans import shopping, users
from streamlytics.session import materialize, shared_dir
from streamlytics.sources import csv_view, kafka_records, text_lines
from streamlytics.streaming import sinks

WORD = r"regexp_replace(lower(w), '^[\x01-\x20]+|[\x01-\x20]+$', '', 'g')"


def _words(column: str, source: str, sep: str = " ") -> str:
    return f"SELECT unnest(string_split(rtrim({column}, '{sep}'), '{sep}')) AS w FROM {source}"


# -- lines and parsing ----------------------------------------------------------------------------

@query(f"SELECT {WORD} AS word, count(*) AS n FROM ({_words('text', 'documents')}) GROUP BY 1")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return plans.count_words(lines, " ")


@query(f"""
SELECT w AS word, count(*) AS n FROM ({_words('text', 'conversations', ',')}) WHERE w <> '' GROUP BY 1
""")
def word_count_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "conversations").select(F.col("text").alias("value"))
    return plans.count_words_stream(lines, ",", normalise=False)


@query("""
SELECT page_id * 1000 AS time, split_part(url, '/', 3) AS domain, CAST(length(html) AS DOUBLE) AS traffic
FROM pages WHERE length(html) > 4000
""")
def access_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.heavy_access(inputs.access_lines(spark, sf_dir))


@query("""
SELECT CAST(l_partkey AS INTEGER) AS itemId, CAST(l_orderkey AS VARCHAR) AS orderId,
       (epoch_us(l_shipdate) // 1000) AS time, 's' || l_suppkey AS sku, l_quantity AS amount, l_extendedprice AS money
FROM lineitem
""")
def delimited_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.parse_delimited(inputs.item_lines(spark, sf_dir), schemas.ITEM)


@query("SELECT md5(text) AS digest FROM documents")
def delimited_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines mixed with documents: every document is rejected, no order is."""
    documents = inputs.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    lines = ops.union_all(inputs.order_lines(spark, sf_dir), documents)
    return delimited.split_delimited(lines, schemas.ORDER)[1].select(F.md5("value").alias("digest"))


@query("""
SELECT event_id, CAST(props->>'$.k' AS INTEGER) * 2 AS doubled FROM events
WHERE CAST(props->>'$.k' AS INTEGER) >= 5
""")
def map_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).filter(F.col("k") >= 5)
    return rows.select("event_id", (F.col("k") * 2).alias("doubled"))


def _mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App events among lines that are no JSON at all."""
    documents = inputs.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return ops.union_all(inputs.app_event_lines(inputs.events(spark, sf_dir)).select("value"), documents)


@query(f"WITH {APP} SELECT device, deviceType, event, nu, ip, time, category, product FROM app")
def json_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.read_app_events(_mixed_lines(spark, sf_dir)).select(
        "device", "deviceType", "event", "nu", "ip", "time", F.col("product.category").alias("category"),
        F.col("product.name").alias("product"))


@query("SELECT md5(text) AS digest FROM documents")
def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = jsonline.split_json(
        _mixed_lines(spark, sf_dir), schemas.APP_EVENT, defaults=schemas.APP_EVENT_DEFAULTS)[1]
    return rejected.select(F.md5("value").alias("digest"))


@query(f"WITH {APP} SELECT event_id, event, time FROM app WHERE event <> 'startup'")
def not_startup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = users.read_app_events(inputs.app_event_lines(inputs.events(spark, sf_dir)), ("event_id",))
    return rows.filter(guards.not_equal("event", "startup")).select("event_id", "event", "time")


@query("""
SELECT strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H') AS hour,
       CAST(ts + INTERVAL 8 HOUR AS DATE) AS local_day, count(*) AS cnt
FROM events GROUP BY 1, 2, 3
""")
def day_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clock.day_hour(inputs.events(spark, sf_dir)).withColumn("local_day", clock.local_date("time"))
    return ops.count_by(rows, "day", "hour", "local_day")


@query("SELECT md5(text) AS digest FROM documents WHERE text NOT LIKE '%th%'")
def poison_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return guards.quarantine_poison(documents, "th")[0].select(F.md5("value").alias("digest"))


@query("""
SELECT 'user_behavior_' || (event_id % 4) || '_' || event_id AS id, props AS value FROM events
""")
def kafka_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    return kafka_records(inputs.kafka_rows(rows))


# -- functions ------------------------------------------------------------------------------------

@query(f"""
WITH {APP}, {DIM}
SELECT event_id, ip, coalesce(province, '-') AS province, coalesce(city, '-') AS city
FROM app LEFT JOIN dim ON ip_num BETWEEN start_ip AND end_ip
""")
def ip_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = users.read_app_events(inputs.app_event_lines(inputs.events(spark, sf_dir)), ("event_id",))
    return ops.enrich_ip(rows.select("event_id", "ip"), inputs.ip_ranges(spark, sf_dir))


@query(f"""
WITH {APP}, {DIM}
SELECT event_id, ip, coalesce(province, '-') AS province, coalesce(city, '-') AS city
FROM app LEFT JOIN dim ON ip_num BETWEEN start_ip AND end_ip
""")
def ip_enrich_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by one sorted axis of addresses and ranges."""
    rows = users.read_app_events(inputs.app_event_lines(inputs.events(spark, sf_dir)), ("event_id",))
    return ops.enrich_ip(rows.select("event_id", "ip"), inputs.ip_ranges(spark, sf_dir), way="merge")


@query(f"""
WITH {APP}, {DIM}
SELECT event_id, ip, coalesce(province, '-') || '-' || coalesce(city, '-') AS place
FROM app LEFT JOIN dim ON ip_num BETWEEN start_ip AND end_ip
""")
def ip_parser_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    udfs.register_ip_parser(spark, inputs.ip_ranges(spark, sf_dir))
    rows = users.read_app_events(inputs.app_event_lines(inputs.events(spark, sf_dir)), ("event_id",))
    rows.createOrReplaceTempView("app_access")
    return spark.sql("select event_id, ip, ip_parser(ip) as place from app_access")


@query("SELECT event_id, value * 2 AS doubled FROM events")
def lifecycle_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).select("event_id", "value")
    return udfs.map_with_lifecycle(
        rows, "event_id bigint, doubled double",
        lambda factor, batch: batch.assign(doubled=batch["value"] * factor)[["event_id", "doubled"]],
        setup=lambda: 2.0)


@query(f"SELECT w AS word, count(*) AS n FROM ({_words('text', 'conversations', ' ')}) GROUP BY 1")
def split_words_udtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    udfs.register_split_words(spark)
    inputs.table(spark, sf_dir, "conversations").createOrReplaceTempView("chat")
    return spark.sql("select word, count(*) as n from chat, lateral split_words(text, ' ') group by word")


# -- sums and counts ------------------------------------------------------------------------------

@query("""
SELECT event_id, user_id, CAST(sum(CAST(props->>'$.k' AS BIGINT)) OVER
         (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
FROM events
""")
def running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).select("event_id", "user_id", "k")
    return ops.running_sum(rows, ["user_id"], ["event_id"], "k").select("event_id", "user_id", "total")


@query("""
SELECT split_part(url, '/', 3) AS domain, CAST(sum(length(html)) AS DOUBLE) AS traffic FROM pages GROUP BY 1
""")
def domain_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines through a text file, as the job reads them."""
    path = shared_dir(spark, "access_lines")
    inputs.access_lines(spark, sf_dir).write.text(path)
    return plans.domain_traffic(text_lines(spark, path))


@query("""
SELECT split_part(url, '/', 3) AS domain, CAST(sum(length(html)) AS DOUBLE) AS traffics FROM pages GROUP BY 1
""")
def domain_traffic_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    access = delimited.parse_delimited(inputs.access_lines(spark, sf_dir), schemas.ACCESS)
    return plans.domain_traffic_sql(access)


@query("""
SELECT split_part(url, '/', 3) AS domain, CAST(length(html) AS DOUBLE) AS traffic
FROM pages WHERE split_part(url, '/', 3) LIKE '%.example.com'
""")
def table_select_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    access = delimited.parse_delimited(inputs.access_lines(spark, sf_dir), schemas.ACCESS)
    access.toDF("time", "domain", "traffic").createOrReplaceTempView("access_rows")
    return spark.sql("select domain, traffic from access_rows where domain like '%.example.com'")


CHANGES = """
runs AS (
  SELECT user_id, event_id,
         CAST(sum(k) OVER w AS BIGINT) AS total, row_number() OVER w AS n, k
  FROM (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events)
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)
)
"""


@query(f"""
WITH {CHANGES}
SELECT true AS is_latest, user_id, event_id, total FROM runs
UNION ALL
SELECT false, user_id, event_id, total - k FROM runs WHERE n > 1
""")
def changelog_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.changelog(inputs.events(spark, sf_dir), ["user_id"], ["event_id"], "k")


@query(f"WITH {CHANGES} SELECT user_id, event_id, total FROM runs")
def changelog_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.latest_only(ops.changelog(inputs.events(spark, sf_dir), ["user_id"], ["event_id"], "k"))


@query("""
SELECT event_type, CAST(max(CAST(props->>'$.k' AS INTEGER)) AS INTEGER) AS top FROM events GROUP BY 1
""")
def keyed_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.keyed_reduce(inputs.events(spark, sf_dir), "event_type", "k", "max", "top")


@query("SELECT user_id, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def keyed_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).select("user_id", F.col("k").cast("bigint").alias("k"))
    return ops.keyed_combine(rows, "user_id", "k", lambda a, b: a + b, "total")


@query("""
SELECT user_id, list_reduce(list(CAST(props->>'$.k' AS BIGINT) * 6), lambda a, b: gcd(a, b)) AS divisor FROM events GROUP BY 1
""")
def keyed_combine_gcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A combine that no built-in aggregate does: the greatest common divisor."""
    rows = inputs.events(spark, sf_dir).select("user_id", (F.col("k").cast("bigint") * 6).alias("k"))
    return ops.keyed_combine(rows, "user_id", "k", math.gcd, "divisor")


@query(f"WITH {APP} SELECT os, nu, count(*) AS cnt FROM app WHERE event = 'startup' GROUP BY 1, 2")
def os_user_cnt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.os_users(_mixed_lines(spark, sf_dir))


@query(f"WITH {APP} SELECT nu, count(*) AS cnt FROM app WHERE event = 'startup' GROUP BY 1")
def nu_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.total_users(_mixed_lines(spark, sf_dir))


@query(f"""
WITH {APP}
SELECT os, nu, count(*) AS cnt, CAST(grouping(os, nu) AS BIGINT) AS level
FROM app WHERE event = 'startup' GROUP BY GROUPING SETS ((os, nu), (nu))
""")
def os_user_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_grouping_sets(users.startups(_mixed_lines(spark, sf_dir)), [["os", "nu"], ["nu"]])


@query(f"""
WITH {APP}, {DIM}
SELECT coalesce(province, '-') AS province, nu, count(*) AS cnt
FROM app LEFT JOIN dim ON ip_num BETWEEN start_ip AND end_ip
WHERE event = 'startup' GROUP BY 1, 2
""")
def province_user_cnt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.province_users(_mixed_lines(spark, sf_dir), inputs.ip_ranges(spark, sf_dir))


# -- distinct users -------------------------------------------------------------------------------

def _shopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.shopping_lines(inputs.events(spark, sf_dir))


@query(f"""
WITH {SHOP}
SELECT time - time % 3600000 AS w_start, time - time % 3600000 + 3600000 AS w_end, count(DISTINCT user_id) AS uv
FROM shop WHERE event_type = 'view' GROUP BY 1, 2
""")
def uv_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.hourly_uv(_shopping(spark, sf_dir))


ITEM_UV = f"""
WITH {SHOP}
SELECT date, itemId, count(*) AS pv, count(DISTINCT user_id) AS uv
FROM shop WHERE event_type = 'view' GROUP BY 1, 2
"""


def _dated_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shopping.dated_views(_shopping(spark, sf_dir))


@query(ITEM_UV)
def uv_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.bitmap_counts(_dated_views(spark, sf_dir), ["date", "itemId"], "user_id")


@query(ITEM_UV)
def uv_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by a 64-bit hash of their id, in compressed sets; those of two halves of the events are merged."""
    views = _dated_views(spark, sf_dir).withColumn("hashed", F.xxhash64("user_id"))
    keys = ["date", "itemId"]
    halves = [ops.containers(views.filter(F.pmod("ts", F.lit(2)) == i), keys, "hashed") for i in (0, 1)]
    users = ops.cardinalities(ops.merge_containers(halves[0].unionByName(halves[1]), keys), keys)
    return ops.count_by(views, *keys, name="pv").join(users, keys)


@query(ITEM_UV)
def uv_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.exact_counts(_dated_views(spark, sf_dir), ["date", "itemId"], "user_id")


@query(f"""
WITH {SHOP} SELECT date, itemId, count(DISTINCT user_id) AS uv FROM shop WHERE event_type = 'view' GROUP BY 1, 2
""")
def uv_hll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.item_uv_approx(_shopping(spark, sf_dir))


@query(f"""
WITH {SHOP} SELECT date, count(DISTINCT user_id) AS uv, true AS within_bound FROM shop WHERE event_type = 'view' GROUP BY 1
""")
def uv_hll_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days have more visitors than a sketch holds exactly: the estimate against the exact number."""
    views = _dated_views(spark, sf_dir)
    exact = ops.exact_counts(views, ["date"], "user_id").select("date", "uv")
    return exact.join(ops.hll_counts(views, ["date"], "user_id", "estimate"), "date").select(
        "date", "uv", within_bound().alias("within_bound"))


def within_bound(estimate: str = "estimate", exact: str = "uv") -> Column:
    """Five standard errors of the sketch's 4096 registers."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.col(exact) * (5 * 1.04 / 64)


ROLLING = f"""
WITH {SHOP},
steps AS (SELECT user_id, time // 180000 AS step FROM shop),
placed AS (SELECT DISTINCT step + o AS last, user_id FROM steps, (SELECT unnest(range(480)) AS o))
SELECT (last + 1) * 180000 AS window_end, count(*) AS uv @ FROM placed GROUP BY 1
"""


@query(ROLLING.replace("@", ""))
def uv_rolling_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rolling_distinct(inputs.events(spark, sf_dir), "user_id", method="exact")


@query(ROLLING.replace("@", ", true AS within_bound"))
def uv_rolling_24h_hll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketches of the rolling day against the exact numbers."""
    rows = inputs.events(spark, sf_dir)
    exact = ops.rolling_distinct(rows, "user_id", method="exact")
    rough = ops.rolling_distinct(rows, "user_id", method="hll").withColumnRenamed("uv", "estimate")
    return exact.join(rough, "window_end").select("window_end", "uv", within_bound().alias("within_bound"))


# -- windows --------------------------------------------------------------------------------------

@query(f"""
WITH {SHOP}
SELECT time - time % 10000 AS w_start, time - time % 10000 + 10000 AS w_end, count(*) AS pv
FROM shop WHERE event_type = 'view' GROUP BY 1, 2
""")
def pv_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.page_views(_shopping(spark, sf_dir))


@query(f"""
WITH {SHOP}
SELECT event_type, time - time % 3600000 AS hour, count(*) AS cnt FROM shop GROUP BY 1, 2
""")
def pv_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).withColumn("hour", F.col("time") - F.pmod("time", F.lit(3_600_000)))
    return ops.salted_count(rows, ["event_type", "hour"], "event_id")


TUMBLE = f"""
WITH {APP}
SELECT time - time % 10000 AS w_start, time - time % 10000 + 10000 AS w_end, device AS user_id,
       round(sum(value), 2) AS total
FROM app GROUP BY 1, 2, 3
"""


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.events(spark, sf_dir).select(clock.event_ts("time").alias("ts"), F.concat(F.lit("d"), "user_id").alias("user_id"),
        F.col("value").alias("money"))


@query(TUMBLE)
def tumble_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = plans.tumble_purchases(_purchases(spark, sf_dir))
    return totals.withColumn("total", F.round("total", 2))


@query(TUMBLE)
def tumble_sum_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = plans.tumble_purchases_sql(_purchases(spark, sf_dir))
    return totals.withColumn("total", F.round("total", 2))


@query(f"""
WITH {APP}
SELECT time - time % 3600000 AS w_start, time - time % 3600000 + 3600000 AS w_end,
       CAST(sum(k) AS BIGINT) AS total FROM app GROUP BY 1, 2
""")
def window_all_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).withColumn("ts", clock.event_ts("time"))
    return ops.windowed(rows, [], [F.sum("k").alias("total")], "1 hour")


@query(f"""
WITH {APP}, counts AS (
  SELECT time - time % 60000 - o * 60000 AS w_start, event, category, product, count(*) AS cnt
  FROM app, (SELECT unnest(range(5)) AS o) WHERE event <> 'startup' GROUP BY ALL
)
SELECT w_start, w_start + 300000 AS w_end, event, category, product, cnt FROM counts
""")
def sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.product_counts(inputs.app_event_lines(inputs.events(spark, sf_dir)))


@query(f"""
WITH {APP}
SELECT time - time % 5000 AS w_start, time - time % 5000 + 5000 AS w_end, event, max(k) AS top, count(*) AS cnt
FROM app GROUP BY 1, 2, 3
""")
def proc_window_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing-time windows, on an explicit time of processing."""
    rows = inputs.events(spark, sf_dir).select(
        clock.event_ts("time").alias("proc_ts"), "k",
        F.when(F.col("event_type") == "signup", "startup").otherwise(F.col("event_type")).alias("event"))
    aggregates = [F.max("k").alias("top"), F.count(F.lit(1)).alias("cnt")]
    return ops.windowed(rows, ["event"], aggregates, "5 seconds", ts="proc_ts")


LATE = f"""
arrived AS (
  SELECT event_id, user_id, (epoch_us(ts) // 1000) AS time, CAST(props->>'$.k' AS INTEGER) AS k,
         (epoch_us(ts) // 1000) + (event_id * 37 % 100) * {MINUTE} AS arrival
  FROM events
),
flagged AS (
  SELECT *, coalesce(max(time) OVER (ORDER BY arrival, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 20000
             >= time - time % 3600000 + 3599999, false) AS is_late
  FROM arrived
)
"""


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.events(spark, sf_dir).withColumn("arrival", inputs.arrival())


@query(f"WITH {LATE} SELECT event_id, time, is_late FROM flagged")
def late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _arrivals(spark, sf_dir).select("event_id", "time", "arrival")
    return ops.flag_late(rows, ["arrival", "event_id"], 3_600_000, 20_000).drop("arrival")


@query(f"""
WITH {LATE}
SELECT strftime(make_timestamp((time - time % 3600000) * 1000), '[%Y-%m-%d %H:%M:%S')
       || strftime(make_timestamp((time - time % 3600000 + 3600000) * 1000), '==>%Y-%m-%d %H:%M:%S], ')
       || user_id || '==>' || sum(k) AS label
FROM flagged WHERE NOT is_late GROUP BY time - time % 3600000, user_id
""")
def on_time_window_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window sums of the rows on time, formatted as the job prints them."""
    on_time, _ = ops.split_late(_arrivals(spark, sf_dir), ["arrival", "event_id"], 3_600_000, 20_000)
    rows = on_time.withColumns({"ts": clock.event_ts("time"), "user": F.col("user_id").cast("string")})
    sums = ops.windowed(rows, ["user"], [F.sum("k").alias("n")], "1 hour")
    return sums.select(clock.window_label("w_start", "w_end", "user", "n").alias("label"))


CUMULATIVE = """
bounds AS (
  SELECT date, itemId, user_id, time,
         (time + 28800000) - (time + 28800000) % 86400000 - 28800000 AS w_start,
         time - time % 180000 + 180000 AS fire_time
  FROM shop WHERE event_type = 'view'
),
fires AS (SELECT DISTINCT w_start, date, itemId, fire_time FROM bounds)
SELECT f.w_start, f.w_start + 86400000 AS w_end, f.date, f.itemId, f.fire_time,
       count(*) AS pv, count(DISTINCT b.user_id) AS uv
FROM fires f JOIN bounds b
  ON f.w_start = b.w_start AND f.date = b.date AND f.itemId = b.itemId AND b.fire_time <= f.fire_time
GROUP BY ALL
"""


@query(f"WITH {SHOP}, {CUMULATIVE}")
def cumulative_pv_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.item_pv_uv(_shopping(spark, sf_dir))


# -- order-dependent state ------------------------------------------------------------------------

@query("""
WITH numbered AS (
  SELECT user_id, CAST(props->>'$.k' AS BIGINT) AS k,
         (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 3 AS grp
  FROM events
)
SELECT user_id, grp, sum(k) / 3.0::DOUBLE AS avg FROM numbered GROUP BY 1, 2 HAVING count(*) = 3
""")
def avg_every_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.average_every(inputs.events(spark, sf_dir), "user_id", "k", ["event_id"])


FIRST = f"""
WITH {APP}, starts AS (
  SELECT *, row_number() OVER (PARTITION BY deviceType, device ORDER BY time, event_id) AS rn
  FROM app WHERE event = 'startup'
)
"""


@query(f"{FIRST} SELECT event_id, device, deviceType, CASE WHEN rn = 1 THEN 1 ELSE nu END AS nu FROM starts")
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.app_event_lines(inputs.events(spark, sf_dir))
    return plans.first_time_users(lines, "event_id").select("event_id", "device", "deviceType", "nu")


@query(f"""
{FIRST} SELECT event_id, device, deviceType, nu, CASE WHEN rn = 1 THEN 1 ELSE 0 END AS nu2 FROM starts
""")
def first_seen_nu2(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.app_event_lines(inputs.events(spark, sf_dir))
    rows = plans.first_time_users(lines, "event_id", column="nu2")
    return rows.select("event_id", "device", "deviceType", "nu", "nu2")


BLOOM = ops.Bloom(100_000, 0.03)


@query(f"""
{FIRST} SELECT deviceType, count(*) AS rows, count(*) FILTER (WHERE rn = 1) AS exact, true AS within_bound
FROM starts GROUP BY deviceType
""")
def first_seen_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New devices by a Bloom filter for each device type, against the exact ones: no row is marked that is not a first
    one, and no more are missed than the filter's chance of an error allows (and five standard deviations)."""
    lines = inputs.app_event_lines(inputs.events(spark, sf_dir))
    starts = users.startups(lines, ("event_id",)).select("event_id", "deviceType", "device", "time")
    marked = ops.first_seen_bloom(starts, ["deviceType"], "device", "time", "event_id", "bloom", BLOOM)
    return against_exact(marked)


def against_exact(marked: DataFrame) -> DataFrame:
    exact = ops.first_seen(marked, ["deviceType", "device"], ["time"], "event_id", "first")
    found = exact.groupBy("deviceType").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("first").alias("exact"),
        F.sum((F.col("first") - F.col("bloom")).cast("bigint")).alias("missed"), F.min(F.col("first") - F.col("bloom")).alias("least"))
    allowed = BLOOM.error * F.col("exact") + 5 * F.sqrt(BLOOM.error * F.col("exact")) + 1
    return found.select("deviceType", "rows", "exact", ((F.col("least") >= 0) & (F.col("missed") <= allowed)).alias("within_bound"))


# -- joins and unions -----------------------------------------------------------------------------

ITEM_ORDERS = f"""
WITH items AS (SELECT *, (epoch_us(l_shipdate) // 1000) AS t FROM lineitem),
     placed AS (SELECT *, (epoch_us(o_orderdate) // 1000) AS t FROM orders)
SELECT i.t - i.t % ({30 * DAY}) AS w_start, CAST(l_partkey AS INTEGER) AS item_itemId,
       CAST(l_orderkey AS VARCHAR) AS item_orderId, i.t AS item_time, 's' || l_suppkey AS item_sku,
       l_quantity AS item_amount, l_extendedprice AS item_money,
       CAST(o_orderkey AS VARCHAR) AS order_orderId, o.t AS order_time, o_totalprice AS order_money
FROM items i LEFT JOIN placed o
  ON l_orderkey = o_orderkey AND i.t // ({30 * DAY}) = o.t // ({30 * DAY})
"""


@query(ITEM_ORDERS)
def windowed_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.order_item_join(
        inputs.item_lines(spark, sf_dir), inputs.order_lines(spark, sf_dir), "30 days")


REPAIR = f"""
WITH items AS (
  SELECT l_orderkey * 8 + l_linenumber AS item_id, l_orderkey, epoch_us(l_shipdate) // 1000 AS t,
         epoch_us(l_shipdate) // 1000 + ((l_orderkey * 8 + l_linenumber) * 37 % 100) * {DAY} AS arrival FROM lineitem),
flagged AS (
  SELECT *, coalesce(max(t) OVER (ORDER BY arrival, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                     >= t - t % {30 * DAY} + {30 * DAY} - 1, false) AS is_late FROM items),
placed AS (SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS t, o_totalprice AS money FROM orders)
SELECT item_id AS item_item_id, CAST(l_orderkey AS VARCHAR) AS item_orderId, i.t AS item_time,
       o.t AS order_time, o.money AS order_money,
       CASE WHEN o.t IS NULL THEN 'none'
            WHEN NOT is_late AND i.t // {30 * DAY} = o.t // {30 * DAY} THEN 'window' ELSE 'table' END AS source
FROM flagged i LEFT JOIN placed o ON l_orderkey = o_orderkey
"""
REPAIRED = ["item_item_id", "item_orderId", "item_time", "order_time", "order_money", "source"]


@query(REPAIR)
def late_repair_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items and orders; items arrive up to 99 days after they were shipped."""
    repaired = plans.order_item_repair(
        inputs.arriving_items(spark, sf_dir), inputs.order_lines(spark, sf_dir), ("arrival", "item_id"), 30 * DAY)
    return repaired.select(*REPAIRED)


@query(ITEM_ORDERS)
def co_group_left_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed left join by a function that gets both sides of an order and window; items of a busy order are dealt
    over several calls."""
    keys = ["orderId", "w_start"]
    item, order = (
        rows.withColumn("w_start", F.unix_millis(F.window("ts", "30 days")["start"])).drop("ts") for rows in (
            plans.orders.read_items(inputs.item_lines(spark, sf_dir)), plans.orders.read_orders(inputs.order_lines(spark, sf_dir))))
    columns = ["w_start", *(f"item_{c}" for c in item.columns if c != "w_start"), *(f"order_{c}" for c in order.columns if c != "w_start")]
    types = [f.dataType.simpleString() for f in (*item.schema, *order.schema) if f.name != "w_start"]
    schema = ", ".join(f"{c} {t}" for c, t in zip(columns, ["bigint", *types]))
    return ops.co_group(item, order, keys, ops.left_outer("item_", "order_", columns), schema, first="right", deal="left", rows=100_000)


@query("""
WITH e AS (SELECT user_id, event_id, event_type, value, epoch_us(ts) // 1000 AS time FROM events WHERE event_type IN ('view', 'purchase')),
n AS (SELECT *, count(*) FILTER (WHERE event_type = 'purchase') OVER (
        PARTITION BY user_id ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stretch FROM e)
SELECT user_id, max(event_id) FILTER (WHERE event_type = 'purchase') AS event_id, count(*) FILTER (WHERE event_type = 'view') AS views
FROM n GROUP BY user_id, stretch HAVING count(*) FILTER (WHERE event_type = 'purchase') = 1
""")
def co_group_views_to_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many views lie between a user's purchase and the one before: both sides are merged along time, which no join
    on a key expresses."""
    rows = inputs.events(spark, sf_dir).select("user_id", "event_id", "time", "event_type")
    bought, seen = (rows.filter(F.col("event_type") == t).drop("event_type") for t in ("purchase", "view"))
    return ops.co_group(bought, seen, ["user_id"], ops.count_between("time", "event_id", "views"),
                        "user_id bigint, event_id bigint, views bigint", order=["time", "event_id"])


@query("SELECT event_type, count(*) * 2 AS cnt FROM events GROUP BY 1")
def union_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "events").select("event_type")
    return ops.count_by(ops.union_all(rows, rows), "event_type")


@query("""
SELECT upper(event_type) AS value FROM events
UNION ALL SELECT CAST(CAST(props->>'$.k' AS INTEGER) * 10 AS VARCHAR) FROM events
""")
def connect_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir)
    return ops.connect_map(
        rows.select("event_type"), rows.select("k"),
        [F.upper("event_type").alias("value")], [(F.col("k") * 10).cast("string").alias("value")])


@query(f"""
SELECT w AS word, count(*) AS n FROM (
  {_words('text', 'documents', ' ')} UNION ALL {_words('text', 'conversations', ',')}
) GROUP BY 1
""")
def coflatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = (inputs.table(spark, sf_dir, t).select(F.col("text").alias("value"))
                   for t in ("documents", "conversations"))
    return ops.word_count(ops.connect_flat_map(left, right, " ", ","))


# -- top-k, routing -------------------------------------------------------------------------------

TOP = f"""
WITH {APP}, counts AS (
  SELECT time - time % 60000 - o * 60000 AS w_start, event, category, product, count(*) AS cnt
  FROM app, (SELECT unnest(range(5)) AS o) WHERE event <> 'startup' GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY w_start, event, category ORDER BY cnt DESC, product) AS rank FROM counts
)
SELECT w_start, w_start + 300000 AS w_end, event, category, product, cnt, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE rank <= 3
"""


@query(TOP)
def topn_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_products(inputs.app_event_lines(inputs.events(spark, sf_dir)))


@query("""
SELECT CAST(CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS INTEGER) AS partition,
       count(*) AS cnt
FROM events GROUP BY 1
""")
def custom_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "events").select("event_type", "event_id")
    routed = ops.route(rows, "event_type", {"signup": 0, "purchase": 1}, 2, 3)
    return ops.count_by(routed.withColumn("partition", F.spark_partition_id()), "partition")


# -- sinks, written and read back -----------------------------------------------------------------

@query(f"""
WITH {APP}
SELECT 'os-user-cnt' AS hash, os || '_' || nu AS field, CAST(count(*) AS VARCHAR) AS value
FROM app WHERE event = 'startup' GROUP BY 2
""")
def hash_sink_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = sinks.BatchTable(shared_dir(spark, "hash"))
    write = sinks.hash_sink(store, "os-user-cnt", F.concat_ws("_", "os", "nu"), "cnt")
    write(plans.os_users(inputs.app_event_lines(inputs.events(spark, sf_dir))), 0)
    return sinks.read_hash(spark, store)


@query(f"""
WITH {SHOP}, daily AS (
  SELECT date, itemId, count(DISTINCT user_id) AS uv FROM shop WHERE event_type = 'view' GROUP BY 1, 2
)
SELECT DISTINCT date AS key, CAST(uv AS VARCHAR) AS member FROM daily
""")
def set_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = sinks.BatchTable(shared_dir(spark, "set"))
    daily = ops.exact_counts(_dated_views(spark, sf_dir), ["date", "itemId"], "user_id")
    sinks.set_sink(store, "date", "uv")(daily, 0)
    return sinks.read_set(spark, store)


@query(f"""
WITH {SHOP} SELECT date || itemId AS key, count(DISTINCT user_id) AS uv FROM shop
WHERE event_type = 'view' GROUP BY 1
""")
def sketch_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = sinks.BatchTable(shared_dir(spark, "sketch"))
    rows = _dated_views(spark, sf_dir).select(shopping.store_key().alias("key"), "user_id")
    sinks.sketch_sink(store, ["key"], "user_id")(rows, 0)
    return sinks.read_sketches(spark, store, ["key"])


@query("""
SELECT split_part(url, '/', 3) AS domain, CAST(sum(length(html)) AS DOUBLE) AS traffic FROM pages GROUP BY 1
""")
def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "csv")
    sinks.csv_sink(plans.domain_traffic(inputs.access_lines(spark, sf_dir)), path)
    return csv_view(spark, path, schemas.T.StructType(schemas.ACCESS.fields[1:]), "access_ods")


LATEST = """
SELECT user_id, event_id, time, value FROM (
  SELECT user_id, event_id, (epoch_us(ts) // 1000) AS time, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1
"""


@query(LATEST)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows an upsert stages: the last one of each key."""
    rows = inputs.events(spark, sf_dir).select("user_id", "event_id", "time", "value")
    return sinks.latest_per_key(rows, ["user_id"], ["time", "event_id"])


ETL = f"""
WITH {APP}
SELECT 'user_behavior_' || (event_id % 4) || '_' || event_id AS id, device, deviceType, os, event,
       'wifi' AS net, CAST(NULL AS VARCHAR) AS channel, CAST(user_id AS VARCHAR) AS uid, nu, ip, time,
       CAST(NULL AS VARCHAR) AS version, CAST(NULL AS VARCHAR) AS province, CAST(NULL AS VARCHAR) AS city,
       strftime(make_timestamp(time * 1000), '%Y%m%d') AS day, strftime(make_timestamp(time * 1000), '%H') AS hour,
       true AS taken_in_later
FROM app WHERE event = 'startup'
"""


def with_intake(rows: DataFrame) -> DataFrame:
    """The time of intake differs from run to run; that it lies after the event does not."""
    return rows.withColumn("taken_in_later", F.col("ingest_time") > F.col("time")).drop("ingest_time")


@query(ETL)
def etl_warehouse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.app_event_lines(inputs.events(spark, sf_dir))
    return with_intake(plans.etl_rows(kafka_records(inputs.kafka_rows(lines))))


@query("SELECT count(*) AS rows_passed FROM events WHERE event_type = 'view'")
def row_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted as they pass to a sink."""
    rows, seen = udfs.counted(inputs.events(spark, sf_dir).filter("event_type = 'view'"))
    materialize(rows, "counted")
    return spark.createDataFrame([(seen.get["rows_passed"],)], "rows_passed bigint")


@query("SELECT event_type, count(*) AS cnt, CAST(1 AS BIGINT) AS places FROM events GROUP BY 1")
def hash_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a key lie in one partition."""
    rows = ops.hash_exchange(inputs.table(spark, sf_dir, "events").select("event_type"), "event_type", partitions=7)
    placed = rows.withColumn("place", F.spark_partition_id()).groupBy("event_type", "place").agg(F.count(F.lit(1)).alias("n"))
    return placed.groupBy("event_type").agg(F.sum("n").alias("cnt"), F.count(F.lit(1)).alias("places"))


@query("SELECT count(*) AS cnt, CAST(5 AS BIGINT) AS tasks FROM events")
def set_parallelism(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.set_parallelism(inputs.table(spark, sf_dir, "events").select("event_id"), 5)
    placed = rows.groupBy(F.spark_partition_id().alias("place")).agg(F.count(F.lit(1)).alias("n"))
    return placed.agg(F.sum("n").alias("cnt"), F.count(F.lit(1)).alias("tasks"))


