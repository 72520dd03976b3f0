"""The feeds the jobs read, derived from the whole driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlytics.functions.text import split_parts
from streamlytics.session import shared_dir

MINUTE = 60_000
DAY = 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if not stream:
        return spark.read.parquet(path)
    schema = spark.read.parquet(path).schema
    # As a pattern the path may be a file or a folder of files; plain, a stream takes a folder only.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


class Feed:
    """A driver table as a stream that arrives in parts, ordered by time, and ends in a row far ahead.

    Each part is a set of files in the shared folder; a query is run to its end after each, from its checkpoint. The
    last row moves the watermark past all windows and stays in one that never closes.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, name: str, time: str, marks: dict, parts: int = 2,
                 arrival: Column | None = None):
        """``arrival``, a number, cuts the parts where rows do not arrive in the order of ``time``."""
        self.rows, self.time, self.marks, self.parts = table(spark, sf_dir, name), time, marks, parts
        self.folder = shared_dir(spark, "feeds", name)
        at = F.unix_micros(F.col(time).cast("timestamp")) if arrival is None else arrival
        low, high = self.rows.agg(F.min(at), F.max(at)).first()
        cuts = [low + (high - low) * i // parts for i in range(1, parts)] if low is not None else []
        self.part = sum([(at > c).cast("int") for c in cuts], F.lit(0))
        self.add(0)

    def add(self, i: int) -> None:
        """Deliver part ``i``; the one after the last is the row far ahead."""
        if i < self.parts:
            rows = self.rows.filter(self.part == i)
        else:
            ahead = self.rows.agg((F.max(self.time) + F.expr("INTERVAL 400 DAYS")).alias(self.time))
            rows = ahead.select(*[
                F.col(f.name) if f.name == self.time else F.lit(self.marks.get(f.name)).cast(f.dataType).alias(f.name)
                for f in self.rows.schema])
        rows.write.parquet(f"{self.folder}/{i}")

    def stream(self) -> DataFrame:
        session = self.rows.sparkSession
        return session.readStream.schema(self.rows.schema).option("recursiveFileLookup", "true").parquet(self.folder)


def event_feed(spark: SparkSession, sf_dir: str, parts: int = 2) -> Feed:
    marks = {"event_id": -1, "user_id": 0, "event_type": "view", "value": 0.0, "props": '{"k": 0}'}
    return Feed(spark, sf_dir, "events", "ts", marks, parts)


def millis(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def events(spark: SparkSession, sf_dir: str, feed: Feed | None = None) -> DataFrame:
    """Events with epoch time and the product number of their properties; a stream from a feed."""
    return (feed.stream() if feed else table(spark, sf_dir, "events")).select(
        "event_id", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"), millis("ts").alias("time"),
    )


def app_event_lines(rows: DataFrame) -> DataFrame:
    """``(event_id, value)`` with an app event as JSON."""
    record = F.struct(
        F.concat(F.lit("d"), "user_id").alias("device"),
        F.element_at(F.array(F.lit("phone"), F.lit("tablet"), F.lit("tv")), (F.col("user_id") % 3 + 1).cast("int"))
        .alias("deviceType"),
        F.when(F.col("user_id") % 2 == 0, "Android").otherwise("iOS").alias("os"),
        F.when(F.col("event_type") == "signup", "startup").otherwise(F.col("event_type")).alias("event"),
        F.lit("wifi").alias("net"),
        F.col("user_id").cast("string").alias("uid"),
        (F.col("k") % 2).alias("nu"),
        F.concat_ws(".", F.lit("10"), F.col("user_id") % 32, F.col("event_id") % 256, F.col("user_id") % 256)
        .alias("ip"),
        "time",
        F.struct(
            F.concat(F.lit("c"), F.col("k") % 10).alias("category"), F.concat(F.lit("p"), "k").alias("name")
        ).alias("product"),
    )
    return rows.select("event_id", F.to_json(record).alias("value"))


def shopping_lines(rows: DataFrame) -> DataFrame:
    """``value`` with a shopping behaviour record as JSON; views are page views."""
    record = F.struct(
        "user_id", F.col("k").cast("bigint").alias("itemId"), (F.col("k") % 10).cast("bigint").alias("categoryId"),
        F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type")).alias("behavior"),
        F.col("time").alias("ts"),
    )
    return rows.select(F.to_json(record).alias("value"))


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``time,domain,traffic`` lines from the page addresses, traffic being the size of the page."""
    host = F.element_at(split_parts(F.col("url"), "/"), 3)
    return table(spark, sf_dir, "pages").select(
        F.concat_ws(",", F.col("page_id") * 1000, host, F.length("html")).alias("value"))


def order_lines(spark: SparkSession, sf_dir: str, feed: Feed | None = None) -> DataFrame:
    return (feed.stream() if feed else table(spark, sf_dir, "orders")).select(
        F.concat_ws(",", "o_orderkey", millis("o_orderdate"), "o_totalprice").alias("value"))


def item_lines(spark: SparkSession, sf_dir: str, feed: Feed | None = None) -> DataFrame:
    return _items(spark, sf_dir, feed).select("value")


def arriving_items(spark: SparkSession, sf_dir: str, feed: Feed | None = None) -> DataFrame:
    """Item lines with their number and their order of arrival."""
    return _items(spark, sf_dir, feed).select("item_id", "arrival", "value")


def _items(spark: SparkSession, sf_dir: str, feed: Feed | None) -> DataFrame:
    line = F.concat_ws(",", "l_partkey", "l_orderkey", millis("l_shipdate"), F.concat(F.lit("s"), "l_suppkey"),
                       "l_quantity", "l_extendedprice")
    return (feed.stream() if feed else table(spark, sf_dir, "lineitem")).select(
        item_id().alias("item_id"), item_arrival().alias("arrival"), line.alias("value"))


def arrival(time: Column | None = None) -> Column:
    """Arrival time of an event: up to 99 minutes after it happened, out of order."""
    return (F.col("time") if time is None else time) + (F.col("event_id") * 37 % 100) * MINUTE


def item_id() -> Column:
    """A number of an order item's own."""
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def item_arrival() -> Column:
    """Arrival time of an order item: up to 99 days after it was shipped, out of order."""
    return millis("l_shipdate") + (item_id() * 37 % 100) * DAY


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One address range per nation with gaps between them, and another within each."""
    start = F.lit(10 << 24) + F.col("n_nationkey").cast("bigint") * (1 << 16)
    outer = F.struct(start.alias("start_ip"), (start + 239 * 256 + 255).alias("end_ip"),
                     F.concat(F.lit("city_"), "n_regionkey").alias("city"))
    inner = F.struct((start + 100 * 256).alias("start_ip"), (start + 120 * 256 + 255).alias("end_ip"), F.lit("inner").alias("city"))
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("province"), F.inline(F.array(outer, inner))).select("start_ip", "end_ip", "province", "city")


def kafka_rows(rows: DataFrame) -> DataFrame:
    """Rows as the Kafka source delivers them, from lines with an ``event_id``."""
    return rows.select(
        F.col("event_id").cast("string").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit("user_behavior").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


# -- the same feeds in SQL, for the oracles -------------------------------------------------------

APP = """
app AS (
  SELECT event_id, user_id, 'd' || user_id AS device,
         CASE user_id % 3 WHEN 0 THEN 'phone' WHEN 1 THEN 'tablet' ELSE 'tv' END AS deviceType,
         CASE WHEN user_id % 2 = 0 THEN 'Android' ELSE 'iOS' END AS os,
         CASE WHEN event_type = 'signup' THEN 'startup' ELSE event_type END AS event,
         CAST(k % 2 AS INTEGER) AS nu,
         '10.' || (user_id % 32) || '.' || (event_id % 256) || '.' || (user_id % 256) AS ip,
         (10 * 16777216) + (user_id % 32) * 65536 + (event_id % 256) * 256 + user_id % 256 AS ip_num,
         time, 'c' || (k % 10) AS category, 'p' || k AS product, k, value
  FROM (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k, (epoch_us(ts) // 1000) AS time FROM events)
)
"""
SHOP = """
shop AS (
  SELECT event_id, user_id, CAST(props->>'$.k' AS BIGINT) AS itemId, event_type, (epoch_us(ts) // 1000) AS time,
         strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS date
  FROM events
)
"""
DIM = """
dim AS (
  SELECT (10 * 16777216) + n_nationkey * 65536 + s * 256 AS start_ip,
         (10 * 16777216) + n_nationkey * 65536 + e * 256 + 255 AS end_ip,
         n_name AS province, CASE WHEN s = 100 THEN 'inner' ELSE 'city_' || n_regionkey END AS city
  FROM nation, (VALUES (0, 99), (100, 120), (121, 239)) AS part(s, e)
)
"""
