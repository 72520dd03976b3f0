"""Windowed order-item join and the repair of what it misses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _windowed_side(df: DataFrame, key: str, size: str, ts: str, prefix: str) -> DataFrame:
    """Prefix the columns and attach the window. A stream join allows one event-time column per
    side, so the timestamp itself is dropped in favour of the window."""
    window = F.window(ts, size).alias("__w")
    columns = [F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != ts]
    return df.select(*columns, window)


def windowed_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    size: str = "5 seconds",
    ts: str = "ts",
    prefixes: tuple[str, str] = ("item_", "order_"),
    eligible: str | None = None,
) -> DataFrame:
    """Each left row with the right rows of the same key in the same tumbling window, or nulls.

    An equi-join on (key, window), usable on tables and on watermarked streams. Keys that are null
    match nothing, nor do left rows whose boolean column ``eligible`` is false. A hot left key is
    split by the adaptive skew join.
    """
    lhs = _windowed_side(left, key, size, ts, prefixes[0])
    rhs = _windowed_side(right, key, size, ts, prefixes[1]).withColumnRenamed("__w", "__rw")
    lhs = lhs.withColumn("__start", F.unix_millis("__w.start"))
    if left.isStreaming or right.isStreaming:
        # Streams expire state by the event time of the window; its last moment is a quarter of the struct in every key and row.
        lhs, rhs = lhs.withColumn("__w", F.window_time("__w")), rhs.withColumn("__rw", F.window_time("__rw"))
    else:
        lhs, rhs = lhs.withColumn("__w", F.col("__start")), rhs.withColumn("__rw", F.unix_millis("__rw.start"))
    same = (lhs[f"{prefixes[0]}{key}"] == rhs[f"{prefixes[1]}{key}"]) & (lhs["__w"] == rhs["__rw"])
    if eligible:
        same = same & lhs[f"{prefixes[0]}{eligible}"]
    joined = lhs.join(rhs, same, "left_outer")
    rest = [c for c in joined.columns if c not in ("__w", "__rw", "__start")]
    return joined.select(F.col("__start").alias("w_start"), *rest)


def _order_lists(orders: DataFrame, order_table: DataFrame, key: str, size: str, ts: str) -> DataFrame:
    """A row for each key with its orders of the stream, ``__seen``, and of the table, ``__kept``, each with its window."""
    columns = [c for c in orders.columns if c != ts]

    def records(rows: DataFrame, name: str) -> DataFrame:
        # A table row without a time is in no window and can be looked up all the same.
        window = F.window(F.coalesce(F.col(ts), F.lit(0).cast("timestamp")), size)
        rows = rows.filter(F.col(key).isNotNull()).withColumn("__w", window)
        start = F.when(F.col(ts).isNotNull(), F.unix_millis("__w.start")).alias("__w")
        return rows.select(F.col(key).alias("__key"), F.struct(start, *columns).alias(name))

    if orders is order_table:
        lists = records(orders, "__kept").groupBy("__key").agg(F.collect_list("__kept").alias("__kept"))
        return lists.withColumn("__seen", F.col("__kept"))
    both = records(orders, "__seen").unionByName(records(order_table, "__kept"), allowMissingColumns=True)
    return both.groupBy("__key").agg(*[F.collect_list(c).alias(c) for c in ("__seen", "__kept")])


def repair_late_items(
    items: DataFrame,
    orders: DataFrame,
    order_table: DataFrame,
    key: str,
    size: str = "5 seconds",
    ts: str = "ts",
    late: str = "is_late",
    prefixes: tuple[str, str] = ("item_", "order_"),
) -> DataFrame:
    """Windowed join in which late and unmatched items are looked up in the order table.

    ``items`` carry the boolean ``late``; a late item has missed its window. ``orders`` are the
    orders of the stream, ``order_table`` is the business table with one row per key and the same
    columns. ``source`` tells how an item was matched: ``window``, ``table`` or ``none``.

    On tables the orders of a key are gathered first, so items meet them once, by the key, for the window and the table.
    """
    item, order = prefixes
    order_columns = [c for c in orders.columns if c != ts]
    kept = [c for c in items.columns if c not in (ts, late)]
    on_time = items.withColumn("__on_time", ~F.col(late))
    if items.isStreaming or orders.isStreaming:
        joined = windowed_left_join(on_time, orders, key, size, ts, prefixes, "__on_time")
        found = F.col(f"{order}{key}").isNotNull()
        table = order_table.select(*[F.col(c).alias(f"__t_{c}") for c in order_table.columns if c != ts])
        joined = joined.join(table, ~found & (F.col(f"{item}{key}") == F.col(f"__t_{key}")), "left_outer")
        matched = F.col(f"__t_{key}").isNotNull()
        values = {c: F.when(found, F.col(f"{order}{c}")).otherwise(F.col(f"__t_{c}")) for c in order_columns}
    else:
        start = on_time.withColumn("__item_w", F.window(ts, size)).withColumn("__item_w", F.unix_millis("__item_w.start"))
        lists = _order_lists(orders, order_table, key, size, ts)
        met = start.drop(ts).join(lists, F.col(key) == F.col("__key"), "left_outer")
        here = F.filter("__seen", lambda o: F.col("__on_time") & (o["__w"] == F.col("__item_w")))
        met = met.withColumn("__here", here).withColumn("__found", F.coalesce(F.size("__here") > 0, F.lit(False)))
        found = F.col("__found")
        joined = met.select(*[F.col(c).alias(f"{item}{c}") for c in kept], "__found",
                            F.explode_outer(F.when(found, F.col("__here")).otherwise(F.col("__kept"))).alias("__o"))
        matched = F.col("__o").isNotNull()
        values = {c: F.col(f"__o.{c}") for c in order_columns}
    source = F.when(found, "window").when(matched, "table").otherwise("none")
    return joined.select(*[f"{item}{c}" for c in kept], *[v.alias(f"{order}{c}") for c, v in values.items()], source.alias("source"))
