"""Line dedup by site-relative frequency.

Pages are grouped by host. The pages of a host that contain a line, divided by all pages of that host, give the line's
ratio; lines above the boilerplate ratio are dropped from every page of the host.

* A page is a distinct text of a host: exact copies of one page are one page, so a group of copies does not turn its
  own article into boilerplate.
* Lines are what lies between newlines and are compared whole. Blank lines are never dropped.
* A line needs ``min_pages`` pages. Two make a repeat, and from there on the ratio alone decides, whatever the number of
  a host's pages.
* Null hosts are one host of their own. A null text has no lines and stays null; an empty text stays empty.
* All input rows and columns are kept, repeated rows included; only the text changes. ``n_lines`` and ``n_dropped``
  are added (an input column of such a name is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.session import materialize

RATIO = 0.05
MIN_PAGES = 2


def _fingerprint(value: Column) -> Column:
    """128 bits of a string, as a pair of bigints."""
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(7), value).alias("b"))


def boilerplate(df: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, lines)``: per host the fingerprints of its boilerplate lines.

    The list is short: lines above the ratio are at most (mean lines of a page) / ratio for each host.
    """
    pages = df.filter(F.col(text).isNotNull()).select(
        F.col(host).alias("host"), _fingerprint(F.col(text)).alias("page"),
        F.array_distinct(F.split(F.col(text), "\n")).alias("lines"))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = (
        pages.select("host", "page", F.explode("lines").alias("line"))
        .filter(F.trim("line") != "")
        .select("host", "page", _fingerprint(F.col("line")).alias("line"))
        .distinct()
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("with_line"))
        .filter(F.col("with_line") >= min_pages)
    )
    return (
        counts.alias("c").join(totals.alias("t"), F.expr("c.host <=> t.host"))
        .filter(F.col("with_line") > F.lit(ratio) * F.col("pages"))
        .groupBy("c.host").agg(F.collect_list("line").alias("lines"))
    )


def drop_boilerplate(df: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """``df`` with the boilerplate lines taken out of ``text``, plus ``n_lines`` and ``n_dropped``."""
    # Written, so that its true size decides how the last join runs and its work is not repeated.
    found = materialize(boilerplate(df, text, host, ratio, min_pages), "boilerplate")
    drop = F.broadcast(found) if _small(found) else found
    columns = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    lines = F.split(F.col(f"d.{text}"), "\n")
    kept = F.filter(lines, lambda x: F.col("b.lines").isNull() | ~F.array_contains(F.col("b.lines"), _fingerprint(x)))
    return (
        df.alias("d").join(drop.alias("b"), F.expr(f"d.`{host}` <=> b.host"), "left")
        .withColumn("__lines", F.when(F.col(f"d.{text}").isNotNull(), lines))
        .withColumn("__kept", F.when(F.col(f"d.{text}").isNotNull(), kept))
        .select(
            *[F.array_join("__kept", "\n").alias(c) if c == text else F.col(f"d.`{c}`") for c in columns],
            F.coalesce(F.size("__lines"), F.lit(0)).cast("bigint").alias("n_lines"),
            F.coalesce(F.size("__lines") - F.size("__kept"), F.lit(0)).cast("bigint").alias("n_dropped"))
    )


def _small(found: DataFrame, lines: int = 200_000) -> bool:
    """Whether the fingerprints (24 bytes each) surely fit a broadcast; otherwise the join shuffles, same result."""
    return (found.agg(F.sum(F.size("lines") + 4).alias("n")).first()["n"] or 0) <= lines
