"""IP address to province and city, as a join with a table of address ranges."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.functions.ip import ip_to_long
from streamlytics.operators.running import Running, running
from streamlytics.session import materialize

UNKNOWN = "-"
PREFIX = 1 << 16
PLACES = ("province", "city")


def _flat(piece: pd.DataFrame) -> pd.DataFrame:
    """Disjoint segments of the ranges within one /16: at each address the range with the largest start rules, the
    shortest of those, and the first place by name of those.

    Ranges are numbered by that rule, and each address takes the least number of those that cover it: a range is two
    stretches of a power of two, whose numbers are handed down level by level.
    """
    rows = piece.assign(**{p: piece[p].map(str) for p in PLACES}).assign(at=np.arange(len(piece))).sort_values(
        ["whole_start", "whole_end", *PLACES], ascending=[False, True, True, True])
    start, end = ((rows[c] - rows["prefix"] * PREFIX).to_numpy() for c in ("start_ip", "end_ip"))
    number, top = np.arange(len(rows), dtype=np.int32), np.frexp(end - start + 1)[1] - 1
    none = len(rows)
    least = np.full((PREFIX.bit_length(), PREFIX), none, np.int32)
    np.minimum.at(least, (top, start), number)
    np.minimum.at(least, (top, end - (1 << top) + 1), number)
    for level in range(len(least) - 1, 0, -1):
        half, wide = 1 << (level - 1), least[level, : PREFIX - (1 << level) + 1]
        for shift in (0, half):
            below = least[level - 1, shift:shift + len(wide)]
            np.minimum(below, wide, out=below)
    ruler = least[0]
    first = np.flatnonzero(np.concatenate(([True], ruler[1:] != ruler[:-1])))
    last = np.append(first[1:], PREFIX) - 1
    kept = ruler[first] < none
    first, last = first[kept], last[kept]
    of = piece.iloc[rows["at"].to_numpy()[ruler[first]]]
    base = of["prefix"].to_numpy() * PREFIX
    return pd.DataFrame({"prefix": of["prefix"].to_numpy(), "start_ip": base + first, "end_ip": base + last,
                         **{p: of[p].to_numpy() for p in PLACES}})


def flat_ranges(ranges: DataFrame) -> DataFrame:
    """``(prefix, start_ip, end_ip, province, city)``: the ranges cut at /16 borders and made disjoint.

    Where ranges overlap, the one with the largest start that covers an address rules, then the shortest. A /16 has
    65,536 addresses, which bounds its segments; equal ranges are one.
    """
    first, last = F.floor(F.col("start_ip") / PREFIX), F.floor(F.col("end_ip") / PREFIX)
    pieces = ranges.filter("start_ip <= end_ip").select("start_ip", "end_ip", *PLACES).distinct().select(
        F.explode(F.sequence(first, last)).alias("prefix"), F.col("start_ip").alias("whole_start"),
        F.col("end_ip").alias("whole_end"), *PLACES)
    pieces = pieces.select(
        "*", F.greatest("whole_start", F.col("prefix") * PREFIX).alias("start_ip"),
        F.least("whole_end", F.col("prefix") * PREFIX + (PREFIX - 1)).alias("end_ip"))
    return pieces.groupBy("prefix").applyInPandas(
        _flat, "prefix bigint, start_ip bigint, end_ip bigint, province string, city string")


def prefix_table(ranges: DataFrame) -> DataFrame:
    """``(prefix, segments)``: one row per /16, its disjoint segments sorted by start."""
    spot = F.struct("start_ip", "end_ip", *PLACES)
    return flat_ranges(ranges).groupBy("prefix").agg(F.array_sort(F.collect_list(spot)).alias("segments"))


def segment_at(segments: Column, ip: Column) -> Column:
    """The segment that holds an address, by binary search; null if none does."""
    steps = F.array(*[F.lit(1 << k) for k in range(16, -1, -1)])
    started = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (n + step <= F.size(segments)) & (F.get(segments, n + step - 1)["start_ip"] <= ip), n + step).otherwise(n))
    found = F.get(segments, started - 1)
    return F.when(found["end_ip"] >= ip, found)


def _by_prefix(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """An equality join on the /16 and a binary search in its segments; Spark picks how to join by the table's size."""
    table = prefix_table(ranges)
    if not ranges.isStreaming:
        table = materialize(table, "ip_prefixes")
    keyed = df.withColumn("__prefix", F.floor(F.col("__ip") / PREFIX))
    joined = keyed.join(table, keyed["__prefix"] == table["prefix"], "left")
    return joined.withColumn("__at", segment_at(F.col("segments"), F.col("__ip"))).drop("__prefix", "prefix", "segments")


def _by_merge(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Distinct addresses and segment starts form one ordered axis, on which each address takes the last segment that
    started at or before it. Addresses that are none stay out of the join."""
    spot = F.struct("start_ip", "end_ip", *PLACES)
    starts = flat_ranges(ranges).select(F.col("start_ip").alias("__ip"), F.lit(0).alias("__side"), spot.alias("__range"))
    wanted = df.select("__ip").filter("__ip is not null").distinct().withColumn("__side", F.lit(1))
    # Three passes follow over this table of distinct addresses; the input is read once for it.
    axis = materialize(wanted.unionByName(starts, allowMissingColumns=True), "ip_axis")
    found = running(axis, [], ["__ip", "__side"], [Running("__at", "max", "__range")]).filter("__side = 1")
    places = found.filter(F.col("__ip") <= F.col("__at.end_ip")).select("__ip", "__at")
    known = df.filter("__ip is not null").join(places, "__ip", "left")
    return known.unionByName(df.filter("__ip is null"), allowMissingColumns=True)


def enrich_ip(
    df: DataFrame,
    ranges: DataFrame,
    ip: str = "ip",
    province: str = "province",
    city: str = "city",
    way: str = "prefix",
) -> DataFrame:
    """Set ``province`` and ``city`` from ``ranges(start_ip, end_ip, province, city)``; ``-`` on a miss.

    One row out per row in, whatever ranges overlap (see :func:`flat_ranges`). ``way`` chooses the plan, not the
    answer: ``prefix`` joins on the /16 and also serves streams, ``merge`` sorts addresses and ranges into one axis.
    """
    if way not in ("prefix", "merge"):
        raise ValueError(f"unknown way {way}")
    dim = ranges.select("start_ip", "end_ip", *PLACES)
    joined = (_by_prefix if way == "prefix" else _by_merge)(df.withColumn("__ip", ip_to_long(ip)), dim)
    return joined.withColumns({
        province: F.coalesce("__at.province", F.lit(UNKNOWN)), city: F.coalesce("__at.city", F.lit(UNKNOWN)),
    }).drop("__ip", "__at")
