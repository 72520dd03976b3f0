"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges ``(hi, lo)`` with hi > lo; every result edge points to a smaller node.

    Large-star hangs a node's larger neighbours on the least of its neighbourhood, small-star its smaller ones. A hub
    is a key of a plain join, which Spark may split; no neighbour list is gathered.
    """
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    if large:
        both = both.union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    # Written, so that both sides of the join are plain exchanges and Spark can split the rows of a hub.
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "least")
    joined = both.alias("b").join(least.alias("l"), F.col("b.u") == F.col("l.u"))
    if large:
        moved = joined.filter(F.col("v") > F.col("b.u")).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        moved = joined.select(F.col("v").alias("hi"), F.col("m").alias("lo")).union(
            least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return moved.filter(F.col("hi") > F.col("lo")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with an edge; the component is its smallest node.

    Self-loops and repeated edges change nothing; edges with a null end are no edges; no edges give no rows. Each
    round is a written table, so a lost executor costs one round at most; the number of rounds grows with the
    logarithm of the longest path.
    """
    current = materialize(
        edges.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    state = None
    while True:
        current = materialize(_star(_star(current, True), False), "edges")
        # Equal sums over equal counts: the edge set is a fixed point when two rounds agree on all of them.
        now = tuple(current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")),
            F.bit_xor(F.xxhash64("lo", "hi"))).first())
        if now == state or now[0] == 0:
            break
        state = now
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
