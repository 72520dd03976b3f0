"""Late rows as a second output instead of a silent loss.

The watermark passes the end of a window with one row, the first in the order of arrival whose event time reaches it. So a
row is late when it arrived after that one, and only the places of those rows, one for each window, have to be known:

1. the first place in each class of rows that close the same windows, a hash aggregation (with two arrival columns a second
   one, over the rows at the first place in the first column),
2. a running minimum over windows, as what closes a window closes those before it,
3. a join of the rows with it by their window. Rows move only where the windows are too many to broadcast, and are not sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.operators.running import Running, running
from streamlytics.session import materialize

# Where a row stands that lacks an arrival number: last.
LAST_PLACE = (1 << 63) - 1


def _closings(df: DataFrame, places: Sequence[Column], last: Column, closes: Column) -> DataFrame:
    """``(__at, __first)``: for each window, told by its last millisecond, the place of the row that closes it, or null.

    Written to the shared folder, one row for each window.
    """
    rows = df.select(last.alias("__last"), closes.alias("__at"), *places)
    windows = materialize(rows.groupBy("__last", "__at").agg(F.min("__p0").alias("__p0")), "late_windows")
    first = windows.filter("__at IS NOT NULL").groupBy("__at").agg(F.min("__p0").alias("__p0"))
    if len(places) > 1:
        first = materialize(rows.join(first, ["__at", "__p0"]).groupBy("__at", "__p0").agg(F.min("__p1").alias("__p1")), "late_first")
    place = F.struct(*first.columns[1:])
    every = first.select("__at", place.alias("__place")).unionByName(
        windows.select(F.col("__last").alias("__at")).filter("__at IS NOT NULL"), allowMissingColumns=True)
    # Backwards in time.
    every = every.groupBy("__at").agg(F.min("__place").alias("__place")).withColumn("__back", -F.col("__at"))
    closed = running(every, [], ["__back"], [Running("__first", "min", "__place")])
    return materialize(closed.select("__at", "__first"), "late_closings")


def flag_late(
    df: DataFrame,
    arrival: Sequence[str],
    size_ms: int,
    delay_ms: int = 0,
    ms: str = "time",
    initial_max: int | None = None,
    name: str = "is_late",
) -> DataFrame:
    """Mark rows whose window had closed before they arrived.

    The watermark before a row is the largest event time that arrived earlier, less ``delay_ms``.
    A row is late when that has reached the last millisecond of its tumbling window. ``arrival``
    gives the order of arrival (one or two integral columns; rows of the same place arrive at once, those without one last);
    ``initial_max`` is the largest event time of an earlier run. The plan is built by reading ``df``, which must be repeatable.
    """
    if not 1 <= len(arrival) <= 2:
        raise ValueError("arrival takes one or two columns")
    places = [F.coalesce(F.col(c).cast("bigint"), F.lit(LAST_PLACE)).alias(f"__p{i}") for i, c in enumerate(arrival)]
    at = F.col(ms).cast("bigint")
    last = at - F.pmod(at, F.lit(size_ms)) + (size_ms - 1)
    reached = at - delay_ms
    closings = _closings(df, places, last, reached - F.pmod(reached + 1, F.lit(size_ms)))
    rows = df.withColumns({"__last": last, "__place": F.struct(*places)}).join(closings, F.col("__last") == F.col("__at"), "left")
    late = F.coalesce(F.col("__place") > F.col("__first"), F.lit(False))
    if initial_max is not None:
        late = late | F.coalesce(F.lit(initial_max) - delay_ms >= F.col("__last"), F.lit(False))
    return rows.withColumn(name, late).drop("__last", "__place", "__at", "__first")


def split_late(df: DataFrame, arrival: Sequence[str], size_ms: int, delay_ms: int = 0,
               ms: str = "time", initial_max: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows on time, late rows)``."""
    flagged = flag_late(df, arrival, size_ms, delay_ms, ms, initial_max)
    return flagged.filter(~F.col("is_late")).drop("is_late"), flagged.filter("is_late").drop("is_late")
