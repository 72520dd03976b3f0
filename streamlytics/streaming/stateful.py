"""Keyed state with ``transformWithState`` (needs the RocksDB state store)."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

DAY_MS = 86_400_000


def in_order(rows: Iterator, order: Sequence[str]) -> Iterator:
    """A key's rows of a micro-batch in order of arrival; the shuffle keeps none. They are held by one task."""
    return iter(sorted(rows, key=lambda row: tuple(row[c] for c in order))) if order else rows


class AverageEvery(StatefulProcessor):
    """Running (count, sum) per key; emits the mean and starts over at every ``n``-th value."""

    def __init__(self, key: str, value: str, n: int, order: Sequence[str] = ()):
        self.key, self.value, self.n, self.order = key, value, n, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("avg", "count BIGINT, total DOUBLE")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        count, total = self.state.get() if self.state.exists() else (0, 0.0)
        for row in in_order(rows, self.order):
            count, total = count + 1, total + row[self.value]
            if count == self.n:
                yield Row(**{self.key: key[0], "avg": total / count})
                count, total = 0, 0.0
        if count:
            self.state.update((count, total))
        else:
            self.state.clear()

    def close(self) -> None:
        pass


class CollectEvery(AverageEvery):
    """The same result while keeping each value, numbered, until ``n`` are there."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("values", "position INT", "value DOUBLE")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [value[0] for _, value in sorted(self.state.iterator())] if self.state.exists() else []
        for row in in_order(rows, self.order):
            held.append(float(row[self.value]))
            self.state.updateValue((len(held),), (held[-1],))
            if len(held) == self.n:
                yield Row(**{self.key: key[0], "avg": sum(held) / self.n})
                self.state.clear()
                held = []

    def close(self) -> None:
        pass


def average_every_stream(df: DataFrame, key: str, value: str, n: int = 3, keep_values: bool = False,
                         order: Sequence[str] = ()) -> DataFrame:
    """Mean of every ``n`` consecutive values per key, micro-batch by micro-batch and within one by the ``order``
    columns; without them the order within a micro-batch is not defined."""
    schema = StructType([StructField(key, df.schema[key].dataType), StructField("avg", DoubleType())])
    processor = (CollectEvery if keep_values else AverageEvery)(key, value, n, order)
    return df.select(key, value, *[c for c in order if c not in (key, value)]).groupBy(key).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="None")


class FirstSeen(StatefulProcessor):
    """One flag per identity: set ``column`` on its first row, pass every row on."""

    def __init__(self, column: str, ttl_ms: int | None, order: Sequence[str] = ()):
        self.column, self.ttl_ms, self.order = column, ttl_ms, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen BOOLEAN", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = not self.seen.exists()
        for row in in_order(rows, self.order if new else ()):
            values = row.asDict()
            if new:
                values[self.column] = 1
                new = False
                self.seen.update((True,))
            yield Row(**values)

    def close(self) -> None:
        pass


def first_seen_stream(df: DataFrame, identity: Sequence[str], column: str = "nu",
                      ttl_ms: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Set ``column`` to 1 on the first row of each identity, exactly: that of the earliest micro-batch, and within it
    the first by the ``order`` columns (any, without them).

    State is keyed by the whole identity (device type *and* device): one entry each, spread over
    all tasks, where a filter per device type would put a popular type into one. ``ttl_ms``
    forgets an identity that long after it was first seen (see :func:`expiring_totals` on triggers).
    """
    if column not in df.columns:
        df = df.withColumn(column, F.lit(0))
    df = df.withColumn(column, F.col(column).cast(IntegerType()))
    return df.groupBy(*identity).transformWithState(
        statefulProcessor=FirstSeen(column, ttl_ms, order), outputStructType=df.schema, outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None")


class ExpiringTotal(StatefulProcessor):
    """Total per key whose state expires ``ttl_ms`` after the last write and is not read again."""

    def __init__(self, key: str, value: str, ttl_ms: int):
        self.key, self.value, self.ttl_ms = key, value, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total DOUBLE", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        total = self.total.get()[0] if self.total.exists() else 0.0
        for row in rows:
            total += row[self.value]
        self.total.update((total,))
        yield Row(**{self.key: key[0], "total": total})

    def close(self) -> None:
        pass


def expiring_totals(df: DataFrame, key: str, value: str, ttl_ms: int = DAY_MS) -> DataFrame:
    """Running total per key and micro-batch with state that expires (a day by default).

    Expiry is checked in batches without data too, so run it with a processing-time trigger: an
    available-now query would not end.
    """
    schema = StructType([StructField(key, df.schema[key].dataType), StructField("total", DoubleType())])
    return df.select(key, F.col(value).cast("double").alias(value)).groupBy(key).transformWithState(
        statefulProcessor=ExpiringTotal(key, value, ttl_ms), outputStructType=schema, outputMode="Update",
        timeMode="ProcessingTime")


class TopOnTimer(StatefulProcessor):
    """The ``n`` best rows of each group of a bucket in keyed state, one value of columns, given out by an event-time timer.

    The timer stands behind the first window's end that is held; it gives out all groups whose end the watermark has passed
    and moves on to the next end.
    """

    def __init__(self, groups: Sequence[str], end: str, by: str, tie: str, n: int, state: str):
        self.groups, self.by, self.tie, self.n, self.state = list(groups), by, tie, n, state
        self.end = self.groups.index(end)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.state)

    def held(self) -> dict[tuple, list]:
        best = {}
        for *group, tie, by in zip(*(self.best.get() or ()), strict=True):
            best.setdefault(tuple(group), []).append((tie, by))
        return best

    def hold(self, best: dict[tuple, list]) -> None:
        self.best.update(tuple(map(list, zip(*((*group, *item) for group, items in best.items() for item in items), strict=True))))

    def first_end(self, best: dict[tuple, list]) -> int | None:
        return min((group[self.end] for group in best), default=None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = self.held()
        timer = self.first_end(best)
        for row in rows:
            group = tuple(row[g] for g in self.groups)
            items = best.setdefault(group, [])
            items.append((row[self.tie], row[self.by]))
            if len(items) > 64 * self.n:
                best[group] = self.ranked(items)
        self.hold({group: self.ranked(items) for group, items in best.items()})
        first = self.first_end(best)
        if timer is None or first < timer:
            self.handle.registerTimer(first + 1)
        return iter(())

    def ranked(self, items: list[tuple]) -> list[tuple]:
        return sorted(items, key=lambda item: (-item[1], item[0] is not None, item[0] or ""))[: self.n]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        left = {}
        for group, items in self.held().items():
            if group[self.end] + 1 > now:
                left[group] = items
                continue
            for rank, (tie, by) in enumerate(items, start=1):
                yield Row(**dict(zip(self.groups, group)), **{self.tie: tie, self.by: by, "rank": rank})
        if left:
            self.hold(left)
            self.handle.registerTimer(self.first_end(left) + 1)
        else:
            self.best.clear()

    def close(self) -> None:
        pass


def top_n_on_timer(counts: DataFrame, groups: Sequence[str], by: str, tie: str, n: int = 3,
                   end: str = "w_end", window: str = "w", buckets: int = 256) -> DataFrame:
    """Top rows per group of a windowed count stream, released one millisecond after the window's end.

    ``groups`` contains ``end``, the window's end in epoch milliseconds; ``window`` is the window
    column itself, by which the watermark travels. Groups are dealt into ``buckets`` states by their hash, as a call and a
    timer for each group cost far more than its rows. A task holds ``n`` rows of each group of a bucket at once; more groups
    than memory allows take more buckets. A group's counts pass through one task: for groups with very many products rank
    per micro-batch (``top_n_stream``).
    """
    fields = {f.name: f.dataType for f in counts.schema}
    schema = StructType([
        *[StructField(g, fields[g]) for g in groups], StructField(tie, fields[tie]), StructField(by, fields[by]),
        StructField("rank", IntegerType()),
    ])
    state = ", ".join(f"`{c}` ARRAY<{fields[c].simpleString()}>" for c in (*groups, tie, by))
    bucket = F.pmod(F.xxhash64(*groups), F.lit(buckets)).cast("int").alias("__bucket")
    return counts.select(*groups, tie, by, window, bucket).groupBy("__bucket").transformWithState(
        statefulProcessor=TopOnTimer(groups, end, by, tie, n, state), outputStructType=schema,
        outputMode="Append", timeMode="EventTime")


class FireSteps(StatefulProcessor):
    """Views and distinct users of a key's window so far, given out at the end of each step of event time that saw any.

    State holds what the steps still to be fired add, the totals, and the step that first saw each user. A micro-batch gathers
    its rows and then looks users up by the bucket, not one by one; a key's buckets are split in two as its users grow. A
    timer stands at the end of the first step to be fired; it gives out all that the watermark has passed and moves on to the
    next, and one at the end of the window drops the state.
    """

    CACHED = 50_000  # users gathered in a micro-batch before they are looked up
    BUCKET = 1024  # users of a bucket, on average at most

    def __init__(self, keys: Sequence[str], user: str, ms: str, step_ms: int, user_type: str):
        self.keys, self.user, self.ms, self.step_ms, self.user_type = list(keys), user, ms, step_ms, user_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState(
            "open", "fires ARRAY<BIGINT>, views ARRAY<BIGINT>, news ARRAY<BIGINT>, pv BIGINT, uv BIGINT, users BIGINT, buckets INT")
        self.users = handle.getMapState("users", "bucket INT", f"users ARRAY<{self.user_type}>, fires ARRAY<BIGINT>")

    def held(self) -> tuple[dict, list] | None:
        """``({fire: [views, new users]}, [pv, uv, users, buckets])``"""
        if not (state := self.open.get()):
            return None
        fires, views, news, *rest = state
        return {fire: [v, n] for fire, v, n in zip(fires, views, news, strict=True)}, rest

    def hold(self, steps: dict, rest: list) -> None:
        self.open.update(([*steps], [s[0] for s in steps.values()], [s[1] for s in steps.values()], *rest))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.held()
        steps, rest = before or ({}, [0, 0, 0, 0])
        timer, first = min(steps, default=None), {}
        for row in rows:
            fire = row[self.ms] // self.step_ms * self.step_ms + self.step_ms
            steps.setdefault(fire, [0, 0])[0] += 1
            user = row[self.user]
            if user is None:
                continue
            if fire < first.get(user, fire + 1):
                first[user] = fire
            if len(first) >= self.CACHED:
                self.meet(first, steps, rest)
        self.meet(first, steps, rest)
        self.hold(steps, rest)
        if timer is None or min(steps) < timer:
            self.handle.registerTimer(min(steps))
        if before is None:
            self.handle.registerTimer(key[-1])
        return iter(())

    def meet(self, first: dict, steps: dict, rest: list) -> None:
        """Add users with the first step that saw each, and move those who were known from a later one."""
        by_bucket = {}
        rest[3] = rest[3] or 1
        for user, fire in first.items():
            by_bucket.setdefault(self.place(user) % rest[3], []).append((user, fire))
        for bucket, here in by_bucket.items():
            known = self.bucket(bucket) if rest[2] else {}
            n = len(known)
            changed = False
            for user, fire in here:
                before = known.get(user)
                if before is None or fire < before:
                    if before in steps:  # not fired yet
                        steps[before][1] -= 1
                    steps[fire][1] += 1
                    known[user], changed = fire, True
            if changed:
                self.keep(bucket, known)
            by_bucket[bucket] = len(known) - n
        rest[2] += sum(by_bucket.values())
        first.clear()
        while rest[2] > self.BUCKET * rest[3]:
            n = rest[3]
            for bucket in range(n):
                parts = {}, {}
                for user, fire in self.bucket(bucket).items():
                    parts[self.place(user) % (2 * n) != bucket][user] = fire
                for i, part in enumerate(parts):
                    self.keep(bucket + i * n, part)
            rest[3] = 2 * n

    @staticmethod
    def place(user) -> int:
        return zlib.crc32(repr(user).encode("utf-8", "surrogatepass"))

    def bucket(self, number: int) -> dict:
        held = self.users.getValue((number,))
        return dict(zip(*held, strict=True)) if held else {}

    def keep(self, number: int, known: dict) -> None:
        self.users.updateValue((number,), ([*known], [*known.values()]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        if not (held := self.held()):
            return
        steps, rest = held
        due = sorted(fire for fire in steps if fire <= now)
        for fire in due:
            views, users = steps.pop(fire)
            rest[0], rest[1] = rest[0] + views, rest[1] + users
            yield Row(**dict(zip(self.keys, key)), fire_time=fire, pv=rest[0], uv=rest[1])
        if now >= key[-1]:
            self.open.clear()
            self.users.clear()
        elif due:
            self.hold(steps, rest)
            if steps:
                self.handle.registerTimer(min(steps))

    def close(self) -> None:
        pass


def fire_in_event_time(df: DataFrame, keys: Sequence[str], user: str, step_ms: int = 180_000, size_ms: int = DAY_MS,
                       offset_ms: int = 0, ms: str = "ts", event_time: str = "event_time") -> DataFrame:
    """``(keys, w_end, fire_time, pv, uv)``: views and exact visitors of each window so far, every ``step_ms`` of event time
    until the window ends, as the watermark passes; one row per step in which the key saw anything.

    ``df`` is watermarked on ``event_time``; windows are of ``size_ms`` and begin ``offset_ms`` after a multiple of it. A
    key's users are in the state store, not in memory.
    """
    fields = {f.name: f.dataType for f in df.schema}
    at: Column = F.col(ms).cast("bigint")
    end = F.floor((at - offset_ms) / size_ms).cast("bigint") * size_ms + (offset_ms + size_ms)
    schema = StructType([*[StructField(k, fields[k]) for k in keys], StructField("w_end", LongType()),
                         *[StructField(c, LongType()) for c in ("fire_time", "pv", "uv")]])
    rows = df.select(*keys, end.alias("w_end"), F.col(user).alias(user), at.alias("__ms"), event_time)
    return rows.groupBy(*keys, "w_end").transformWithState(
        statefulProcessor=FireSteps([*keys, "w_end"], user, "__ms", step_ms, fields[user].simpleString()),
        outputStructType=schema, outputMode="Append", timeMode="EventTime")


class Lives(StatefulProcessor):
    """Totals per key that expire ``ttl_ms`` after their last write, in event time, and are given out then.

    The timer of a total moves with each write. A total that has expired is never seen again: a later row begins a new one.
    Rows may come in any order within what the watermark allows; a row between two totals may join them.
    """

    def __init__(self, key: str, value: str, ms: str, ttl_ms: int):
        self.key, self.value, self.ms, self.ttl_ms = key, value, ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lives = handle.getMapState("lives", "born BIGINT", "last BIGINT, n BIGINT, total BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = {k[0]: tuple(v) for k, v in self.lives.iterator()} if self.lives.exists() else {}
        lives = sorted([born, *rest] for born, rest in before.items())  # born, last, n, total: they do not overlap
        for row in rows:
            at, value = row[self.ms], row[self.value] or 0
            i = bisect.bisect_right(lives, at, key=lambda life: life[0])  # the first that is born after the row
            if i and at - lives[i - 1][1] < self.ttl_ms:
                life = lives[i - 1]
                life[1], life[2], life[3] = max(life[1], at), life[2] + 1, life[3] + value
            else:
                life = [at, at, 1, value]
                lives.insert(i, life)
                i += 1
            if i < len(lives) and lives[i][0] - life[1] < self.ttl_ms:
                other = lives.pop(i)
                life[1:] = [max(life[1], other[1]), life[2] + other[2], life[3] + other[3]]
        after = {born: tuple(rest) for born, *rest in lives}
        for born, (last, _, _) in before.items():
            if after.get(born, (None,))[0] != last:
                self.handle.deleteTimer(last + self.ttl_ms)
                if born not in after:
                    self.lives.removeKey((born,))
        for born, rest in after.items():
            if before.get(born) != rest:
                self.lives.updateValue((born,), rest)
            if before.get(born, (None,))[0] != rest[0]:
                self.handle.registerTimer(rest[0] + self.ttl_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        for (born,), (last, n, total) in sorted((tuple(k), tuple(v)) for k, v in self.lives.iterator()):
            if last + self.ttl_ms <= now:
                self.lives.removeKey((born,))
                yield Row(**{self.key: key[0], "born": born, "last": last, "n": n, "total": total})

    def close(self) -> None:
        pass


def lives_in_event_time(df: DataFrame, key: str, value: str, ttl_ms: int = DAY_MS, ms: str = "time",
                        event_time: str = "ts") -> DataFrame:
    """``(key, born, last, n, total)``: a running total per key whose state expires ``ttl_ms`` after its last write, as event
    time goes; the total of each such life is given out when it expires. ``df`` is watermarked on ``event_time``."""
    schema = StructType([StructField(key, df.schema[key].dataType), *[
        StructField(c, LongType()) for c in ("born", "last", "n", "total")]])
    rows = df.select(key, F.col(value).cast("bigint").alias("__value"), F.col(ms).cast("bigint").alias("__ms"), event_time)
    return rows.groupBy(key).transformWithState(
        statefulProcessor=Lives(key, "__value", "__ms", ttl_ms), outputStructType=schema, outputMode="Append",
        timeMode="EventTime")
