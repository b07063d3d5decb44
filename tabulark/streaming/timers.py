"""State with timers: sessions that a timer closes, and values that are forgotten.

State is kept for each key by RocksDB (set spark.sql.streaming.stateStore.providerClass; see STORE). What a key holds is bounded: open
sessions, or one value; a closed session leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ship
from .windows import event_time

#: The settings that these operators need.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Sessions(StatefulProcessor):
    """Open sessions of a key, as a list of (start, end, n) in microseconds; rows may come in any order within the watermark. A row joins
    the sessions that it is less than `gap` away from, and joins them to each other. A key has one timer, at the first end plus the gap;
    it closes all sessions that the watermark has passed so, which no row in time can join any more, and is set anew for the
    rest: calls go by keys of a batch, not by sessions."""

    def __init__(self, gap: int, kind: str):
        self.gap, self.kind = gap, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "first long, last long, n long")

    def _timer(self, last: int) -> int:
        """Milliseconds, rounded up: the watermark has them."""
        return -(-(last + self.gap) // 1000)

    def _set(self, before: list[tuple[int, int, int]], now: list[tuple[int, int, int]], fired: int | None = None) -> None:
        """A key has one timer, at the end of the first of its sessions to end. fired: one that is gone already."""
        old, new = (min((self._timer(s[1]) for s in spans), default=None) for spans in (before, now))
        if old == new and fired is None:
            return
        if old is not None and old != fired:
            self.handle.deleteTimer(old)
        if new is not None:
            self.handle.registerTimer(new)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        had = [tuple(map(int, s)) for s in self.open.get()]
        spans = list(had)
        for frame in rows:  # frames are bounded; what is kept of each is its sessions
            times = sorted(int(t) for t in frame["at"])
            for t in times:
                if spans and spans[-1][0] <= t and t - spans[-1][1] < self.gap:
                    spans[-1] = (spans[-1][0], max(t, spans[-1][1]), spans[-1][2] + 1)
                else:
                    spans.append((t, t, 1))
            spans = joined(spans, self.gap)
        self._set(had, spans)
        self.open.put(spans)
        yield from ()  # sessions come from timers alone

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        fired = expiredTimerInfo.getExpiryTimeInMs()
        due = max(fired, timerValues.getCurrentWatermarkInMs())
        spans = [tuple(map(int, s)) for s in self.open.get()]
        over = [s for s in spans if self._timer(s[1]) <= due]
        rest = [s for s in spans if self._timer(s[1]) > due]
        self._set(spans, rest, fired)
        if rest:
            self.open.put(rest)
        else:
            self.open.clear()
        if over:
            yield pd.DataFrame([(key[0], *s) for s in over], columns=["key", "first", "last", "n"]).astype({"key": object})

    def close(self) -> None:
        pass


def joined(spans: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """Sessions less than a gap apart become one."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(spans):
        if out and first - out[-1][1] < gap:
            out[-1] = (out[-1][0], max(last, out[-1][1]), out[-1][2] + n)
        else:
            out.append((first, last, n))
    return out


def sessions(stream: DataFrame, time: str, gap: str, key: str, late: str) -> DataFrame:
    """(key, start, end, n) of each session once it is over: `end` is the last event's time plus the gap, as session windows have
    it. Append mode. Rows without a key are a key of their own; rows without a time don't count."""
    ship(stream.sparkSession)
    width = stream.sparkSession.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {gap})").first()[0]
    kind = stream.schema[key].dataType.simpleString()
    rows = event_time(stream, time).where(F.col(time).isNotNull()).withWatermark(time, late).select(F.col(key).alias("key"), F.col(time), F.unix_micros(F.col(time)).alias("at"))
    found = rows.groupBy("key").transformWithStateInPandas(Sessions(width, kind), f"key {kind}, first long, last long, n long", "append", "EventTime")
    return found.select("key", F.timestamp_micros("first").alias("start"), F.timestamp_micros(F.col("last") + width).alias("end"), "n")


class Recent(StatefulProcessor):
    """The distinct values of a key within a time to live, as a map that forgets by itself; how many there are, after each batch."""

    def __init__(self, seconds: int, kind: str):
        self.seconds, self.kind = seconds, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "value string", "n long", ttlDurationMs=self.seconds * 1000)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for value, n in frame["value"].value_counts(dropna=True).items():
                old = self.seen.getValue((value,)) if self.seen.containsKey((value,)) else (0,)
                self.seen.updateValue((value,), (int(old[0]) + int(n),))
        counts = [int(v[0]) for v in self.seen.values()]
        yield pd.DataFrame({"key": [key[0]], "n_values": [len(counts)], "n": [sum(counts)]}).astype({"key": object})

    def close(self) -> None:
        pass


def recent_values(stream: DataFrame, key: str, value: str, seconds: int) -> DataFrame:
    """(key, n_values, n) after each batch: the different values of a key that came within so many seconds of processing time before, and
    how often. Update mode; state that is older is dropped by the store."""
    ship(stream.sparkSession)
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key).alias("key"), F.col(value).cast("string").alias("value"))
    return rows.groupBy("key").transformWithStateInPandas(Recent(seconds, kind), f"key {kind}, n_values long, n long", "update", "ProcessingTime")
