"""Joins of two streams within a time, and what comes too late for them: rows dropped are counted by the query itself."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from .windows import event_time


def within(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], start: str, time: str, width: str, waits: tuple[str, str], how: str = "inner") -> DataFrame:
    """Pairs with equal keys in which right's time is from left's `start` on, for at most `width` (both ends included). waits: how long
    each stream waits for stragglers. Both watermarks bound the state: a row is kept until none in time can pair with it. how: inner,
    leftOuter (left's rows without a pair, once they can have none) or leftSemi. Names of the two must differ."""
    a, b = event_time(left, start).withWatermark(start, waits[0]), event_time(right, time).withWatermark(time, waits[1])
    test = (F.col(time) >= F.col(start)) & (F.col(time) <= F.col(start) + F.expr(f"INTERVAL {width}"))
    for x, y in keys:
        test = test & (F.col(x) == F.col(y))
    return a.join(b, test, how)


@dataclass(frozen=True)
class Progress:
    """Sums over a query's batches: rows read, rows that were too late and dropped, and rows of state at the end."""

    batches: int
    rows: int
    dropped: int
    state: int


def progress(query: StreamingQuery) -> Progress:
    """From the progress of the query's last batches (spark.sql.streaming.numRecentProgressUpdates of them)."""
    seen = query.recentProgress
    operators = lambda p: p["stateOperators"] if isinstance(p, dict) else p.stateOperators
    number = lambda o, name: o[name] if isinstance(o, dict) else getattr(o, name)
    rows = sum(p["numInputRows"] if isinstance(p, dict) else p.numInputRows for p in seen)
    dropped = sum(number(o, "numRowsDroppedByWatermark") for p in seen for o in operators(p))
    state = sum(number(o, "numRowsTotal") for o in operators(seen[-1])) if seen else 0
    return Progress(len(seen), rows, dropped, state)
