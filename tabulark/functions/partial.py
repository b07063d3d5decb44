"""Aggregates of one's own with partial states, combined before rows are shuffled.

An aggregate is four small functions: zero, update (a state and a frame of rows), merge (two states) and finish. Each task folds its rows
into a state a key; only states are shuffled, so a key that holds all rows still uses every task. States of a key are merged in two
steps: first in as many lots as the square root of the tasks, then these: no task merges more than that many states of one key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from ..session import ship
from ..operators.versions import q

#: Keys whose states a task holds; beyond them it gives back what it has and starts anew.
KEYS = 50_000


@dataclass(frozen=True)
class Aggregate:
    """state: the fields of a state, as a schema; a state is a tuple of them. returns: the type of what finish gives. merge() must not
    care about order, and zero() must change nothing."""

    state: str
    returns: str
    zero: Callable[[], tuple]
    update: Callable[[tuple, pd.DataFrame], tuple]
    merge: Callable[[tuple, tuple], tuple]
    finish: Callable[[tuple], Any]


def aggregate(df: DataFrame, keys: list[str], columns: list[str], own: Aggregate, name: str = "result", held: int = KEYS) -> DataFrame:
    """One row a key: keys and what the aggregate gives for the columns of its rows. Null keys are a key; no keys: one row, also
    of no rows."""
    ship(df.sparkSession)
    slim = df.select(*[F.col(q(k)).alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(q(c)) for c in columns if c not in keys], *[F.col(q(c)) for c in columns if c in keys])
    fields = [f.name for f in _parse_datatype_string(own.state)]
    kinds = ", ".join(f"k{i} {df.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    names = [f"k{i}" for i in range(len(keys))]
    partial = f"{kinds}{', ' if keys else ''}lot int, {own.state}"

    def table(states: dict[tuple, tuple], lot: int) -> pd.DataFrame:
        return pd.DataFrame([(*key, lot, *state) for key, state in states.items()], columns=[*names, "lot", *fields])

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        states: dict[tuple, tuple] = {}
        for frame in frames:
            groups = frame.groupby(names, dropna=False, sort=False) if names else [((), frame)]
            for key, rows in groups:
                key = tuple(None if isinstance(k, float) and math.isnan(k) or k is pd.NaT or k is pd.NA else k for k in (key if isinstance(key, tuple) else (key,)))
                states[key] = own.update(states.get(key) or own.zero(), rows[columns])
            if len(states) > held:
                yield table(states, task)
                states = {}
        if states:
            yield table(states, task)

    def combine(last: bool) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
        def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            state = own.zero()
            for row in frame[fields].itertuples(index=False, name=None):
                state = own.merge(state, row)
            return pd.DataFrame([(*key[: len(names)], own.finish(state))], columns=[*names, name]) if last else table({key[: len(names)]: state}, 0)

        return run

    states = slim.mapInPandas(fold, partial)
    lots = max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    some = states.withColumn("lot", F.pmod(F.col("lot"), F.lit(lots))).groupBy(*names, "lot").applyInPandas(combine(False), partial)
    if names:
        out = some.groupBy(*names).applyInPandas(combine(True), f"{kinds}, `{name}` {own.returns}")
        return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], q(name))
    zero = df.sparkSession.createDataFrame([(0, *own.zero())], partial)  # a row there always is
    return some.unionByName(zero).groupBy(F.lit(0).alias("_all")).applyInPandas(lambda key, frame: combine(True)(key, frame), f"`{name}` {own.returns}")


def variance(column: str) -> Aggregate:
    """Sample variance in one pass: (count, mean, sum of squared differences), merged by Chan's formula. Nulls don't count."""

    def update(state: tuple, rows: pd.DataFrame) -> tuple:
        x = rows[column].dropna().astype("float64")
        return merge(state, (len(x), float(x.mean()), float(((x - x.mean()) ** 2).sum()))) if len(x) else state

    def merge(a: tuple, b: tuple) -> tuple:
        n = a[0] + b[0]
        if not n:
            return a
        gap = b[1] - a[1]
        return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n

    return Aggregate("n long, mean double, squares double", "double", lambda: (0, 0.0, 0.0), update, merge, lambda s: s[2] / (s[0] - 1) if s[0] > 1 else None)


def weighted_mean(value: str, weight: str) -> Aggregate:
    def update(state: tuple, rows: pd.DataFrame) -> tuple:
        both = rows[[value, weight]].dropna().astype("float64")
        return state[0] + float((both[value] * both[weight]).sum()), state[1] + float(both[weight].sum())

    return Aggregate("total double, weight double", "double", lambda: (0.0, 0.0), update, lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda s: s[0] / s[1] if s[1] else None)
