"""Stateful operators over keyed streams, and what arrives late.

State is kept for each key by Spark's state store; each has a batch form with the same results, which its tests use.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BinaryType, FractionalType

from .windows import event_time


def running_counts(stream: DataFrame, key: str, value: str) -> DataFrame:
    """After each batch: (key, n, total) of all rows of its keys so far. Update mode. A key's rows of a batch come in
    frames of bounded size; state is two numbers a key."""

    def add(key_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for frame in frames:
            n, total = n + len(frame), total + float(frame[value].fillna(0).sum())
        state.update((n, total))
        yield pd.DataFrame({"key": [key_[0]], "n": [n], "total": [total]})

    kind = stream.schema[key].dataType.simpleString()
    slim = stream.select(F.col(key), F.col(value).cast("double").alias(value))
    return slim.groupBy(key).applyInPandasWithState(add, f"key {kind}, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)


#: Keys have their state in so many parts at most, each called once a batch.
PARTS = 1024


def changes(stream: DataFrame, key: str, time: str, value: str, ties: list[str] | None = None, parts: int = PARTS) -> DataFrame:
    """Rows (key, time, value, before) whose value is distinct from their key's last one (null is a value): within a batch in order of
    time and ties, across batches in order of arrival. The first of a key counts. Append mode; state is a value a key, held for the keys
    of a part together (by hash; `parts` of them), so calls of a batch don't grow with keys; the rows of a part and batch are sorted in
    memory, which the stream's limits (maxFilesPerTrigger, say) and `parts` bound."""
    ties = ties or []
    kind = stream.schema[key].dataType
    # as text, so that integers beside nulls stay whole; the empty text is null
    named = F.base64(key) if isinstance(kind, BinaryType) else (F.col(key) + F.lit(0).cast(kind) if isinstance(kind, FractionalType) else F.col(key)).cast("string")
    named = F.coalesce(F.concat(F.lit("="), named), F.lit(""))

    def compare(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = dict(zip(*state.get, strict=True)) if state.exists else {}
        rows = pd.concat(list(frames)).sort_values(["_key", "_time", *[f"_tie{i}" for i in range(len(ties))]], kind="stable")
        kept, before = [], []
        for i, (name, text) in enumerate(zip(rows["_key"], rows["_value"], strict=True)):
            text = None if pd.isna(text) else text
            if name not in seen or seen[name] != text:
                kept.append(i)
                before.append(seen.get(name))
            seen[name] = text
        state.update((list(seen), list(seen.values())))
        out = rows.iloc[kept]
        yield pd.DataFrame({"key": out["_key"], "time": out["_time"], "value": out["_value"], "before": pd.Series(before, out.index, object)})

    slim = stream.select(F.pmod(F.xxhash64(named), F.lit(parts)).alias("_part"), named.alias("_key"), F.col(time).alias("_time"), *[F.col(t).alias(f"_tie{i}") for i, t in enumerate(ties)], F.col(value).cast("string").alias("_value"))
    found = slim.groupBy("_part").applyInPandasWithState(compare, f"key string, time {stream.schema[time].dataType.simpleString()}, value string, before string", "names array<string>, lasts array<string>", "append", GroupStateTimeout.NoTimeout)
    bare = F.when(F.col("key") != "", F.substr("key", F.lit(2)))
    return found.withColumn("key", F.unbase64(bare) if isinstance(kind, BinaryType) else bare.cast(kind))


def batch_changes(df: DataFrame, key: str, time: str, value: str, ties: list[str] | None = None) -> DataFrame:
    """The batch form of changes()."""
    over = Window.partitionBy(key).orderBy(time, *(ties or []))
    rows = df.withColumn("_value", F.col(value).cast("string")).withColumn("before", F.lag("_value").over(over)).withColumn("_first", F.row_number().over(over) == 1)
    return rows.where(F.col("_first") | ~F.col("_value").eqNullSafe(F.col("before"))).select(F.col(key).alias("key"), F.col(time).alias("time"), F.col("_value").alias("value"), "before")


def split_late(df: DataFrame, time: str, arrived: str, wait: str) -> tuple[DataFrame, DataFrame]:
    """Rows in time and rows too late, in a log that knows when each arrived: late is what comes more than `wait` behind
    the greatest event time that arrived before it. Times are taken by the minute of arrival, as a stream's batches would."""
    rows = event_time(df, time).withColumn("_batch", F.date_trunc("minute", F.col(arrived)))
    tops = rows.groupBy("_batch").agg(F.max(time).alias("_top"))
    # one row a minute: the running maximum sees no more
    seen = tops.withColumn("_mark", F.max("_top").over(Window.orderBy("_batch").rowsBetween(Window.unboundedPreceding, -1))).select("_batch", "_mark")
    marked = rows.join(seen, "_batch")
    late: Column = F.coalesce(F.col(time) < F.col("_mark") - F.expr(f"INTERVAL {wait}"), F.lit(False))
    return marked.where(~late).drop("_batch", "_mark"), marked.where(late).drop("_batch", "_mark")
