"""Row numbers, tiles and running totals over a whole table, without a window that one task would hold.

Rows are dealt to ranges of the order and sorted there; each range's count (or sum) is a row of a small table, whose
running total is what a range starts from. The sorted table is kept (session.cut), so a range's content is one
and the same for both steps.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: monotonically_increasing_id() has the partition above, and the row's place in it in the lower 33 bits.
PLACE = (1 << 33) - 1


def _sorted(df: DataFrame, order: list[Column], ranges: int | None) -> DataFrame:
    """df in ranges of order, with _range and _place (0, 1, .. within it)."""
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    dealt = dealt.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    return cut(dealt).select("*", F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND(PLACE).alias("_place")).drop("_id")


def _before(sums: DataFrame, name: str) -> DataFrame:
    """sums (_range, name, one row a range) with the total of the ranges before."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as there are partitions
    return sums.select("_range", F.sum(name).over(earlier).alias("_before"))


def number_rows(df: DataFrame, order: list[Column], name: str = "n", ranges: int | None = None) -> DataFrame:
    """df with 1, 2, .. in order, as row_number() over everything gives. Of rows with equal order any comes first."""
    rows = _sorted(df, order, ranges)
    before = _before(rows.groupBy("_range").agg(F.count("*").alias("_n")), "_n")
    found = rows.join(F.broadcast(before), "_range")  # a row a partition
    return found.withColumn(name, F.coalesce("_before", F.lit(0)) + F.col("_place") + 1).drop("_range", "_place", "_before")


def ntile(df: DataFrame, tiles: int, order: list[Column], name: str = "tile", ranges: int | None = None) -> DataFrame:
    """df with its tile 1 to tiles, as ntile() over everything gives: the first ones have a row more if it doesn't divide."""
    if tiles < 1:
        raise ValueError("tiles must be at least 1")
    numbered = number_rows(df, order, "_n", ranges)
    total = df.agg(F.count("*").alias("_total"))
    q, r = F.floor(F.col("_total") / tiles), F.col("_total") % tiles
    at = F.col("_n") - 1
    tile = F.when(at < r * (q + 1), F.floor(at / (q + 1))).otherwise(r + F.floor((at - r * (q + 1)) / F.nullif(q, F.lit(0)))) + 1
    return numbered.join(F.broadcast(total)).withColumn(name, tile.cast("long")).drop("_n", "_total")  # one row


def running_total(df: DataFrame, value: Column, order: list[Column], name: str = "running", ranges: int | None = None) -> DataFrame:
    """df with the sum of value over all rows up to each, in order, as a window with unbounded preceding rows gives."""
    rows = _sorted(df.withColumn("_value", value), order, ranges)
    before = _before(rows.groupBy("_range").agg(F.sum("_value").alias("_sum")), "_sum")
    inner = F.sum("_value").over(Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
    found = rows.withColumn("_inner", inner).join(F.broadcast(before), "_range")  # a row a partition
    both = F.when(F.col("_before").isNull(), F.col("_inner")).when(F.col("_inner").isNull(), F.col("_before")).otherwise(F.col("_before") + F.col("_inner"))
    return found.withColumn(name, both).drop("_value", "_range", "_place", "_inner", "_before")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """left with the values of right's last row of the same keys before each row's time (null if there is none; of rows
    at one time the greatest). One shuffle: both are sorted together, no pairs are made. A null key is a key."""
    both = left.withColumn("_right", F.lit(None).cast(right.select(F.struct(time, *values)).schema[0].dataType.simpleString()))
    marks = right.select(*keys, time, F.struct(time, *values).alias("_right"))
    every = both.withColumn("_left", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    order = F.unix_micros(F.col(time).cast("timestamp"))
    earlier = Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    found = every.withColumn("_found", F.max("_right").over(earlier)).where("_left")
    return found.select(*left.columns, *[F.col("_found")[v].alias(v) for v in values])


def within(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], start: str, time: str, width: datetime.timedelta) -> DataFrame:
    """Pairs with equal keys in which right's time is from left's start on, for so long (both ends included)."""
    test = F.col(time).between(F.col(start), F.col(start) + F.lit(width))
    for a, b in zip(left_keys, right_keys, strict=True):
        test = test & (F.col(a) == F.col(b))
    return left.join(right, test)


def near_in_time(left: DataFrame, right: DataFrame, time: str, other: str, width: datetime.timedelta) -> DataFrame:
    """Pairs in which right's time is at most `width` before left's, or at it. Time is cut in bins of that width: a row
    of the right goes to its bin and the next, so each pair meets once, and it is an equi-join whatever the size."""
    micros = width // datetime.timedelta(microseconds=1)
    bin_of = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / micros)
    a = left.withColumn("_bin", bin_of(time))
    b = right.withColumn("_bin", F.explode(F.array(bin_of(other), bin_of(other) + 1)))
    close = (F.col(other) <= F.col(time)) & (F.col(other) >= F.col(time) - F.lit(width))
    return a.join(b, "_bin").where(close).drop("_bin")


def near_counts(left: DataFrame, right: DataFrame, time: str, other: str, width: datetime.timedelta, keys: list[str] | None = None, name: str = "n", ranges: int | None = None) -> DataFrame:
    """left with how many rows of right have equal keys (none: all rows count; null is a key) and a time at most `width` before its own, or
    at it. No pairs are made: both sides are sorted into the same ranges, each row of left stands at both ends of its interval, and the count is
    the difference of two running ranks. Rows shuffled: two of left and one of right, whatever the number of pairs, and a time that many
    rows share is split over ranges like any other."""
    keys = keys or []
    rows = cut(left.withColumn("_asked", F.monotonically_increasing_id()))
    at = F.unix_micros(F.col(time).cast("timestamp"))
    micros = width // datetime.timedelta(microseconds=1)
    # at one time: starts come before rows of the right, ends after them
    ends = F.array(F.struct((at - micros).alias("_at"), F.lit(-1).alias("_side")), F.struct(at.alias("_at"), F.lit(1).alias("_side")))
    asked = rows.where(F.col(time).isNotNull()).select(*keys, "_asked", F.explode(ends).alias("_end")).select(*keys, F.col("_end._at").alias("_at"), F.col("_end._side").alias("_side"), "_asked", F.lit(0).alias("_one"))
    there = right.where(F.col(other).isNotNull()).select(*keys, F.unix_micros(F.col(other).cast("timestamp")).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast("long").alias("_asked"), F.lit(1).alias("_one"))
    order = [*[F.col(k).asc_nulls_first() for k in keys], F.col("_at"), F.col("_side"), F.col("_asked")]
    ranked = running_total(asked.unionByName(there), F.col("_one"), order, "_rank", ranges)
    counts = ranked.where("_asked IS NOT NULL").groupBy("_asked").agg(F.sum(F.col("_side") * F.col("_rank")).alias(name))
    return rows.join(counts, "_asked", "left").select(*left.columns, F.coalesce(name, F.lit(0)).cast("long").alias(name))
