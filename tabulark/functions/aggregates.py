"""Aggregates that stand for the statements one would write by hand. Each is a groupBy with partial sums before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_kind(df: DataFrame, keys: list[str], kind: str, time: str, kinds: dict[str, object]) -> DataFrame:
    """One row a key: for each name in kinds, the latest time of rows of that kind (null without any)."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(kind) == F.lit(v), F.col(time))).alias(name) for name, v in kinds.items()])


def pivot_counts(df: DataFrame, keys: list[str], kind: str, kinds: dict[str, object]) -> DataFrame:
    """One row a key: rows of each kind; null, not 0, where there are none. The kinds are given, so no job looks for them."""
    return df.groupBy(*keys).agg(*[F.nullif(F.count_if(F.col(kind) == F.lit(v)), F.lit(0)).alias(name) for name, v in kinds.items()])


def joined_text(df: DataFrame, keys: list[str], value: Column, order: list[Column], separator: str = ", ", name: str = "joined") -> DataFrame:
    """One row a key: its values in order, joined; nulls are left out. A key's values meet in one row, as its text does."""
    given = df.withColumn("_value", value.cast("string")).where(F.col("_value").isNotNull())
    rows = given.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col("_value")))).alias("_all"))
    return rows.select(*keys, F.array_join(F.transform("_all", lambda v: v["_value"]), separator).alias(name))


def integrity(df: DataFrame, key: str, amount: str) -> DataFrame:
    """One row: count, least, greatest and sum of a key, and sum of an amount, to compare two copies of a table by."""
    return df.agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"), F.sum(F.col(key).cast("long")).alias("keys"), F.sum(F.col(amount).cast("decimal(38,2)")).cast("double").alias("amount"))


def known_total(df: DataFrame, keys: list[str], value: str, name: str = "total") -> DataFrame:
    """One row a key: the sum if every value is known, else null."""
    return df.groupBy(*keys).agg(F.when(F.count(value) == F.count(F.lit(1)), F.sum(value)).alias(name))


def at_greatest(df: DataFrame, column: str) -> DataFrame:
    """Rows that have the greatest value of a column. The greatest is one row."""
    top = df.agg(F.max(column).alias("_top"))
    return df.join(F.broadcast(top), F.col(column) == F.col("_top")).drop("_top")


def distinct_counts(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_distinct(c).alias(name) for c, name in columns.items()])


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def framed(df: DataFrame, keys: list[str], order: list[Column], columns: dict[str, Column], rows: tuple[int, int] | None = None, range_: tuple[int, int] | None = None) -> DataFrame:
    """df with window columns over keys in order; a frame of rows or of a range of the (one, numeric) order. Keys are
    required: a window over everything would be one task (see operators.ranks)."""
    if not keys:
        raise ValueError("a window needs keys")
    over = Window.partitionBy(*keys).orderBy(*order)
    over = over.rowsBetween(*rows) if rows else over.rangeBetween(*range_) if range_ else over
    return df.withColumns({name: c.over(over) for name, c in columns.items()})
