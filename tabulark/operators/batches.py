"""Batches of key-value entities: per partition key, bounded in rows and bytes, no row key twice in one; payloads."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

ROWS, BYTES, ENTITY_BYTES = 100, 1_750_000, 1_000_000


def plan_batches(df: DataFrame, partition_key: str, row_key: str, size: str, rows: int = ROWS, most: int = BYTES, ranges: int | None = None) -> DataFrame:
    """df's key columns and size with batch (0, 1, ... within its partition key), packed greedily in order of
    row key, within ranges of (partition key, row key): a range starts a new batch, so a key of any size is packed in as
    many tasks as it has ranges, with a batch more for each at most. Rows are streamed, sorted, through each task: no key
    is gathered in memory. Of equal row keys none is parted from the others by a range, so none meets in a batch."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, batch, n, total, used = None, 0, 0, 0, set()
        for frame in frames:
            out = []
            for p, r, s, _ in frame.itertuples(index=False):
                if p != current:
                    current, batch, n, total, used = p, 0, 0, 0, set()
                if s > ENTITY_BYTES:
                    raise ValueError(f"entity {p}/{r} has {s} bytes; {ENTITY_BYTES} are allowed")
                if n and (n == rows or total + s > most or r in used):
                    batch, n, total, used = batch + 1, 0, 0, set()
                n, total = n + 1, total + s
                used.add(r)
                out.append(batch)
            yield frame.assign(batch=out)

    slim = df.select(F.col(partition_key).cast("string").alias("partition_key"), F.col(row_key).cast("string").alias("row_key"), F.col(size).cast("long").alias("size"))
    dealt = slim.repartitionByRange(ranges, "partition_key", "row_key") if ranges else slim.repartitionByRange("partition_key", "row_key")
    dealt = dealt.sortWithinPartitions("partition_key", "row_key", "size").withColumn("range", F.spark_partition_id())
    packed = cut(dealt.mapInPandas(pack, "partition_key string, row_key string, size long, range int, batch long"))
    # a row for each range of a key: how many batches are in those before
    each = packed.groupBy("partition_key", "range").agg((F.max("batch") + 1).alias("n"))
    before = Window.partitionBy("partition_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select(F.col("partition_key").alias("_key"), F.col("range").alias("_range"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    found = packed.join(each, F.col("partition_key").eqNullSafe(F.col("_key")) & (F.col("range") == F.col("_range")))
    return found.select("partition_key", "row_key", "size", (F.col("batch") + F.col("_before")).alias("batch"))


def entity_size(df: DataFrame, partition_key: str, row_key: str, properties: list[str]):
    """A column: bytes of an entity as a service counts them: keys and names and texts at two a character, numbers and
    times at eight, flags at one, 4 for the entity and 8 for each property; nulls count nothing."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    text = lambda c: 2 * F.length(F.col(c).cast("string"))

    def one(name: str):
        kind = kinds[name]
        own = text(name) + 4 if kind == "string" else F.octet_length(name) + 4 if kind == "binary" else F.lit(1) if kind == "boolean" else F.lit(4) if kind in ("int", "smallint", "tinyint") else F.lit(8)
        return F.when(F.col(name).isNotNull(), own + 8 + 2 * len(name)).otherwise(0)

    total = F.lit(4) + text(partition_key) + text(row_key)
    for name in properties:
        total = total + one(name)
    return total.cast("long")


def json_lines(df: DataFrame) -> DataFrame:
    """(line): each row as a JSON object; nulls are written. Written as text, each file is a part of the payload."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"))


def text_lines(df: DataFrame, separator: str = "\t") -> DataFrame:
    """(line): each row's values as text, joined; nulls are empty; separators and line ends within become spaces."""
    clean = lambda c: F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), f"[\r\n{separator}]+", " ")
    return df.select(F.concat_ws(separator, *map(clean, df.columns)).alias("line"))


def write_json_array(df: DataFrame, path: str, order: list[str]) -> None:
    """A JSON array in files: sorted by range, a file for each range of the order; put together in order of name they
    are one array. No value holds more than a row."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    numbered = json_lines(rows).withColumn("_id", F.monotonically_increasing_id())
    kept = cut(numbered)
    first = kept.agg(F.min("_id"), F.max("_id")).first()
    low, high = first if first[0] is not None else (None, None)
    head = F.when(F.col("_id") == F.lit(low), "[").otherwise("")
    tail = F.when(F.col("_id") == F.lit(high), "]").otherwise(",")
    if low is None:
        df.sparkSession.createDataFrame([("[]",)], "line string").coalesce(1).write.text(path)
    else:
        kept.select(F.concat(head, "line", tail).alias("line")).write.text(path)


def json_array(df: DataFrame, order: list[str], most: int = 100_000) -> DataFrame:
    """One row: all rows as a JSON array, ordered. For payloads: more than `most` rows fail; write_json_array() has no limit."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.to_json(F.struct(*df.columns)).alias("_json"))))
    few = F.when(F.size(rows) > most, F.raise_error(F.lit(f"more than {most} rows for one payload"))).otherwise(F.concat(F.lit("["), F.array_join(F.transform(rows, lambda r: r["_json"]), ","), F.lit("]")))
    return df.limit(most + 1).agg(few.alias("payload"))


def write_entities(old: DataFrame, new: DataFrame, mode: str) -> DataFrame:
    """Frames of (partition_key, row_key, properties map). add: keys must be new; merge: properties that new
    lacks stay; replace: new ones stand alone. A key that new has twice fails the job."""
    keys = ["partition_key", "row_key"]
    times = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    new = new.withColumn("_times", times)
    new = new.withColumn("properties", F.when(F.col("_times") > 1, F.raise_error(F.concat(F.lit("an entity comes twice: "), F.to_json(F.struct(*keys)))).cast("map<string,string>")).otherwise(F.col("properties"))).drop("_times")
    if mode == "add":
        if new.join(old, keys, "left_semi").limit(1).count():
            raise ValueError("an entity with this key exists")
        return old.unionByName(new)
    both = old.withColumnRenamed("properties", "_old").join(new.withColumnRenamed("properties", "_new"), keys, "full")
    if mode == "replace":
        return both.select(*keys, F.coalesce("_new", "_old").alias("properties"))
    if mode != "merge":
        raise ValueError(f"unknown mode: {mode}")
    empty = F.create_map().cast("map<string,string>")
    stays = F.map_filter(F.coalesce("_old", empty), lambda k, v: ~F.array_contains(F.map_keys(F.coalesce("_new", empty)), k))
    return both.select(*keys, F.map_concat(stays, F.coalesce("_new", empty)).alias("properties"))
