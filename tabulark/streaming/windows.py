"""Event-time windows and incremental copies with Structured Streaming."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dml import VersionedTable


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Zoneless timestamps as instants (UTC sessions): watermarks take no others."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def tumbling(df: DataFrame, time: str, width: str, keys: list[str], late: str | None = None, slide: str | None = None) -> DataFrame:
    """Counts by window (sliding with `slide`) and keys; late: how long a stream waits for stragglers."""
    df = event_time(df, time)
    if late:
        df = df.withWatermark(time, late)
    return df.groupBy(F.window(time, width, slide) if slide else F.window(time, width), *keys).agg(F.count("*").alias("n"))


def sessions(df: DataFrame, time: str, gap: str, keys: list[str], late: str | None = None) -> DataFrame:
    df = event_time(df, time)
    if late:
        df = df.withWatermark(time, late)
    return df.groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n"))


def first_seen(df: DataFrame, time: str, keys: list[str], late: str) -> DataFrame:
    """A stream's rows without repeats of keys within the watermark."""
    return event_time(df, time).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def copy_increment(spark: SparkSession, source: str, schema, checkpoint: str, write: Callable[[DataFrame, int], None], format_: str = "parquet") -> None:
    """What is new in a folder since the checkpoint, in batches, then stop. The checkpoint is the resume token."""
    stream = spark.readStream.format(format_).schema(schema).load(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def into_table(stream: DataFrame, table: VersionedTable, checkpoint: str, keys: list[str] | None = None) -> None:
    """What is new in a stream since the checkpoint, into a table: appended, or by keys merged with what is there. Each batch counts
    once, though Spark repeats one whose end it hasn't noted: the table's log holds the stream's id and the batch's number
    beside the rows. A new checkpoint is a new stream, whose batches are others. A batch that is merged may be repeated as it is."""

    def write(batch: DataFrame, number: int) -> None:
        if keys:
            table.upsert(batch, keys)
        else:
            table.append_once(batch, stream_id(batch.sparkSession, checkpoint), number)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint when it first ran."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
