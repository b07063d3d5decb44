"""Queries over the driver's tables, continued: streams, whose rows come out of the stream itself."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from .operators import dml
from .queries_more import local_scratch, scratch
from .registry import made, table
from .sources import jdbc, sqlite
from .streaming import joins, stateful, timers, windows


def fed(df: DataFrame, path: str, time: str, order: list[str], slices: int = 4) -> DataFrame:
    """A stream that takes df in slices of time, a batch each, in order."""
    spark = df.sparkSession
    cuts = df.select(F.percentile_approx(time, [i / slices for i in range(1, slices)]).alias("c")).first()[0] or []
    number = sum([F.when(F.col(time) > F.lit(c), 1).otherwise(0) for c in cuts], F.lit(0))
    for i in range(len(cuts) + 1):  # one after the other: files are taken in order of their times
        df.where(number == i).coalesce(1).sortWithinPartitions(*order).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(stream: DataFrame, path: str, mode: str = "append", write: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """The stream until it has no more, into path/out."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True)
    query = (writer.foreachBatch(write) if write else writer.format("parquet").option("path", f"{path}/out")).start()
    query.awaitTermination()
    return query


def with_store(spark: SparkSession, work: Callable[[], None]) -> None:
    """work, with the settings that state with timers needs."""
    before = {k: spark.conf.get(k, None) for k in timers.STORE}
    for k, v in timers.STORE.items():
        spark.conf.set(k, v)
    try:
        work()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@made("WITH s AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS fresh FROM events), g AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id AS key, min(ts) AS start, max(ts) + INTERVAL 30 MINUTES AS \"end\", count(*) AS n FROM g GROUP BY user_id, k")
def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions that timers close, over several batches; a last row far ahead lets all of them end."""
    events = table(spark, folder, "events").select("user_id", "ts")
    path = scratch(spark, "sessions")
    top = events.agg(F.max("ts")).first()[0]
    stream = fed(events, f"{path}/in", "ts", ["ts"])
    spark.createDataFrame([(None, top + datetime.timedelta(days=days)) for days in (30, 60)], events.schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    with_store(spark, lambda: run(timers.sessions(stream, "ts", "30 MINUTES", "user_id", "1 minute"), path))
    # the sentinels' own sessions have no key
    return spark.read.parquet(f"{path}/out").where("key IS NOT NULL").select("key", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@made("SELECT e.event_id, p.event_id AS purchase_id FROM events e JOIN events p ON e.user_id = p.user_id AND p.ts >= e.ts AND p.ts <= e.ts + INTERVAL 6 HOURS WHERE e.event_type = 'error' AND p.event_type = 'purchase'")
def stream_join(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases within six hours of an error: two streams, each with its watermark."""
    events = table(spark, folder, "events")
    path = scratch(spark, "join")
    errors = fed(events.where("event_type = 'error'").select("event_id", "user_id", "ts"), f"{path}/errors", "ts", ["ts"])
    bought = fed(events.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("buyer"), F.col("ts").alias("at")), f"{path}/bought", "at", ["at"])
    # a slice of one stream may be ahead of the other's by as much as slices differ: both wait for days
    run(joins.within(errors, bought, [("user_id", "buyer")], "ts", "at", "6 HOURS", ("10 days", "10 days")), path)
    return spark.read.parquet(f"{path}/out").select("event_id", "purchase_id")


@made("WITH m AS (SELECT max(ts) AS top FROM events WHERE event_id % 50 <> 0) SELECT 'kept' AS what, count(*) AS n FROM events, m WHERE event_id % 50 <> 0 OR date_trunc('millisecond', ts) > date_trunc('millisecond', top) - INTERVAL 2 DAYS UNION ALL SELECT 'dropped', count(*) FROM events, m WHERE event_id % 50 = 0 AND date_trunc('millisecond', ts) <= date_trunc('millisecond', top) - INTERVAL 2 DAYS")
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One event in fifty comes after all others: a stream that waits for two days drops those that are older, and says how many."""
    events = table(spark, folder, "events").select("event_id", "ts")
    path = scratch(spark, "late")
    late = F.col("event_id") % 50 == 0
    top = events.where(~late).agg(F.max("ts")).first()[0]
    second = ~late & (F.col("event_id") % 50 == 1) & (F.col("ts") > F.lit(top) - F.expr("INTERVAL 1 DAY")) & (F.col("ts") < F.lit(top))
    for some in (~late & ~second, second, late):  # Spark drops by the watermark of the batch before the last
        events.where(some).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    query = run(windows.first_seen(stream, "ts", ["event_id"], "2 days"), path)
    dropped = joins.progress(query).dropped
    return spark.read.parquet(f"{path}/out").agg(F.lit("kept").alias("what"), F.count("*").alias("n")).unionByName(spark.createDataFrame([("dropped", dropped)], "what string, n long"))


@made("SELECT event_type, user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def first_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A stream's first row of each key, over batches in order of time: ids as the stream gives them."""
    events = table(spark, folder, "events").select("event_type", "user_id", "ts", "event_id")
    path = scratch(spark, "first")
    run(windows.first_seen(fed(events, f"{path}/in", "ts", ["ts", "event_id"]), "ts", ["event_type", "user_id"], "400 days"), path)
    return spark.read.parquet(f"{path}/out").select("event_type", "user_id", "event_id")


@made("SELECT user_id AS key, ts AS time, event_type AS value, before FROM (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS k FROM (SELECT event_id, user_id, ts, nullif(event_type, 'view') AS event_type FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE k = 1 OR before IS DISTINCT FROM event_type")
def stream_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of a value that may be null, over batches in order of time."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", F.nullif("event_type", F.lit("view")).alias("event_type"))
    path = scratch(spark, "changes")
    run(stateful.changes(fed(events, f"{path}/in", "ts", ["ts", "event_id"]), "user_id", "ts", "event_type", ["event_id"]), path)
    return spark.read.parquet(f"{path}/out")


@made("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def sqlite_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in SQLite, read as a stream while the table grows: stopped after each growth and started again from its checkpoint."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = f"{local_scratch(spark, 'stream')}"
    for k in range(3):
        sqlite.bulk_insert(orders.where(F.col("o_orderkey") % 3 == k), f"{path}/t.db", "orders")
        stream = spark.readStream.format("sqlite").options(path=f"{path}/t.db", table="orders", partitions="4").load()
        run(stream, f"file://{path}")
    return spark.read.parquet(f"file://{path}/out")


@made("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def sqlite_pushdown(spark: SparkSession, folder: str) -> DataFrame:
    """A filter that SQLite evaluates, and a query that is read in four ranges."""
    path = f"{local_scratch(spark, 'pushed')}/t.db"
    sqlite.bulk_insert(table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path, "customer")
    found = spark.read.format("sqlite").options(path=path, query="SELECT * FROM customer WHERE c_custkey >= 0", partitions="4", column="c_custkey").load()
    return found.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_acctbal") > 0)).select("c_custkey", "c_name", "c_acctbal")


@made("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def jdbc_all_or_nothing(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers written by tasks to a staging table, and rows of attempts that lost beside them: one statement takes the winners'."""
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    rows = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal").repartition(4)
    staged = jdbc.stage(rows, url, "SUPPLIER", types={"s_name": "VARCHAR(100)"})
    lost = jdbc.stage(rows, url, "SUPPLIER", types={"s_name": "VARCHAR(100)"}, into=staged.table)
    lost.winners.clear()  # as if these tasks had been lost after their commits
    staged.commit()
    return jdbc.read(spark, url, "SUPPLIER")


@made("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def incremental_copy(spark: SparkSession, folder: str) -> DataFrame:
    """Orders copied as they come. The stream is lost after its second batch is in the table and before Spark has noted it; started
    again it repeats the batch, which adds nothing, and goes on."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = scratch(spark, "increment")
    target = Lost(spark, f"{path}/table")
    target.commit(orders.limit(0))
    for k in range(3):
        orders.where(F.col("o_orderkey") % 3 == k).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(orders.schema).parquet(f"{path}/in")
        target.lost = k == 1
        try:
            windows.into_table(stream, target, f"{path}/state")
        except StreamingQueryException:
            target.lost = False
            windows.into_table(stream, target, f"{path}/state")
    return target.read()


class Lost(dml.VersionedTable):
    """A table whose writer is lost right after it has published."""

    lost = False

    def append_once(self, rows: DataFrame, source: str, number: int) -> int:
        done = super().append_once(rows, source, number)
        if self.lost:
            raise OSError("the writer is gone")
        return done


@made("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def incremental_upserts(spark: SparkSession, folder: str) -> DataFrame:
    """The last event of each user, merged by key from the batches of a stream in order of event_id."""
    events = table(spark, folder, "events").where("user_id IS NOT NULL").select("user_id", "event_id", "event_type")
    path = scratch(spark, "upserts")
    target = dml.VersionedTable(spark, f"{path}/table")
    target.commit(events.limit(0))
    last = lambda df: df.groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type"))
    top = events.agg(F.coalesce(F.max("event_id"), F.lit(0))).first()[0]
    for k in range(3):
        part = F.floor(F.col("event_id") * 3 / F.lit(top + 1)) == k
        last(events.where(part)).coalesce(1).write.mode("append").parquet(f"{path}/in")
        windows.into_table(spark.readStream.schema(target.state().schema).parquet(f"{path}/in"), target, f"{path}/state", ["user_id"])
    return target.read()
