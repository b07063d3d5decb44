"""State with timers, joins of streams, and sources and sinks whose tasks may be repeated."""

import datetime
import sqlite3
import subprocess
import sys
import uuid
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, Not, StringContains
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tabulark import queries, queries_streams  # noqa: F401  the first registers the second
from tabulark.sources import jdbc, sqlite
from tabulark.streaming import joins, stateful, timers

DAY = datetime.datetime(2024, 1, 1)


def minutes(*values):
    return [DAY + datetime.timedelta(minutes=v) for v in values]


def batches(spark, path, schema, *each):
    for rows in each:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def test_sessions_are_closed_by_timers(spark, tmp_path):
    a, b, c, d, e, f, g = minutes(0, 5, 12, 40, 44, 300, 600)
    # in the third batch a row joins two sessions that were apart, and one is within the watermark's wait
    stream = batches(spark, tmp_path, "k string, t timestamp", [("x", a), ("x", c), ("y", a), (None, a)], [("x", d)], [("x", b), ("x", e), ("y", None)], [("z", f)], [("z", g)])
    queries_streams.with_store(spark, lambda: queries_streams.run(timers.sessions(stream, "t", "10 MINUTES", "k", "60 MINUTES"), str(tmp_path)))
    gap = datetime.timedelta(minutes=10)
    found = {(r["key"], r["start"], r["end"], r["n"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert found == {("x", a, c + gap, 3), ("x", d, e + gap, 2), ("y", a, a + gap, 1), (None, a, a + gap, 1), ("z", f, f + gap, 1)}
    assert timers.joined([(5, 6, 1), (0, 1, 2), (1, 2, 1)], 2) == [(0, 2, 3), (5, 6, 1)]
    before = {k: spark.conf.get(k, None) for k in timers.STORE}
    spark.conf.set(*next(iter(timers.STORE.items())))
    state = spark.read.format("statestore").option("path", f"{tmp_path}/state").option("stateVarName", "open").option("flattenCollectionTypes", "true").load()
    left = {r["key"]["key"] for r in state.collect()}
    spark.conf.unset(next(iter(timers.STORE))) if before[next(iter(timers.STORE))] is None else None
    assert left <= {"z"}  # what is over left nothing behind


def test_a_key_has_one_timer(monkeypatch):
    """However many sessions a key has: calls go by keys. The timer closes all that the watermark has passed, and is set anew for the rest."""

    class Store:
        def __init__(self):
            self.rows, self.timers, self.calls = [], set(), 0

        def getListState(self, *_):
            return self

        def get(self):
            return iter(self.rows)

        def put(self, rows):
            self.rows, self.calls = list(rows), self.calls + 1

        def clear(self):
            self.rows, self.calls = [], self.calls + 1

        def registerTimer(self, at):
            self.timers, self.calls = self.timers | {at}, self.calls + 1

        def deleteTimer(self, at):
            self.timers, self.calls = self.timers - {at}, self.calls + 1

    store, work = Store(), timers.Sessions(1000, "long")
    work.init(store)
    told = lambda mark, at=0: type("T", (), {"getCurrentWatermarkInMs": lambda self: mark, "getExpiryTimeInMs": lambda self: at})()
    assert not list(work.handleInputRows((7,), iter([pd.DataFrame({"at": [i * 10_000 for i in range(100, 0, -1)]})]), told(0)))
    assert store.timers == {11} and store.calls == 2
    store.timers = set()  # it fires
    over = pd.concat(list(work.handleExpiredTimer((7,), told(501), told(0, 11))))
    assert over["first"].tolist() == [i * 10_000 for i in range(1, 51)] and store.timers == {511} and store.calls == 4
    assert not list(work.handleInputRows((7,), iter([pd.DataFrame({"at": [505_000]})]), told(501))) and store.timers == {506}


def test_values_are_forgotten(spark, tmp_path):
    stream = batches(spark, tmp_path, "k string, v string", [("a", "x"), ("a", "x"), ("a", "y"), ("b", None)], [("a", "z")])
    seen = []

    def work():
        # processing time never has no more to do, so the stream is stopped once it has seen both batches
        query = timers.recent_values(stream, "k", "v", 3600).writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/state").foreachBatch(lambda df, i: seen.append({r["key"]: (r["n_values"], r["n"]) for r in df.collect()})).start()
        try:
            for _ in range(120):
                if len(seen) >= 2 or query.awaitTermination(1):
                    break
        finally:
            query.stop()

    queries_streams.with_store(spark, work)
    assert seen[:2] == [{"a": (2, 3), "b": (0, 0)}, {"a": (3, 4)}]


def test_stream_join_drops_what_is_late(spark, tmp_path):
    a, b, c, d = minutes(0, 30, 500, 900)
    left = batches(spark, tmp_path / "l", "k int, t timestamp", [(1, a), (2, a)], [(3, d)], [(3, d)], [(4, a)])
    right = batches(spark, tmp_path / "r", "j int, u timestamp", [(1, b), (2, c)], [(3, d)], [(9, d)], [(4, b)])
    query = queries_streams.run(joins.within(left, right, [("k", "j")], "t", "u", "60 MINUTES", ("10 minutes", "10 minutes")), str(tmp_path))
    found = sorted((r["k"], r["u"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert found == [(1, b), (3, d), (3, d)]
    told = joins.progress(query)
    assert told.dropped == 2 and told.rows == 10 and told.batches >= 4


def test_changes_with_nulls(spark, tmp_path):
    a, b, c, d, e = minutes(0, 1, 2, 3, 4)
    rows = [("k", a, "x"), ("k", b, None), ("k", c, None), ("k", d, "x"), ("n", a, None), ("n", b, None), ("n", e, "None")]
    want = {("k", a, "x", None), ("k", b, None, "x"), ("k", d, "x", None), ("n", a, None, None), ("n", e, "None", None)}
    df = spark.createDataFrame(rows, "k string, t timestamp, v string")
    assert {tuple(r) for r in stateful.batch_changes(df, "k", "t", "v").collect()} == want
    for n, cuts in enumerate(((0, 7), (0, 2, 7), (0, 1, 3, 5, 7))):
        path = tmp_path / str(n)
        stream = batches(spark, path, "k string, t timestamp, v string", *[rows[x:y] for x, y in zip(cuts, cuts[1:], strict=False)])
        queries_streams.run(stateful.changes(stream, "k", "t", "v"), str(path))
        assert {tuple(r) for r in spark.read.parquet(f"{path}/out").collect()} == want


@pytest.mark.parametrize("kind, values", [("long", [2**60, 2**60 + 1, None]), ("binary", [b"\xff", b"", None]), ("double", [0.5, -0.0, float("inf")]), ("string", ["", "=", None])])
def test_changes_keep_keys_in_parts(spark, tmp_path, kind, values):
    """Keys of a part have their own last values and come out as they went in; a part is called once a batch, however many keys it has."""
    a, b, c = minutes(0, 1, 2)
    rows = [(k, t, v) for k in values for t, v in ((a, "x"), (b, "x"), (c, "y"))]
    df = spark.createDataFrame(rows, f"k {kind}, t timestamp, v string")
    stream = batches(spark, tmp_path, df.schema, rows[::2], rows[1::2])
    found = stateful.changes(stream, "k", "t", "v", parts=1)
    assert found.schema["key"].dataType == df.schema["k"].dataType
    queries_streams.run(found, str(tmp_path))
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    want, seen = [], {}
    for part in (rows[::2], rows[1::2]):
        for k in values:
            for _, t, v in sorted((r for r in part if r[0] == k), key=lambda r: r[1]):
                if k not in seen or seen[k] != v:
                    want.append((k, t, v, seen.get(k)))
                seen[k] = v
    assert Counter((bytes(r[0]) if isinstance(r[0], bytearray) else r[0], *r[1:]) for r in got) == Counter(want)


@pytest.fixture
def odd_table(tmp_path):
    path = f"{tmp_path}/t.db"
    connection = sqlite3.connect(path)
    connection.execute("CREATE TABLE t (a INTEGER, s TEXT COLLATE NOCASE, x REAL)")
    rows = [(i, f"s{i % 5}", i / 2) for i in range(100)] + [(None, None, None), (7, "S1", 1.0), (9, b"s1", "7")]
    connection.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    connection.commit()
    connection.close()
    return path


def test_filters_are_pushed_down(spark, odd_table):
    schema = StructType([StructField("a", LongType()), StructField("s", StringType()), StructField("x", DoubleType())])
    relation = '"t"'
    reader = lambda *filters, **options: (lambda r: (list(r.pushFilters(list(filters))), sum(len(list(r.read(p))) for p in r.partitions())))(sqlite.SqliteReader({"path": odd_table, "table": "t", **options}, schema, relation))
    assert reader(GreaterThan(("a",), 90))[1] == 9  # only these are read
    assert reader(In(("s",), ("s1", "s2")), EqualTo(("a",), 6))[1] == 1
    assert reader(EqualTo(("s",), "s1"))[1] == 21  # other cases not; what is no text goes to Spark
    assert reader(IsNull(("a",)))[1] == 1 and reader(Not(IsNull(("a",))))[1] == 102
    assert reader(StringContains(("s",), "1"))[1] == 103 and reader(EqualTo(("a",), float("nan")))[1] == 103
    assert reader(partitions="4", column="a")[1] == 103 and reader(partitions="4")[1] == 103
    asked = StructType([schema[0]])
    whole = sqlite.SqliteReader({"path": odd_table, "query": "SELECT a FROM t", "partitions": "4", "column": "a"}, asked, "(SELECT a FROM t)")
    assert len(whole.partitions()) == 5 and sorted(len(list(whole.read(p))) for p in whole.partitions()) == [1, 25, 25, 25, 27]
    sqlite.register(spark)
    df = spark.read.format("sqlite").options(path=odd_table, table="t", partitions="3").load()
    assert df.where((F.col("s") == "s1") & (F.col("a") < 50)).count() == 11 and df.where("x = 7.0").count() == 2


def test_sqlite_stream_goes_on(spark, tmp_path):
    path = f"{tmp_path}/t.db"
    sqlite.register(spark)
    for k in range(3):
        sqlite.bulk_insert(spark.range(k * 10, k * 10 + 10).withColumn("v", F.lit(k)), path, "t")
        for _ in range(2):  # nothing comes twice, also if there is nothing new
            stream = spark.readStream.format("sqlite").options(path=path, table="t", partitions="3").load()
            queries_streams.run(stream, f"file://{tmp_path}")
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(30))
    with pytest.raises(ValueError):
        sqlite.SqliteStream({"path": path, "query": "SELECT 1"}, StructType([]), "")


def test_jdbc_repeated_tasks_leave_nothing_twice(spark):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    df = spark.range(100, numPartitions=4).withColumn("s", F.concat(F.lit("v"), "id"))
    types = {"s": "VARCHAR(20)"}
    first = jdbc.stage(df, url, "T", types=types)
    again = jdbc.stage(df, url, "T", types=types, into=first.table)  # the same tasks once more, committed as well
    assert jdbc.read(spark, url, first.table).count() == 200 and again.winners.keys() == first.winners.keys()
    assert jdbc.read(spark, url, "T").count() == 0  # nothing is seen before the commit
    assert again.commit() == 100 and jdbc.read(spark, url, "T").agg(F.count_distinct("id"), F.count("*")).first() == (100, 100)
    lacking = jdbc.stage(df, url, "T", types=types)
    lacking.winners[99] = (1, 5)  # a task whose rows aren't there
    with pytest.raises(RuntimeError, match="task 99"):
        lacking.commit()
    assert jdbc.read(spark, url, "T").count() == 100
    assert jdbc.write(df.limit(3), url, "T", "overwrite") == 3 and jdbc.read(spark, url, "T").count() == 3
    with pytest.raises(Exception, match="(?i)boom"):
        jdbc.write(df.withColumn("s", F.when(F.col("id") == 99, F.raise_error(F.lit("boom"))).otherwise(F.col("s"))), url, "T")
    assert jdbc.read(spark, url, "T").count() == 3


CLUSTER = """
import sys
sys.path.insert(0, sys.argv[1])
from tabulark.session import session
import __spark_entry__ as entry
from tabulark.sources import jdbc
conf = {"spark.driver.host": "127.0.0.1", "spark.executor.memory": "800m", "spark.checkpoint.dir": f"file://{sys.argv[2]}", "spark.ui.enabled": "false"}
spark = session("cluster", "local-cluster[2,1,1200]", **conf)
for name in ("jdbc_round_trip", "jdbc_all_or_nothing"):
    print("rows", name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
url = "jdbc:derby:memory:odd;create=true"
df = spark.sql("SELECT id, if(id = 1, NULL, 'it''s ' || id) AS s, DATE'2024-02-29' AS d, TIMESTAMP'2024-02-29 01:02:03.5' AS t, if(id = 2, NULL, 1.25D) AS f, 1.50BD AS m FROM range(4)")
assert jdbc.write(df, url, "ODD") == 4 and sorted(map(tuple, jdbc.read(spark, url, "ODD").collect())) == sorted(map(tuple, df.collect()))
assert jdbc.write(df.limit(0), url, "ODD") == 0 and jdbc.read(spark, url, "ODD").where("id > 9").count() == 0
try:
    jdbc.write(df.selectExpr("id", "if(id = 3, raise_error('boom'), s) AS s", "d", "t", "f", "m"), url, "ODD")
except Exception:
    print("rows after", jdbc.read(spark, url, "ODD").count())
"""


def test_jdbc_store_of_the_driver_on_a_cluster(tmp_path):
    """Executors in JVMs of their own: a store in the driver's memory has all rows, or none."""
    (tmp_path / "run.py").write_text(CLUSTER)
    done = subprocess.run([sys.executable, tmp_path / "run.py", Path(__file__).parent.parent, tmp_path / "shared"], capture_output=True, text=True, timeout=240, cwd=tmp_path)
    assert [line for line in done.stdout.splitlines() if line.startswith("rows")] == ["rows jdbc_round_trip 9", "rows jdbc_all_or_nothing 10", "rows after 4"], done.stderr[-3000:]
