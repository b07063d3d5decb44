"""The engine against the oracle SQL, and its rules on small frames with nulls, ties and repeats."""

import asyncio
import datetime
import enum
import json
import sqlite3
import threading
import time
from collections import Counter
from dataclasses import dataclass
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tabulark import client, queries
from tabulark.functions import aggregates, convert, matching, nested
from tabulark.operators import batches, catalog, copy, dml, infer, manage, monitor, paging, parallel, planner, ranks, writes
from tabulark.plans import statements
from tabulark.plans.query import Query, QueryError, Raw, operator
from tabulark.session import TABLES, named_in
from tabulark.sources import files, jdbc, sqlite
from tabulark.streaming import stateful, windows

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(float(v), 6) if isinstance(v, (float, Decimal)) else v
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


#: Their conditions fit larger tables.
EMPTY_AT_THE_SMALLEST = {"anti_join", "group_having", "not_in_subquery"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, oracle, name):
    df = queries.QUERIES[name](spark, DATA)
    found = oracle.execute(queries.ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    want = found.fetchall()
    assert rows_of(df.collect(), df.columns) == rows_of(want, names)
    assert want or name in EMPTY_AT_THE_SMALLEST, "an oracle without rows proves nothing"


def test_approximate_distinct(spark):
    exact = {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/lineitem.parquet").groupBy("l_returnflag").agg(F.countDistinct("l_partkey")).collect()}
    for r in queries.QUERIES["approximate_distinct"](spark, DATA).collect():
        assert abs(r[1] - exact[r[0]]) <= 0.1 * exact[r[0]]


def test_builder_rules():
    with pytest.raises(QueryError):
        operator("; DROP")
    with pytest.raises(QueryError):
        Query().from_("t").where("a", None)
    with pytest.raises(QueryError):
        Query().from_("t").where_in("a", [])
    with pytest.raises(QueryError):
        Query().from_("t").begin_group().where("a", 1).to_sql()
    with pytest.raises(QueryError):
        Query().from_("t").or_()
    with pytest.raises(QueryError):
        Query().from_(Query().select("a").from_("t"))
    text, args = Query().select("a.b").from_("we`ird").where("x", "  not   like ", "v").where(Raw("y").sql, "=", 2).to_sql()
    assert text == "SELECT `a`.`b` FROM `we``ird` WHERE `x` NOT LIKE :p0 AND `y` = :p1" and args == {"p0": "v", "p1": 2}
    assert Query().select("a").from_("t").limit(3).offset(2).top(5).to_sql()[0].endswith("LIMIT 5")


def test_values_are_never_spliced(spark):
    spark.createDataFrame([("x' OR '1'='1",), ("y",)], "name string").createOrReplaceTempView("quoted")
    assert Query().select("name").from_("quoted").where("name", "x' OR '1'='1").to_df(spark).count() == 1


def test_plans(spark):
    plan = lambda n: queries.QUERIES[n](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan("top_k") and "LeftSemi" in plan("in_subquery") and "LeftAnti" in plan("not_in_subquery")


def test_patterns():
    import re

    for pattern, value, hit in [("a%", "abc", True), ("a_", "abc", False), ("(ab|c)+", "abcab", True), ("a.c", "abc", False), ("[a-c]%", "b\nx", True)]:
        assert bool(re.match(matching.similar_to_regex(pattern), value)) == hit
    for pattern, value, hit in [("*.txt", "a.txt", True), ("?b", "ab", True), ("[^a]*", "abc", False), ("a+b", "a+b", True), ("A*", "abc", False)]:
        assert bool(re.match(matching.glob_regex(pattern), value)) == hit


def test_conversions(spark):
    df = spark.sql("SELECT * FROM VALUES (2.5D, '7'), (3.5D, ' -1 '), (-0.5D, NULL) AS t(d, s)")
    out = df.select(convert.convert(F.col("d"), df.schema["d"].dataType, "int32"), convert.convert(F.col("s"), df.schema["s"].dataType, "int64"), convert.convert(F.col("d"), df.schema["d"].dataType, "boolean")).collect()
    assert [tuple(r) for r in out] == [(2, 7, True), (4, -1, True), (0, None, False)]
    bad = spark.sql("SELECT '1.5' AS s")
    with pytest.raises(Exception, match="not an integer"):
        bad.select(convert.convert(F.col("s"), bad.schema["s"].dataType, "int32")).collect()


def test_versioned_table(spark, tmp_path):
    table = dml.VersionedTable(spark, f"file://{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.commit(spark.sql("SELECT * FROM VALUES (1, 'a'), (2, NULL), (NULL, 'c') AS t(k, v)")) == 1
    assert table.upsert(spark.sql("SELECT * FROM VALUES (2, 'b'), (4, 'd'), (NULL, 'e') AS t(k, v)"), ["k"]) == 3
    assert Counter(map(tuple, table.read().collect())) == Counter([(1, "a"), (2, "b"), (None, "e"), (4, "d")])
    assert table.upsert(spark.sql("SELECT * FROM VALUES (2, 'x'), (9, 'y') AS t(k, v)"), ["k"], []) == 1
    assert table.delete(F.col("k") > 1) == 3
    assert table.update({"v": F.lit("z")}, F.col("k") == 1) == 1
    assert Counter(map(tuple, table.read().collect())) == Counter([(1, "z"), (None, "e")])
    with pytest.raises(ValueError):
        table.append(spark.sql("SELECT 1 AS other"))
    assert table.append(spark.sql("SELECT 7 AS k")) == 1 and table.truncate() == 3
    assert table.read().count() == 0 and table.number() == 7 and table.read(1).count() == 3
    twice = spark.sql("SELECT * FROM VALUES (1, 'x', 1), (1, 'y', 2) AS t(k, v, at)")
    assert dml.last_of_each(twice, ["k"], "at").first()["v"] == "y"


def test_merge_rules(spark):
    target = spark.sql("SELECT * FROM VALUES (1, 'a'), (NULL, 'n') AS t(k, v)")
    twice = spark.sql("SELECT * FROM VALUES (1, 'x'), (1, 'y') AS t(k, v)")
    for verb in (dml.merge, dml.insert_if_missing):
        with pytest.raises(Exception, match="more than one source row"):
            verb(target, twice.withColumn("k", F.col("k") + F.lit(int(verb is dml.insert_if_missing))), ["k"]).collect()
    nulls = spark.sql("SELECT CAST(NULL AS INT) AS k, 'm' AS v")
    assert Counter(map(tuple, dml.merge(target, nulls, ["k"]).collect())) == Counter([(1, "a"), (None, "m")])
    assert dml.insert_if_missing(target, nulls, ["k"]).count() == 2
    with pytest.raises(ValueError):
        dml.merge(target, nulls, ["other"])
    assert dml.key_columns(["K"], ["k", "v", "id"], ["ID"]) == (["K"], ["v"])


def test_two_writers(spark, tmp_path):
    """Of two that start from one version one wins, and nothing of the other is seen."""
    table = dml.VersionedTable(spark, f"file://{tmp_path}/t")
    table.commit(spark.range(1))
    base, first, second = table.number(), table.stage(spark.range(2)), table.stage(spark.range(3))
    table.publish(first, base)
    with pytest.raises(dml.ConflictError):
        table.publish(second, base)
    assert table.read().count() == 2
    other = dml.VersionedTable(spark, f"file://{tmp_path}/u")
    other.commit(spark.range(5))
    with pytest.raises(dml.ConflictError), dml.Transaction() as both:
        both.write(other, spark.range(9))
        both.write(table, spark.range(9))
        table.commit(spark.range(4))  # meanwhile
    assert other.read().count() == 5 and table.read().count() == 4


def test_statements(spark, tmp_path):
    with pytest.raises(QueryError):
        statements.insert_into("a", "b").values(1)
    with pytest.raises(QueryError):
        statements.insert_into("a", "A")
    with pytest.raises(QueryError):
        statements.update().set("a", None)
    with pytest.raises(QueryError):
        statements.insert_or_update({"a": 1}, ("b",))
    with pytest.raises(QueryError):
        statements.insert_or_update({"a": 1}, ("a",)).update_only("b")
    table = dml.VersionedTable(spark, f"file://{tmp_path}/t")
    table.commit(spark.sql("SELECT * FROM VALUES (1, 'x'' OR ''1''=''1'), (2, NULL), (3, 'c') AS t(k, `odd name`)"))
    assert statements.delete().where("odd name", "x' OR '1'='1").run(spark, table) == 1  # a value is no SQL
    assert statements.update().set_null("odd name").matching(Query().where_in("k", [3, 4])).run(spark, table) == 1
    assert [tuple(r) for r in table.read().orderBy("k").collect()] == [(2, None), (3, None)]
    assert statements.delete().run(spark, table) == 2 and table.read().count() == 0
    with pytest.raises(QueryError):
        statements.insert_into("other").values(1).run(spark, table)


class Kind(enum.Enum):
    SMALL = 1


@dataclass
class Item:
    Id: int
    Kind: Kind
    At: datetime.datetime


def test_parameters_and_plans(spark):
    item = Item(7, Kind.SMALL, datetime.datetime(2024, 1, 1, 2, tzinfo=datetime.timezone(datetime.timedelta(hours=2))))
    found = writes.parameters(item, {"@id": "id", "@kind": "KIND", "@at": "at", "@user": "user", "@none": "a.b"}, {"USER": "me"})
    assert found == {"@id": 7, "@kind": 1, "@at": datetime.datetime(2024, 1, 1), "@user": "me", "@none": None}
    assert writes.parameters(item, {"k": "Kind"}, enums_as="name") == {"k": "SMALL"}
    assert writes.parameters(item, {"k": "Kind"}, converters={Kind: lambda v: f"<{v.name}>"}) == {"k": "<SMALL>"}
    assert writes.member({"A": [{"b": 1}, {"B": 2}]}, "a.1.b") == 2 and writes.member({"a": 1, "A": 2}, "A") == 2
    for bad in (([], None, None), (["a", "A"], None, None), (["a"], ["b"], None), (["a"], None, ["a"]), (["a", "b"], ["a"], ["A"])):
        with pytest.raises(ValueError):
            writes.write_plan(bad[0], keys=bad[1], update=bad[2])
    df = spark.sql("SELECT 1 AS a, -1 AS b")
    with pytest.raises(Exception, match="constraint small is broken"):
        writes.prepared(df, writes.BulkOptions(constraints={"small": "a < 1"})).collect()
    assert writes.prepared(df, writes.BulkOptions(constraints={"unknown": "nullif(a, 1) > 5"})).count() == 1
    for bad in (dict(batch_size=0), dict(mappings={"a": "x", "b": "X"})):
        with pytest.raises(ValueError):
            writes.BulkOptions(**bad)
    with pytest.raises(ValueError):
        writes.folded_names(spark.sql("SELECT 1 AS A, 2 AS `\"a\"`"))


def test_plan_counts(spark, tmp_path):
    table = dml.VersionedTable(spark, f"file://{tmp_path}/t")
    table.commit(spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(k, v)"))
    plan = writes.write_plan(["k", "v"], keys=["k"])
    assert plan.run(spark, table, [{"k": 2, "v": "x"}, {"k": 3, "v": None}], degree=2, expect=2) == 2
    with pytest.raises(ValueError, match="expected"):
        plan.run(spark, table, [{"k": 9, "v": "z"}], expect=5)
    with pytest.raises(ValueError):
        plan.run(spark, table, [{"k": 9, "v": "z"}], degree=2000)
    assert Counter(map(tuple, table.read().collect())) == Counter([(1, "a"), (2, "x"), (3, None)])


def test_copy(spark):
    source = spark.sql("SELECT * FROM VALUES ('Server1', 10L, 1), ('server1', 20L, 2), ('Server2', 15L, 3) AS t(ProbeName, LastUtc, StatusId)")
    kept, cleared, seen = {}, [], []
    count = lambda n: kept[n].count() if n in kept else 0
    write = lambda df, n: kept.update({n: spark.createDataFrame(df.collect(), df.schema)})
    spec = copy.CopySpec("a", "b", dedupe_keys=("ProbeName",), ignore_case=True, winners=("LastUtc",), mappings={"statusid": "Status"}, exclusions=("LastUtc",), conversions={"StatusId": "string"})
    done = copy.copy_tables([spec], lambda n: source, write, count, cleared.append, lambda n, p: seen.append(p))
    assert done.tables[0].verified and done.total() == 2 and cleared == ["b"] and len(done.fingerprint) == 64 and seen == [100] and done.version
    assert Counter(map(tuple, kept["b"].collect())) == Counter([("server1", "2"), ("Server2", "3")])
    with pytest.raises(copy.CopyError):
        copy.copy_tables([copy.CopySpec("a", "A")], lambda n: source, write, count)
    with pytest.raises(copy.CopyError):
        copy.transform(source, copy.CopySpec("a", "b", mappings={"LastUtc": "StatusId"}))
    # preflight comes before anything is cleared
    cleared.clear()
    bad = copy.CopySpec("a", "c", conversions={"ProbeName": "int32"})
    with pytest.raises(Exception, match="not an integer"):
        copy.copy_tables([copy.CopySpec("a", "b"), bad], lambda n: source, write, count, cleared.append)
    with pytest.raises(copy.CopyError, match="no columns"):
        copy.copy_tables([copy.CopySpec("a", "b")], lambda n: source, write, count, cleared.append, columns=lambda n: ["ProbeName", "LASTUTC"])
    assert cleared == []
    # a write that loses rows is found out, and one that adds to what was there isn't blamed for it
    with pytest.raises(copy.CopyError, match="copied"):
        copy.copy_tables([copy.CopySpec("a", "b")], lambda n: source, lambda df, n: write(df, n) or kept.update({n: kept[n].limit(1)}), count, lambda n: kept.pop(n, None))
    kept["b"] = source
    copy.copy_tables([copy.CopySpec("a", "b")], lambda n: source, lambda df, n: kept.update({n: kept[n].union(spark.createDataFrame(df.collect(), df.schema))}), count)
    assert kept["b"].count() == 6

    def lost(name):
        raise FileNotFoundError(name)

    with pytest.raises(FileNotFoundError):
        copy.copy_tables([copy.CopySpec("a", "b")], lost, write, count)
    empty, kept["e"] = source.limit(0), source
    for schema_only in (False, True):
        found = copy.copy_tables([copy.CopySpec("a", "e", exclusions=("StatusId",))], lambda n: empty, write, count, options=copy.CopyOptions(schema_only=schema_only)) if not schema_only else copy.copy_tables([copy.CopySpec("a", "f", exclusions=("StatusId",))], lambda n: empty, write, count)
        assert found.tables[0].verified and found.total() == 0
    assert kept["e"].count() == 3 and kept["f"].columns == ["ProbeName", "LastUtc"] and kept["f"].count() == 0
    found = copy.copy_tables([copy.CopySpec("a", "b")], lost, write, count, lost, options=copy.CopyOptions(missing_is_empty=True))
    assert found.warnings == ["a:MissingSourceTable", "b:MissingDestinationTable"] and (found.tables[0].source_rows, found.tables[0].copied_rows, found.tables[0].verified) == (0, 0, True)
    for said in ('relation "missing" does not exist', 'schema "s" does not exist', "no such table: T", "invalid object name 'dbo.T'.", "Table 'd.t' doesn't exist", "table or view does not exist"):
        assert copy.missing_table(RuntimeError(said))
    for said in ("function lower(integer) does not exist", 'column "k" does not exist', 'column "k" of relation "t" does not exist', "no such column: k", "Unknown column 'k' in 'field list'", "Invalid column name 'k'.", 'role "app" does not exist', "timeout"):
        assert not copy.missing_table(RuntimeError(said))


def test_copies_that_must_not_go_on(spark):
    kept = {}
    write = lambda df, n: kept.update({n: spark.createDataFrame(df.collect(), df.schema)})
    source = lambda n: spark.range(3)

    def clear(name):
        raise RuntimeError('column "x" does not exist')

    with pytest.raises(RuntimeError, match="column"):  # no missing table, whatever is allowed
        copy.copy_tables([copy.CopySpec("a", "b")], source, write, lambda n: None, clear, options=copy.CopyOptions(missing_is_empty=True))
    with pytest.raises(RuntimeError, match="no such table"):  # a missing table, and it isn't allowed
        copy.copy_tables([copy.CopySpec("a", "b")], source, write, lambda n: None, lambda n: (_ for _ in ()).throw(RuntimeError("no such table: b")))
    with pytest.raises(copy.CopyError, match="still has 7"):
        copy.copy_tables([copy.CopySpec("a", "b")], source, write, lambda n: 7, lambda n: None)
    assert not kept
    with pytest.raises(copy.CopyError, match="page_size"):
        copy.copy_tables([copy.CopySpec("a", "b")], source, write, lambda n: None, options=copy.CopyOptions(page_size=5))
    with pytest.raises(copy.CopyError, match="stopped"):
        slow = lambda df, n: df.select(F.expr("java_method('java.lang.Thread', 'sleep', 20000L)")).collect()
        copy.copy_tables([copy.CopySpec("a", "b")], source, slow, lambda n: None, options=copy.CopyOptions(timeout=1.0))
    back = lambda n: kept[n].where("id <> 1").unionByName(spark.createDataFrame([(8,)], "id long"))
    with pytest.raises(copy.CopyError, match="buckets differ"):  # as many rows, and others
        copy.copy_tables([copy.CopySpec("a", "b", ("id",))], source, write, lambda n: None, back=back)
    found = copy.copy_tables([copy.CopySpec("a", "c", ("id",))], source, write, lambda n: None, back=lambda n: kept[n])
    assert found.tables[0].verified and not copy.copy_tables([copy.CopySpec("a", "d")], source, write, lambda n: None).tables[0].verified


def test_schema_follows_files(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/t.parquet")
    assert queries.table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(2).withColumn("more", F.lit(1)).write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
    assert queries.table(spark, str(tmp_path), "t").columns == ["id", "more"]


def test_circles_are_noticed_at_once(spark):
    ring = spark.range(40).select(F.col("id").alias("parent"), ((F.col("id") + 1) % 40).alias("child"), F.lit("x").alias("kind"))
    with pytest.raises(ValueError, match="circle"):
        manage.levels(ring)
    chain = spark.createDataFrame([(1, 2, "x"), (2, 3, "x"), (1, 3, "x"), (9, 3, "x")], "parent int, child int, kind string")
    assert {r["node"]: r["level"] for r in manage.levels(chain).collect()} == {1: 0, 9: 0, 2: 1, 3: 2}
    assert manage.levels(chain.limit(0)).count() == 0


def test_copy_rules():
    spec = copy.CopySpec
    for specs, clear, paged in (([spec("a", "b"), spec("c", "`B`")], False, False), ([spec("a", "b"), spec("b", "c")], True, False), ([spec("a", "b")], False, True), ([spec("a", "b", winners=("x",))], False, False), ([spec("db.s.t", '"s"."T"')], False, False)):
        with pytest.raises(copy.CopyError):
            copy.check_run(specs, clear, copy.CopyOptions(), paged)
    copy.check_run([spec("a", "b", ("id",))], True, copy.CopyOptions(), True)
    copy.check_run([spec("a", "b")], True, copy.CopyOptions(allow_unordered=True), True)
    for bad in ("page_size", "batch_size", "timeout"):
        with pytest.raises(copy.CopyError):
            copy.CopyOptions(**{bad: 0})
    same = copy.same_place
    assert same("jdbc:postgresql://me:pw@LOCALHOST/db#public.t", "jdbc:postgresql://127.0.0.1:5432/DB#PUBLIC.T")
    assert not same("jdbc:postgresql://h:5433/db#t", "jdbc:postgresql://h/db#t") and not same("/a/b#t", "/a/b#u")
    assert same("file:///tmp/../tmp/x#t", "/tmp/x#T") and same("[dbo].[t]", "T") and not same("a.t", "b.t")
    assert copy.fingerprint([spec("a", "b")]) != copy.fingerprint([spec("a", "b", ("c",))])


def test_planner():
    column = copy.ColumnInfo
    columns = (column("Id", True, True), column("DisplayName"), column("Search", generated=True), column("Gone"))
    table = planner.TableInfo("main", "T", columns)
    into = {planner.normal("dbo.T"): (column("id", True, True), column("Name"))}
    spec, warnings = planner.plan_table(table, planner.PlanOptions(destination_schema="dbo", mappings={"displayname": "Name"}), into)
    assert spec.order_by == ("Id",) and spec.exclusions == ("Id", "Search", "Gone") and spec.mappings == {"DisplayName": "Name"} and warnings == ["MissingDestinationColumn:Gone"]
    kept, _ = planner.plan_table(table, planner.PlanOptions(destination_schema="dbo", keep_identity=True), into)
    assert "Id" not in kept.exclusions
    assert planner.plan_table(planner.TableInfo("s", "e"), planner.PlanOptions())[1] == ["NoSourceColumns", "NoOrderByColumns"]
    none, warnings = planner.plan_table(planner.TableInfo(None, "e", (column("a", generated=True),)), planner.PlanOptions())
    assert warnings == ["NoWritableColumns", "NoOrderByColumns"] and none.destination == "e"
    # single settings: the qualified name first, then without quotes, the bare one, and what a store takes for equal
    odd = planner.TableInfo("s", '"A.b"')
    assert planner.scoped({'s."A.b"': 1, "s.A.b": 2, '"A.b"': 3}, odd) == 1 and planner.scoped({"s.A.b": 2, '"A.b"': 3}, odd) == 2
    assert planner.scoped({'"A.b"': 3}, odd) == 3 and planner.scoped({'S."a.B"': 4}, odd) == 4 and planner.scoped({'S."a.B"': 4}, odd, "lower") is None
    with pytest.raises(copy.CopyError):
        planner.scoped({"S.t": 1, "s.T": 2}, planner.TableInfo("s", "t"))
    assert planner.destination(planner.TableInfo("s", "t"), planner.PlanOptions(tables={"t": "x.y"}, destination_schema="d")) == "x.y"
    assert planner.merged({"A": "1", "b": "2"}, {"a": "3"}) == {"b": "2", "a": "3"}
    assert planner.segments('[a]]b]."c""d".`e`.f') == [("a]b", True), ('c"d', True), ("e", True), ("f", False)]
    for bad in ("a;b", "", "a..b", 'a"b"', "a\nb"):
        with pytest.raises(copy.CopyError):
            planner.segments(bad)
    with pytest.raises(copy.CopyError):
        planner.plan_tables([planner.TableInfo("a", "t"), planner.TableInfo("b", "T")], planner.PlanOptions(destination_schema="d"))
    with pytest.raises(copy.CopyError):
        planner.plan_table(table, planner.PlanOptions(order_by={"T": ("missing",)}))


def test_paging(spark):
    rows = [(k, v) for k in (1, 2, None) for v in (1, None, 3)] * 3
    df = spark.createDataFrame(rows, "k int, v int").withColumn("id", F.monotonically_increasing_id())
    for size in (1, 4, 27, 100):
        found = [tuple(r) for p in paging.pages(df, ["k", "v", "id"], size) for r in p]
        assert found == sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, x) if x is not None else (True, 0) for x in r))
    with pytest.raises(paging.PagingError):
        paging.page(df, [], 5)
    with pytest.raises(paging.PagingError):
        paging.page(df, ["k"], 0)
    assert paging.page(df, [], 5, allow_unordered=True).count() == 5
    pages = {None: paging.Page([1], "a"), "a": paging.Page([], "b"), "b": paging.Page([2, 3])}
    assert list(paging.by_token(pages.get)) == [[1], [], [2, 3]]
    with pytest.raises(paging.PagingError, match="again"):
        list(paging.by_token(lambda t: paging.Page([1], "a")))
    with pytest.raises(paging.PagingError, match="known"):
        list(paging.by_token(pages.get, known=2))
    plan = paging.page(spark.read.parquet(f"{DATA}/orders.parquet"), ["o_orderkey"], 10, Row(o_orderkey=5))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "PushedFilters: [Or(" in plan


def test_no_window_in_one_task(spark):
    """Numbers, tiles and running totals in ranges, with ties, nulls and more ranges than rows."""
    df = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(50)], "a int, id int")
    order = [F.col("a").asc_nulls_last(), F.col("id")]
    want = sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for ranges in (1, 3, 80):
        numbered = ranks.number_rows(df, order, "n", ranges)
        assert [(r["a"], r["id"]) for r in sorted(numbered.collect(), key=lambda r: r["n"])] == want
        sums = {r["id"]: r["running"] for r in ranks.running_total(df, F.col("a"), order, "running", ranges).collect()}
        total = None
        for a, i in want:
            total = total if a is None else (total or 0) + a
            assert sums[i] == total
        for tiles in (1, 7, 50, 60):
            sizes = Counter(r["tile"] for r in ranks.ntile(df, tiles, order, "tile", ranges).collect())
            assert [sizes[t] for t in range(1, tiles + 1)] == [50 // tiles + (t < 50 % tiles) for t in range(tiles)]
    assert ranks.number_rows(df.limit(0), order).count() == 0
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    for made in (ranks.number_rows(df, order, ranges=4), ranks.ntile(df, 3, order, ranges=4), ranks.running_total(df, F.col("a"), order, ranges=4), monitor.pareto(df, "id", F.col("a").cast("decimal(18,2)"), ranges=4)):
        assert plan(made).count("Exchange SinglePartition") <= 2  # the table of ranges, and a total
    with pytest.raises(ValueError):
        aggregates.framed(df, [], order, {"n": F.count("*")})
    near = ranks.near_in_time(spark.range(1).select(F.lit(datetime.datetime(2024, 1, 1, 0, 10)).alias("t")), spark.sql("SELECT explode(array(TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2024-01-01 00:10:00', TIMESTAMP_NTZ '2023-12-31 23:59:59.999')) AS o"), "t", "o", datetime.timedelta(minutes=10))
    assert near.count() == 2


def test_batches(spark):
    rows = [("p1", f"r{i:03d}", 1000) for i in range(205)] + [("p2", "a", 1000), ("p2", "b", 1000)] + [("p3", str(i), 900_000) for i in range(4)] + [("p4", "x", 10), ("p4", "x", 10)]
    df = spark.createDataFrame(rows, "p string, r string, s int")
    found = batches.plan_batches(df, "p", "r", "s", ranges=1).groupBy("partition_key", "batch").count().collect()
    assert Counter((r[0], r[2]) for r in found) == Counter([("p1", 100), ("p1", 100), ("p1", 5), ("p2", 2), *[("p3", 1)] * 4, ("p4", 1), ("p4", 1)])
    schema = "partition_key string, row_key string, properties map<string,string>"
    old, new = spark.createDataFrame([("p", "r", {"a": "1", "b": "2"})], schema), spark.createDataFrame([("p", "r", {"b": "3"}), ("p", "s", {})], schema)
    got = lambda mode: {r["row_key"]: r["properties"] for r in batches.write_entities(old, new, mode).collect()}
    assert got("merge") == {"r": {"a": "1", "b": "3"}, "s": {}} and got("replace") == {"r": {"b": "3"}, "s": {}}
    with pytest.raises(ValueError):
        batches.write_entities(old, new, "add")
    with pytest.raises(Exception, match="comes twice"):
        batches.write_entities(old, new.union(new), "merge").collect()
    assert batches.json_array(df.where("p = 'p2'"), ["r"]).first()[0].startswith('[{"p":"p2","r":"a"')
    with pytest.raises(Exception, match="more than 3 rows"):
        batches.json_array(df, ["r"], 3).collect()
    with pytest.raises(Exception, match="are allowed"):
        batches.plan_batches(df.withColumn("s", F.lit(1_000_001)), "p", "r", "s").collect()


def replayed(rows):
    """Batches by (key, number), each within its bounds; numbers without gaps."""
    found, numbers = {}, {}
    for r in rows:
        found.setdefault((r["partition_key"], r["batch"]), []).append((r["row_key"], r["size"]))
        numbers.setdefault(r["partition_key"], set()).add(r["batch"])
    assert all(n == set(range(len(n))) for n in numbers.values())
    for own in found.values():
        assert len(own) <= batches.ROWS and sum(s for _, s in own) <= batches.BYTES and len({k for k, _ in own}) == len(own)
    return found


def test_batches_in_ranges(spark):
    """A hot key is packed in several tasks, within the same bounds."""
    rows = [("hot" if i % 10 else f"k{i % 30}", f"r{i % 950:04d}", i % 5 * 100_000) for i in range(1900)]
    df = spark.createDataFrame(rows, "p string, r string, s int")
    alone, dealt = (replayed(batches.plan_batches(df, "p", "r", "s", ranges=n).collect()) for n in (1, 8))
    assert sum(map(len, alone.values())) == sum(map(len, dealt.values())) == 1900
    assert len(alone) <= len(dealt) <= len(alone) + 8 * 4


def test_key_batches_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = replayed(queries.QUERIES["key_batches"](spark, DATA).collect())
    assert sum(map(len, found.values())) == docs.count()
    text = {str(r["doc_id"]): r for r in docs.collect()}
    for (lang, _), own in found.items():
        for key, size in own:
            r = text[key]
            assert size == min(batches.ENTITY_BYTES, 4 + 2 * len(lang) + 2 * len(key) + 2 * len(r["text"]) + 4 + 8 + 8 + 2 * len(r["source"]) + 4 + 8 + 12 + 8 + 8 + 14)


def test_json_files(spark, tmp_path):
    df = spark.range(300).select("id", F.when(F.col("id") % 2 == 0, "x\"\n").alias("s"))
    for i, some in enumerate((df, df.limit(1), df.limit(0))):
        batches.write_json_array(some, f"{tmp_path}/{i}", ["id"])
        text = "".join(p.read_text() for p in sorted((tmp_path / str(i)).glob("part-*")))
        assert json.loads(text) == [r.asDict() for r in some.orderBy("id").collect()]


def test_inference(spark):
    df = infer.from_objects(spark, [{"Name": "Alpha"}, {"name": "Beta", "Age": 42}])
    assert df.columns == ["Name", "Age"] and infer.collect(df, "objects")[1] == {"Name": "Beta", "Age": 42}
    assert infer.from_objects(spark, [1, "a", None]).schema["Value"].dataType.simpleString() == "string"
    assert infer.unique_names(["a", "", "A", None]) == ["a", "Column2", "A1", "Column4"]
    assert infer.collect(df, "scalar") == "Alpha" and len(list(infer.collect(df, "stream"))) == 2
    both = infer.from_objects(spark, [{"a": 1, "A": 2}, {"A": 3}])
    assert both.columns == ["a", "A1"] and [tuple(r) for r in both.collect()] == [(1, 2), (None, 3)]
    assert infer.from_objects(spark, [[{"x": 1}, {"x": 2}]]).count() == 2 and infer.from_objects(spark, ["text"]).columns == ["Value"]
    assert infer.from_objects(spark, [{"x": 1}, {"y": 2}], first_row_only=True).columns == ["x"] and infer.from_objects(spark, []).count() == 0
    assert infer.from_objects(spark, [{"x": 1}, {"x": 1.5}]).schema["x"].dataType.simpleString() == "string"  # no widening


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "t.db")
    sqlite.register(spark)
    df = spark.sql("SELECT id, CAST(id AS STRING) AS name, IF(id % 2 = 0, id / 2.0D, NULL) AS half FROM range(1500)")
    assert sqlite.bulk_insert(df, path, "x y") == 1500
    back = files.read(spark, "sqlite", path=path, table="x y", partitions="3")
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, df.collect()))
    assert sqlite3.connect(path).execute('SELECT count(*) FROM "x y"').fetchone() == (1500,)
    # all or nothing: a task that fails late leaves no row of the others
    broken = df.withColumn("name", F.when(F.col("id") == 1499, F.raise_error(F.lit("late"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="late"):
        sqlite.bulk_insert(broken.repartition(4), path, "x y")
    with pytest.raises(Exception, match="late"):
        sqlite.bulk_insert(broken, path, "x y", "overwrite")
    assert back.count() == 1500 and not list(tmp_path.glob("t.db.part-*"))
    assert sqlite.bulk_insert(df.limit(3), path, "x y", "overwrite") == 3 and back.count() == 3
    assert sqlite.bulk_insert(df.limit(0), path, "none") == 0
    with pytest.raises(Exception, match="no table none"):
        files.read(spark, "sqlite", path=path, table="none").count()
    # exact decimals, times, flags; a query, a view, a table without a rowid
    odd = spark.sql("SELECT CAST(1.10 AS DECIMAL(10,2)) AS d, TIMESTAMP_NTZ '2024-01-02 03:04:05' AS t, DATE '2024-01-02' AS y, true AS b, X'00ff' AS x")
    sqlite.bulk_insert(odd, path, "odd")
    assert tuple(files.read(spark, "sqlite", path=path, table="odd").first()) == ("1.10", "2024-01-02 03:04:05", "2024-01-02", 1, b"\x00\xff")
    own = sqlite3.connect(path)
    own.executescript("CREATE TABLE w (k TEXT PRIMARY KEY, v INT) WITHOUT ROWID; INSERT INTO w VALUES ('a', 1), ('b', 2); CREATE VIEW u AS SELECT k, v * 2 AS twice FROM w;")
    own.commit()
    for relation in ({"table": "w"}, {"query": "SELECT * FROM w"}):
        assert sorted(map(tuple, files.read(spark, "sqlite", path=path, partitions="2", **relation).collect())) == [("a", 1), ("b", 2)]
    assert sorted(r["k"] for r in files.read(spark, "sqlite", path=path, table="u").collect()) == ["a", "b"]
    with pytest.raises(Exception, match="table or a query"):
        files.read(spark, "sqlite", path=path).count()


def test_sqlite_maintenance(spark, tmp_path):
    path = str(tmp_path / "t.db")
    own = sqlite3.connect(path)
    own.executescript("PRAGMA journal_mode = WAL; CREATE TABLE p (id INTEGER PRIMARY KEY); CREATE TABLE c (p INT REFERENCES p); INSERT INTO c VALUES (5);")
    own.commit()
    assert sqlite.check(path) == ["c: row 1 has no parent in p"] and sqlite.check(path, quick=True)
    assert sqlite.backup(path, str(tmp_path / "b.db"), pages=1) >= 2
    assert sqlite3.connect(str(tmp_path / "b.db")).execute("SELECT p FROM c").fetchall() == [(5,)]
    assert sqlite.checkpoint(path, "TRUNCATE")[0] == 0
    own.close()
    sqlite.optimize(path, vacuum=True)
    found = {r["name"]: r["value"] for r in sqlite.diagnostics(spark, path).collect()}
    assert found["journal_mode"] == "wal" and int(found["page_size"]) * int(found["page_count"]) == int(found["file_size"])
    with pytest.raises(ValueError):
        sqlite.checkpoint(path, "; DROP")
    with pytest.raises(FileNotFoundError):
        sqlite.check(str(tmp_path / "none.db"))


def test_jdbc(spark):
    url = "jdbc:derby:memory:tests;create=true"
    df = spark.sql("SELECT id AS ID, CAST(id AS STRING) AS NAME FROM range(100)")
    assert jdbc.write(df, url, "T", types={"NAME": "VARCHAR(20)"}) == 100 and jdbc.write(df.limit(5), url, "T", partitions=1) == 5
    assert jdbc.read(spark, url, "T").count() == 105 and jdbc.write(df, url, "T", "overwrite") == 100
    back = jdbc.read(spark, url, "T", column="ID", bounds=(0, 100), partitions=4).where("ID < 10")
    assert back.count() == 10 and "PushedFilters: [*IsNotNull(ID), *LessThan(ID,10)]" in back._jdf.queryExecution().executedPlan().toString()
    assert jdbc.read(spark, url, query="SELECT max(ID) AS M FROM T;").first()[0] == 99
    for bad in (dict(), dict(table="T", query="x"), dict(table="T", partitions=2)):
        with pytest.raises(ValueError):
            jdbc.read(spark, url, **bad)
    text = jdbc.create_table(spark.sql("SELECT 'a' AS `x]y`, 1.5BD AS d, X'00' AS b"), "dbo.t", {"x]y": 20})
    assert text == "CREATE TABLE [dbo].[t] ([x]]y] nvarchar(20) NOT NULL, [d] decimal(2,1) NOT NULL, [b] varbinary(max) NOT NULL)"


def test_files(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, 'x,\"y' AS b UNION ALL SELECT 2, NULL")
    files.write_csv(df, f"{tmp_path}/c", gzip=True)
    back = files.read_csv(spark, f"{tmp_path}/c", "a int, b string", {"origin": "test"})
    assert Counter(map(tuple, back.collect())) == Counter([(1, 'x,"y', "test"), (2, None, "test")])
    with pytest.raises(ValueError):
        files.check_options("jdbc", {"url": "jdbc:x"})
    assert files.shown({"password": "p", "url": "u"}) == {"password": "***", "url": "u"}


def test_streams(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.write.parquet(f"{tmp_path}/in")
    seen = []
    for _ in range(2):  # the second run finds nothing new
        windows.copy_increment(spark, f"{tmp_path}/in", events.schema, f"{tmp_path}/ck", lambda df, _: seen.append(df.count()))
    assert sum(seen) == events.count()
    stream = windows.tumbling(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in"), "ts", "1 hour", ["event_type"], "1 day")
    stream.writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert spark.sql("SELECT sum(n) FROM hourly").first()[0] == events.count()


def test_csv_plans(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("a|b\n1|x\n2|y\n", encoding="utf-8")
    options = files.CsvOptions(delimiter=None)
    plan = files.plan_csv(spark, f"{tmp_path}/in", "a int, b string", f"{tmp_path}/out", options)
    refreshed = []
    done = files.run_csv(spark, plan, lambda df, to: df.write.parquet(to), plan.fingerprint, refreshed.append)
    assert plan.rows == done["rows"] == 2 and refreshed == [f"{tmp_path}/out"] and spark.read.parquet(f"{tmp_path}/out").count() == 2
    (tmp_path / "in/a.csv").write_text("a|b\n1|x\n2|z\n3|z\n")
    with pytest.raises(ValueError, match="changed"):
        files.run_csv(spark, plan, lambda df, to: None)
    (tmp_path / "bad.csv").write_text("a,b\n1,x\nq,y\n")
    load = lambda policy: files.load_csv(spark, f"{tmp_path}/bad.csv", "a int, b string", files.CsvOptions(mismatch=policy))
    with pytest.raises(Exception):
        load("fail").collect()
    assert load("drop").count() == 1 and [r["_corrupt"] for r in load("null").collect()] == [None, "q,y"]
    with pytest.raises(Exception, match="check low failed"):
        files.load_csv(spark, f"{tmp_path}/in", "a int, b string", files.CsvOptions(delimiter="|", checks={"low": "a < 3"})).collect()
    for bad in (dict(mismatch="x"), dict(delimiter="||"), dict(skip_rows=-1)):
        with pytest.raises(ValueError):
            files.CsvOptions(**bad)


def test_providers():
    assert files.provider(" PostgreSQL ") == "jdbc" and files.provider("tsv") == "csv"
    with pytest.raises(ValueError):
        files.provider("abacus")
    assert files.connection_url("postgresql", "h", "d") == "jdbc:postgresql://h:5432/d?sslmode=verify-full"
    assert files.connection_url("sqlserver", "h", "d", 1, encrypt=False) == "jdbc:sqlserver://h:1;databaseName=d;encrypt=false;trustServerCertificate=false"
    for bad in (dict(kind="x"), dict(host="h;x=1"), dict(database=""), dict(password="p"), dict(encrypt=False, trust_server=True)):
        with pytest.raises(ValueError):
            files.connection_url(**{"kind": "mysql", "host": "h", "database": "d", **bad})


def test_late_data_and_state(spark, tmp_path):
    """What a watermark lets pass, and state that outlives a restart."""
    schema = "ts timestamp, k string, v double"
    write = lambda i, rows: spark.createDataFrame([(datetime.datetime(2024, 1, 1, h), k, v) for h, k, v in rows], schema).coalesce(1).write.parquet(f"{tmp_path}/in/b={i}")

    def run(name, stream, mode):
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).foreachBatch(lambda df, i: df.write.mode("append").parquet(f"{tmp_path}/{name}-out")).start().awaitTermination()

    source = lambda: spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
    counts = lambda: windows.tumbling(source(), "ts", "1 hour", ["k"], "2 hours").select(F.col("window.start").alias("start"), "k", "n")
    for i, rows in enumerate([[(1, "a", 1.0), (2, "b", 2.0)], [(9, "a", 3.0)], [(1, "a", 4.0), (8, "b", None)], [(20, "c", 1.0)]]):
        write(i, rows)
        run("late", counts(), "append")
        run("sums", stateful.running_counts(source(), "k", "v"), "update")
    found = Counter((r["start"].hour, r["k"], r["n"]) for r in spark.read.parquet(f"{tmp_path}/late-out").collect())
    assert found == Counter([(1, "a", 1), (2, "b", 1), (8, "b", 1), (9, "a", 1)])  # the row of 1 o'clock came too late
    last = {r["key"]: (r["n"], r["total"]) for r in sorted(spark.read.parquet(f"{tmp_path}/sums-out").collect(), key=lambda r: r["n"])}
    assert last == {"a": (3, 8.0), "b": (2, 2.0), "c": (1, 1.0)}


def test_stateful_changes(spark, tmp_path):
    schema = "ts timestamp, k string, v string"
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (1, "b", "z"), (4, "a", "x")]
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 1, h), k, v) for h, k, v in rows], schema)
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = stateful.changes(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "k", "ts", "v")
    stream.writeStream.format("memory").queryName("changes").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    want = Counter(map(tuple, stateful.batch_changes(df, "k", "ts", "v").collect()))
    assert Counter(map(tuple, spark.sql("SELECT * FROM changes").collect())) == want and sum(want.values()) == 4


def test_pages_cost_one_sort(spark):
    """Jobs of all pages go by ranges of one sort, not by pages; numbers of pages need no driver."""
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"), "id").repartition(5)
    context = spark.sparkContext
    context.setJobGroup("pages", "pages")
    found = list(paging.pages(df, ["k"], 10))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert [len(p) for p in found] == [10] * 300 and [r["k"] for p in found for r in p] == sorted(i * 7919 % 3001 for i in range(3000))
    assert len(context.statusTracker().getJobIdsForGroup("pages")) < 100
    pages = paging.numbered(df, ["k"], 10)
    assert {(r["page"], r["id"]) for r in pages.collect()} == {(n, r["id"]) for n, p in enumerate(found) for r in p}
    assert paging.numbered(df.limit(0), ["k"], 10).count() == 0 and not list(paging.pages(df.limit(0), ["k"], 10))


def test_page_reader_reads_the_whole_table(spark, tmp_path):
    """Pages hold every order: of any customer, of none, without a price, and with equal prices."""
    rows = [(k, None if k % 5 == 0 else k, None if k % 7 == 0 else float(k % 3)) for k in range(1, 1002)]
    orders = "o_orderkey long, o_custkey long, o_totalprice double"
    spark.createDataFrame([(k,) for k in range(1, 1002)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(rows, orders).write.parquet(f"{tmp_path}/orders.parquet")
    assert queries.QUERIES["page_reader"](spark, str(tmp_path)).first() == (1001, 3, 501501)
    none = tmp_path / "none"
    spark.createDataFrame([], "c_custkey long").write.parquet(f"{none}/customer.parquet")
    spark.createDataFrame([], orders).write.parquet(f"{none}/orders.parquet")
    assert queries.QUERIES["page_reader"](spark, str(none)).first() == (0, 0, None)


def test_nested_values(spark):
    df = spark.sql("SELECT named_struct('Name', 'n', 'list', array(named_struct('X', 1), NULL)) AS Item, map('Key', 5, 'other', 6) AS m, NULL AS none, 1 AS dup, '{\"a\": {\"b c\": [1, {\"d\": 2}]}}' AS j")
    at = lambda p: df.select(nested.value_at(df, p).alias("v")).first()["v"]
    assert (at("item.NAME"), at("Item.list[0].x"), at("item.list[1].x"), at("item.list[9].x"), at("M.KEY"), at("m.none")) == ("n", 1, None, None, 5, None)
    for bad in ("item.zzz", "item..name", "dup.x", "item.list.x", "", "item.list["):
        with pytest.raises(ValueError):
            nested.value_at(df, bad)
    assert df.select(nested.json_value(F.col("j"), "a.b c[1].d")).first()[0] == "2"
    assert spark.sql("SELECT map('A', '1', 'b', '2', 'a', '3') AS m").select(nested.renamed_keys(F.col("m"))).first()[0] == {"a": "3", "b": "2"}
    assert spark.sql("SELECT '0xzz' AS s").select(nested.from_hex(F.col("s"))).first()[0] is None


def test_new_builder_verbs(spark):
    text = Query().select("a").from_("t").where_if("x", None).where_if("y", ">", 3).rollup("a").to_sql()[0]
    assert text == "SELECT `a` FROM `t` WHERE `y` > :p0 GROUP BY ROLLUP (`a`)"
    assert "GROUPING SETS ((`a`, `b`), (`a`), ())" in Query().from_("t").grouping_sets(("a", "b"), ("a",), ()).to_sql()[0]
    q = Query().select("a").from_("t").semi_join("u", "a", "b").lateral_join(Query().select("c").from_("v"), "l").except_(Query().from_("w").where_in("x", Query().select("y").from_("z")))
    assert q.tables() == {"t", "u", "v", "w", "z"} and named_in("SELECT * FROM orders JOIN partial") == ("orders",)


def test_monitoring(spark):
    moment = lambda **k: F.lit(datetime.datetime(2024, 1, 10) - datetime.timedelta(**k)).cast("timestamp_ntz")
    now, none = moment(), F.lit(None).cast("timestamp_ntz")
    day, hour = dict(days=1), dict(hours=1)
    ladder = [((none, none, none, moment(hours=2), now, F.lit(True)), "New"), ((none, none, none, moment(days=2), now, F.lit(True)), "MissingFull"), ((none, none, none, none, now, F.lit(True)), "MissingFull"), ((moment(days=1, seconds=1), none, moment(), none, now, F.lit(True)), "FullOverdue"), ((moment(**day), none, none, none, now, F.lit(True)), "LogOverdue"), ((moment(**day), none, none, none, now, F.lit(False)), "Ok"), ((moment(**day), moment(days=2), moment(**hour), none, now, F.lit(True)), "DifferentialOld"), ((moment(**day), moment(**day), moment(**hour), none, now, F.lit(True)), "Ok")]
    for given, want in ladder:
        assert spark.range(1).select(monitor.freshness(*given)).first()[0] == want
    checks = [((none, moment(days=7), F.lit(None), now), "New"), ((none, moment(days=8), F.lit(" "), now), "Missing"), ((moment(days=8), none, F.lit(None), now), "Overdue"), ((moment(days=7), none, F.lit(None), now), "Ok"), ((moment(), none, F.lit("x"), now), "Unknown")]
    for given, want in checks:
        assert spark.range(1).select(monitor.check_status(*given)).first()[0] == want
    assert monitor.snapshot({"x": lambda: spark.range(1)}, connected=lambda: 1 / 0)[1]["connection"].startswith("ZeroDivision")
    assert monitor.availability(*[spark.range(1).select(F.col("id").alias("group_id"), F.col("id").alias("replica_id"), F.lit(None).cast("boolean").alias("is_suspended")).select(*c) for c in (["group_id"], ["group_id", "replica_id"], ["replica_id"], ["replica_id", "is_suspended"])], enabled=False).count() == 0
    with pytest.raises(RuntimeError):
        manage.inventory({"x": lambda: spark.table("nothing")})
    assert set(manage.inventory({"x": lambda: spark.range(2)})) == {"x"}
    texts = manage.copy_texts("a.b", "c", ["id", "v`x"], ["ID"])
    assert texts["merge"] == "MERGE INTO `c` AS t USING (SELECT `id`, `v``x` FROM `a`.`b`) AS s ON t.`ID` <=> s.`ID` WHEN MATCHED THEN UPDATE SET t.`v``x` = s.`v``x` WHEN NOT MATCHED THEN INSERT (`id`, `v``x`) VALUES (s.`id`, s.`v``x`)"
    assert manage.settings(spark, "spark.sql.ansi").count() > 0
    with pytest.raises(ValueError):
        manage.levels(spark.createDataFrame([("a", "b"), ("b", "a")], "parent string, child string"))


def test_operations_stop(spark):
    token = parallel.Token()
    threading.Timer(1.5, token.stop).start()
    began = time.time()
    with pytest.raises(parallel.Cancelled), parallel.operation(spark, "slow", token):
        spark.range(0, 3 * 10**10, 1, 4).selectExpr("sum(id % 7)").collect()
    assert time.time() - began < 20 and spark.range(3).count() == 3
    with pytest.raises(parallel.Cancelled), parallel.operation(spark, "again", token):
        pass
    token, seen = parallel.Token(), []
    with pytest.raises(parallel.Cancelled):
        for row in parallel.stream_rows(spark.range(100), token):
            seen.append(row)
            if len(seen) == 3:
                token.stop()
    assert len(seen) == 3
    calls = []
    with pytest.raises(OSError):
        parallel.with_retry(lambda: calls.append(1) or (_ for _ in ()).throw(OSError()), lambda e: True, changes=True)
    assert len(calls) == 1
    with pytest.raises(KeyError):
        parallel.query(spark, "SELECT :a", {"b": 1})
    df, outputs = parallel.query(spark, "SELECT id FROM range(5) WHERE id > :Low", {"low": "1"}, {"LOW": "bigint"}, {"n": "count(*)", "top": "max(id)"})
    assert outputs == {"n": 3, "top": 4}


@dataclass
class Customer:
    C_CUSTKEY: int
    c_name: str


def test_client(spark, tmp_path):
    own = client.Client(spark)
    spark.read.parquet(f"{DATA}/customer.parquet").createOrReplaceTempView("clients")
    ask = "SELECT c_custkey, c_name FROM clients WHERE c_custkey < :n ORDER BY c_custkey"
    assert own.scalar(ask, {"n": 3}) == 0 and len(own.query(ask, {"n": 3}, "objects")) == 3 and own.query(ask, {"n": 0}, "row") is None
    typed = list(own.rows_as(Customer, ask, {"n": 2}))
    assert typed[1] == Customer(1, "Customer#000000001")

    async def several():
        return await asyncio.gather(own.query_async(ask, {"n": 3}, "objects"), own.query_async("SELECT 1 AS x", shape="scalar"))

    rows, one = asyncio.run(several())
    assert len(rows) == 3 and one == 1

    async def streamed():
        return [r["c_custkey"] async for r in own.stream_async(ask, {"n": 4})]

    assert asyncio.run(streamed()) == [0, 1, 2, 3]
    table = dml.VersionedTable(spark, f"file://{tmp_path}/t")
    table.commit(spark.sql("SELECT 1 AS k, 'a' AS v"))
    assert own.execute(statements.update().set("v", "b").where("k", 1), table) == 1 and own.ping()


def test_catalog_and_rest(spark):
    keys = catalog.Keys({"orders": ("o_orderkey",)}, [], [("orders", ("o_custkey",), "customer", ("c_custkey",))])
    assert keys.index_rows(spark).count() == 1 and keys.foreign_rows(spark).first()["referenced_table"] == "customer"
    assert "NOT NULL" in catalog.create_table_sql(spark.range(1), "a.b") and catalog.databases(spark).count() >= 1
    assert catalog.routines(spark, "abs").count() >= 1 and catalog.tables(spark).columns[0] == "schema"
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "parent string, child string")
    assert catalog.closure(edges).count() == 9
    long = spark.range(150).select(F.col("id").alias("parent"), (F.col("id") + 1).alias("child"))
    assert catalog.closure(long).count() == 150 * 151 // 2  # paths of any length
    assert [r.first()[0] for r in parallel.run_queries(spark, ["SELECT 1", "SELECT 2"])] == [1, 2]
    made, errors = monitor.snapshot({"good": lambda: spark.range(1), "bad": lambda: 1 / 0})
    assert set(made) == {"good"} and "ZeroDivisionError" in errors["bad"]
    assert catalog.ensure_table(spark.range(1), "made_here") and not catalog.ensure_table(spark.range(1), "made_here")
    assert "CREATE TABLE" in catalog.script(spark, "made_here")
    tries = []
    assert parallel.with_retry(lambda: tries.append(1) or (1 / (len(tries) - 1)), lambda e: True, sleep=lambda s: None) == 1
    routines = parallel.Routines()
    routines.register("Total", lambda s, n: ({"rows": s.range(n)}, {"n": n}))
    assert routines.call(spark, "total", n=3)[0]["rows"].count() == 3


@pytest.mark.parametrize("name", ["upsert_merge_all", "upsert_some_columns_all", "insert_if_missing_all"])
@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_upserts_grow_with_the_input(spark, name, size):
    folder = f"/root/testdata/{size}"
    old = queries.table(spark, folder, "customer")
    out = queries.QUERIES[name](spark, folder)
    fresh = out.where("c_name LIKE 'new %'").count()
    n, new = old.count(), old.agg(F.max("c_custkey")).first()[0] // 4  # keys are dense
    assert new >= n // 5 and out.count() == n + new
    assert fresh == (n if name == "upsert_merge_all" else new)
