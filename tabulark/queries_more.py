"""Queries over the driver's tables, continued: statements, copies, plans, catalog, monitoring, sources, streams, functions."""

from __future__ import annotations

import datetime
import os
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import queries  # noqa: F401  registers what comes before
from .functions import convert, user
from .operators import catalog, copy, dml, infer, manage, monitor, paging, parallel, planner, writes
from .plans import statements
from .plans.query import Query
from .registry import ORACLES, QUERIES, built, made, table
from .session import open_tables
from .sources import files, jdbc, sqlite
from .streaming import stateful, windows


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder: in the one that the cluster shares, else (local mode) a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='tabulark-')}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def local_scratch(spark: SparkSession, name: str) -> str:
    """The same as a path of the file system, which the cluster must mount: for stores that are files."""
    path = scratch(spark, name)
    if not path.startswith(("file:", "/")):
        raise ValueError("SQLite needs a mounted shared folder")
    path = "/" + path.removeprefix("file:").lstrip("/")
    os.makedirs(path, exist_ok=True)
    return path


def versioned(spark: SparkSession, folder: str, name: str) -> dml.VersionedTable:
    made_ = dml.VersionedTable(spark, scratch(spark, name))
    made_.commit(table(spark, folder, name))
    return made_


# upserts by their first names, over the whole table
for _name in ("upsert_merge", "upsert_some_columns", "insert_if_missing"):
    QUERIES[_name], ORACLES[_name] = QUERIES[f"{_name}_all"], ORACLES[f"{_name}_all"]


# statements and write plans
@made("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 1000 OR c_custkey = 7 THEN 0.5 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE NOT (c_mktsegment LIKE 'M%' AND c_custkey <> 7)")
def statements_run(spark: SparkSession, folder: str) -> DataFrame:
    """An update, a delete and their predicates, one version after another."""
    target = versioned(spark, folder, "customer")
    statements.update().set("c_acctbal", 0.5).matching(Query().begin_group().where("c_mktsegment", "BUILDING").where("c_acctbal", "<", 1000).end_group().or_where("c_custkey", 7)).run(spark, target)
    statements.delete().where("c_mktsegment", "LIKE", "M%").where("c_custkey", "<>", 7).run(spark, target)
    return target.read().select("c_custkey", "c_acctbal", "c_mktsegment")


@made("SELECT * FROM (SELECT 'insert' AS verb, 2 AS n) UNION ALL SELECT 'update', count(*) FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'delete', count(*) FROM nation WHERE n_regionkey = 2 UNION ALL SELECT 'upsert', 1 UNION ALL SELECT 'missing', 0 UNION ALL SELECT 'left', count(*) + 2 FROM nation WHERE n_regionkey <> 2")
def affected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What each statement says it changed."""
    target = versioned(spark, folder, "nation")
    said = [
        ("insert", statements.insert_into("n_nationkey", "n_name").values(100, "ATLANTIS").values(101, None).run(spark, target)),
        ("update", statements.update().set("n_name", "x").where("n_regionkey", 1).run(spark, target)),
        ("delete", statements.delete().where("n_regionkey", 2).run(spark, target)),
        ("upsert", statements.insert_or_update({"n_nationkey": 100, "n_name": "LEMURIA"}, ("N_NATIONKEY",)).run(spark, target)),
        ("missing", statements.insert_or_update({"n_nationkey": 101, "n_name": "MU"}, ("n_nationkey",)).update_only().run(spark, target)),
    ]
    said.append(("left", target.read().count()))
    return spark.createDataFrame(said, "verb string, n long")


@made("SELECT n_nationkey, CASE WHEN n_nationkey < 3 THEN 'N' || n_nationkey ELSE n_name END AS n_name, CASE WHEN n_nationkey < 3 THEN 9 ELSE n_regionkey END AS n_regionkey FROM nation UNION ALL SELECT 500, 'N500', 9")
def write_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Objects written by a plan: members found by path in any case, what they lack from around them, matched by key."""
    target = versioned(spark, folder, "nation")
    plan = writes.write_plan(["n_nationkey", "n_name", "n_regionkey"], {"N_NAME": "info.names.0", "n_nationkey": "Key", "n_regionkey": "region"}, ["n_nationkey"])
    plan.run(spark, target, [{"key": k, "Info": {"Names": [f"N{k}"]}} for k in (0, 1, 2, 500)], {"Region": 9})
    return target.read()


@made("SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS priority, coalesce(CASE WHEN o_totalprice > 250000 THEN o_totalprice END, -1.0) AS price, 'batch-7' AS load FROM orders")
def ambient_values(spark: SparkSession, folder: str) -> DataFrame:
    """An item's value, else the ambient one."""
    df = table(spark, folder, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"), F.when(F.col("o_totalprice") > 250000, F.col("o_totalprice")).alias("price"))
    return writes.with_ambient(df, {"PRIORITY": "none", "price": -1.0, "load": "batch-7"})


@made("SELECT c_custkey AS id, c_name AS name, coalesce(nullif(c_nationkey, 3), -1) AS nation FROM customer")
def bulk_options(spark: SparkSession, folder: str) -> DataFrame:
    """Mappings, a constraint that holds, a default for nulls."""
    df = table(spark, folder, "customer").select("c_custkey", "c_name", F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"))
    return writes.prepared(df, writes.BulkOptions({"C_CUSTKEY": "id", "c_name": "name", "c_nationkey": "nation"}, {"positive": "id >= 0"}, {"nation": -1}, keep_nulls=False))


@made("SELECT n_nationkey AS nationkey, n_name AS \"Name\" FROM nation")
def folded_names(spark: SparkSession, folder: str) -> DataFrame:
    return writes.folded_names(table(spark, folder, "nation").select(F.col("n_nationkey").alias("NationKey"), F.col("n_name").alias('"Name"')))


@made("SELECT 'customer' AS table_name, count(*) AS n, CAST(sum(CASE WHEN c_nationkey = 1 THEN 1 ELSE 0 END) AS BIGINT) AS moved FROM customer UNION ALL SELECT 'nation', count(*), 0 FROM nation")
def transaction(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables change together; a block that fails changes neither."""
    people, nations = versioned(spark, folder, "customer"), versioned(spark, folder, "nation")
    with dml.Transaction() as both:
        both.write(people, dml.update(people.read(), {"c_name": F.lit("moved")}, F.col("c_nationkey") == 1))
        both.write(nations, nations.read())
    try:
        with dml.Transaction() as lost:
            lost.write(people, people.read().limit(0))
            raise InterruptedError
    except InterruptedError:
        pass
    count = lambda t, n: t.read().agg(F.lit(n).alias("table_name"), F.count("*").alias("n"), F.count_if(F.col("c_name") == "moved").alias("moved") if n == "customer" else F.lit(0).cast("long").alias("moved"))
    return count(people, "customer").unionByName(count(nations, "nation"))


@made("SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_nationkey = 4 UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey <> 4")
def generated_merge(spark: SparkSession, folder: str) -> DataFrame:
    """A merge whose keys and updates come from declared keys: identities aren't updated."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    keys, changed = dml.key_columns(["c_custkey"], customer.columns, ["c_name"])
    new = customer.where("c_nationkey = 4").withColumns({"c_name": F.lit("not written"), "c_acctbal": F.col("c_acctbal") + 1})
    return dml.merge(customer, new, keys, changed).select("c_custkey", "c_name", "c_acctbal")


@made("SELECT segment AS partition_key, k AS row_key, CASE WHEN p = 'name' AND k % 2 = 0 THEN 'new' WHEN p = 'name' THEN name ELSE nation END AS value, p AS property FROM (SELECT c_mktsegment AS segment, c_custkey AS k, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer), (VALUES ('name'), ('nation')) AS x(p) WHERE NOT (p = 'nation' AND k % 4 = 0)")
def entity_upserts(spark: SparkSession, folder: str) -> DataFrame:
    """Entities merged (what the new one lacks stays) and then replaced (it stands alone)."""
    keys = [F.col("c_mktsegment").alias("partition_key"), F.col("c_custkey").alias("row_key")]
    customer = table(spark, folder, "customer")
    from .operators import batches

    old = customer.select(*keys, F.create_map(F.lit("name"), F.col("c_name"), F.lit("nation"), F.col("c_nationkey").cast("string")).alias("properties"))
    new = lambda k: customer.where(F.col("c_custkey") % k == 0).select(*keys, F.create_map(F.lit("name"), F.lit("new")).alias("properties"))
    both = batches.write_entities(batches.write_entities(old, new(2), "merge"), new(4), "replace")
    return both.select("partition_key", "row_key", F.explode("properties").alias("property", "value"))


# copies
SOURCE = planner.TableInfo("main", "ProbeResults", (copy.ColumnInfo("ResultId", True, True), copy.ColumnInfo("DisplayName"), copy.ColumnInfo("IsMaintenance"), copy.ColumnInfo("SearchName", generated=True), copy.ColumnInfo("__MigrationRowId")))
TARGET = planner.TableInfo("dbo", "ProbeResults", (copy.ColumnInfo("ResultId", True, True), copy.ColumnInfo("ProbeDisplayName"), copy.ColumnInfo("IsMaintenance"), copy.ColumnInfo("SearchName", generated=True)))


@made("SELECT * FROM (VALUES ('main.ProbeResults', 'dbo.ProbeResults', 'ResultId', 'DisplayName=ProbeDisplayName', 'ResultId,SearchName,__MigrationRowId', ''), ('main.Other', 'dbo.Renamed', '', 'a=b', '', 'main.Other:NoOrderByColumns')) AS t(source, destination, order_by, mappings, exclusions, warnings)")
def copy_plans(spark: SparkSession, folder: str) -> DataFrame:
    """Plans from metadata: a view and another schema's table are left out, single settings win over general ones."""
    tables = [SOURCE, planner.TableInfo("main", "ProbeResultsView", (copy.ColumnInfo("Id"),), view=True), planner.TableInfo("main", "Other", (copy.ColumnInfo("a"),)), planner.TableInfo("aside", "Other", (copy.ColumnInfo("a"),))]
    options = planner.PlanOptions(schema="MAIN", destination_schema="dbo", tables={"main.other": "Renamed"}, mappings={"displayname": "ProbeDisplayName", "a": "c"}, scoped_mappings={"Other": {"A": "b"}}, scoped_exclusions={'"main"."ProbeResults"': ("__MigrationRowId",)})
    specs, warnings = planner.plan_tables(tables, options, [TARGET, planner.TableInfo("dbo", "Renamed", (copy.ColumnInfo("b"),))])
    rows = [(s.source, s.destination, ",".join(s.order_by), ",".join(f"{k}={v}" for k, v in s.mappings.items()), ",".join(s.exclusions), ",".join(w for w in warnings if w.startswith(s.source))) for s in specs]
    return spark.createDataFrame(rows, "source string, destination string, order_by string, mappings string, exclusions string, warnings string")


@made("SELECT 'orders' AS source, count(*) AS source_rows, count(*) AS copied_rows, count(*) AS destination_rows, true AS verified FROM orders UNION ALL SELECT 'events', count(*), count(*), count(*), true FROM (SELECT DISTINCT lower(event_type), user_id FROM events) UNION ALL SELECT 'gone', 0, 0, 0, true")
def copy_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A run of three tables: one as it is, one deduplicated, one that isn't there; counted by the writes."""
    root = scratch(spark, "copies")

    def read(name: str) -> DataFrame:
        if name == "gone":
            raise FileNotFoundError(name)
        return table(spark, folder, name)

    specs = [copy.CopySpec("orders", "a", ("o_orderkey",), {"o_orderkey": "id"}, ("o_orderpriority",)), copy.CopySpec("events", "b", dedupe_keys=("event_type", "user_id"), ignore_case=True, winners=("ts",)), copy.CopySpec("gone", "c")]
    found = copy.copy_tables(specs, read, lambda df, name: df.write.mode("append").parquet(f"{root}/{name}"), lambda name: spark.read.parquet(f"{root}/{name}").count(), clear=lambda name: None, options=copy.CopyOptions(missing_is_empty=True))
    return found.rows(spark).select("source", "source_rows", "copied_rows", "destination_rows", "verified")


@made("SELECT o_orderkey, o_totalprice FROM orders")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as compressed CSV and back with their types, by a plan that is checked again before it runs."""
    root = scratch(spark, "csv")
    files.write_csv(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), f"{root}/out", gzip=True)
    plan = files.plan_csv(spark, f"{root}/out", "o_orderkey bigint, o_totalprice double", f"{root}/loaded")
    files.run_csv(spark, plan, lambda df, to: df.write.parquet(to), plan.fingerprint)
    return spark.read.parquet(f"{root}/loaded")


@made("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_name END AS name, CAST('2024-01-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') AS DATE) AS day, 'static' AS origin FROM nation")
def csv_options(spark: SparkSession, folder: str) -> DataFrame:
    """A file with a line before its header, comments, another delimiter and dates, and tokens for null."""
    root, nation = scratch(spark, "csv"), table(spark, folder, "nation")
    k = F.col("n_nationkey")
    line = F.concat_ws(";", k.cast("string"), F.when(k % 6 == 0, "N/A").when(k % 6 == 3, "-").otherwise(F.col("n_name")), F.concat(F.lpad((k + 1).cast("string"), 2, "0"), F.lit("/01/2024")))
    body = nation.select(k.alias("at"), line.alias("line"))
    head = spark.createDataFrame([(-3, "made by hand"), (-2, "k;name;day"), (-1, "# nothing")], "at int, line string")
    head.unionByName(body).coalesce(1).sortWithinPartitions("at").select("line").write.text(f"{root}/in")
    options = files.CsvOptions(delimiter=None, comment="#", skip_rows=1, null_tokens=("N/A", "-"), date_format="dd/MM/yyyy", static={"origin": "static"}, checks={"key": "k >= 0"})
    return files.load_csv(spark, f"{root}/in", "k int, name string, day date", options)


@made("SELECT c_custkey, c_name, c_acctbal, c_custkey % 2 = 0 AS even FROM customer WHERE c_acctbal > 0")
def sqlite_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Customers into SQLite, in one transaction, and a query over them back."""
    path = f"{local_scratch(spark, 'sqlite')}/t.db"
    sqlite.bulk_insert(table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal"), path, "customers of ours")
    found = files.read(spark, "sqlite", path=path, query='SELECT c_custkey, c_name, c_acctbal, c_custkey % 2 = 0 AS even FROM "customers of ours" WHERE c_acctbal > 0')
    return found.withColumn("even", convert.convert(F.col("even"), found.schema["even"].dataType, "boolean"))


@made("SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 1000")
def jdbc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers into a JDBC store (in memory, local mode) and back in ranges; the filter is pushed down."""
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    jdbc.write(table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal"), url, "SUPPLIER", types={"s_name": "VARCHAR(100)"})
    top = jdbc.read(spark, url, query="SELECT max(\"s_suppkey\") AS TOP FROM SUPPLIER").first()[0]
    return jdbc.read(spark, url, "SUPPLIER", column="s_suppkey", bounds=(0, top), partitions=4).where("s_acctbal > 1000")


@made("SELECT CAST(n % 3 AS VARCHAR) AS \"PartitionKey\", CAST(n AS VARCHAR) AS \"RowKey\", n AS \"Value\", NULL::VARCHAR AS \"Note\" FROM range(20) AS t(n) WHERE n % 2 = 0")
def paged_entities(spark: SparkSession, folder: str) -> DataFrame:
    """A paged store of numbers by remainder: pages of up to three, some of them empty."""

    class Numbers(paging.EntityStore):
        def partition_keys(self) -> list[str]:
            return ["0", "1", "2"]

        def fetch(self, partition_key: str, filter_: str | None, select: list[str], token: str | None) -> paging.Page:
            at = int(token or 0)
            rows = [{"PartitionKey": partition_key, "RowKey": str(n), "Value": n} for n in range(at, min(at + 3, 20)) if n % 3 == int(partition_key) and (not filter_ or n % 2 == 0)]
            return paging.Page(rows, str(at + 3) if at + 3 < 20 else None)

    return paging.entities(spark, Numbers(), "Value bigint, Note string", filter_="even")


@made("SELECT CAST(count(*) AS BIGINT) AS rows, CAST(ceil(count(*) / 400.0) AS BIGINT) AS pages, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders")
def page_reader(spark: SparkSession, folder: str) -> DataFrame:
    """All pages of a table that has no index but its order."""
    found = paging.numbered(table(spark, folder, "orders").select("o_totalprice", "o_orderkey"), ["o_totalprice", "o_orderkey"], 400)
    each = found.groupBy("page").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("pages"), F.sum("total").alias("total"))


# catalog
KEYS = catalog.Keys({"orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_linenumber"), "customer": ("c_custkey",)}, [("orders", "by_date", ("o_orderdate DESC", "o_custkey"), False)], [("orders", ("o_custkey",), "customer", ()), ("lineitem", ("l_orderkey",), "orders", ("o_orderkey",))], {"by_date": {"included": ("o_totalprice",), "filter": "o_orderstatus = 'O'"}, "fk_orders_o_custkey": {"on_delete": "CASCADE"}})


@made("SELECT * FROM (VALUES ('customer', 'pk_customer', 'c_custkey', 1, true, true, false, false, NULL), ('lineitem', 'pk_lineitem', 'l_orderkey', 1, true, true, false, false, NULL), ('lineitem', 'pk_lineitem', 'l_linenumber', 2, true, true, false, false, NULL), ('orders', 'pk_orders', 'o_orderkey', 1, true, true, false, false, NULL), ('orders', 'by_date', 'o_orderdate', 1, false, false, true, false, 'o_orderstatus = ''O'''), ('orders', 'by_date', 'o_custkey', 2, false, false, false, false, 'o_orderstatus = ''O'''), ('orders', 'by_date', 'o_totalprice', 3, false, false, false, true, 'o_orderstatus = ''O''')) AS t(table_name, index_name, column_name, ordinal, is_unique, is_primary_key, descending, included, filter)")
def catalog_indexes(spark: SparkSession, folder: str) -> DataFrame:
    return KEYS.index_rows(spark)


@made("SELECT * FROM (VALUES ('fk_orders_o_custkey', 'orders', 'o_custkey', 'customer', 'c_custkey', 1, 'CASCADE'), ('fk_lineitem_l_orderkey', 'lineitem', 'l_orderkey', 'orders', 'o_orderkey', 1, 'NO ACTION')) AS t(constraint_name, table_name, column_name, referenced_table, referenced_column, ordinal, on_delete)")
def catalog_foreign_keys(spark: SparkSession, folder: str) -> DataFrame:
    return KEYS.foreign_rows(spark)


@made("SELECT 'pk_orders' AS constraint_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1) UNION ALL SELECT 'pk_lineitem', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'pk_customer', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey HAVING count(*) > 1) UNION ALL SELECT 'fk_orders_o_custkey', count(*) FROM orders ANTI JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey UNION ALL SELECT 'fk_lineitem_l_orderkey', count(*) FROM lineitem ANTI JOIN orders ON l_orderkey = o_orderkey")
def key_violations(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows break each declared key, with some customers left out."""
    frames = {n: table(spark, folder, n) for n in ("orders", "lineitem")}
    return KEYS.violations(frames | {"customer": table(spark, folder, "customer").where("c_acctbal > 0")}).unionByName(spark.createDataFrame([], "constraint_name string, rows long")).transform(lambda df: df.where("constraint_name <> 'pk_customer'").unionByName(KEYS.violations({"customer": table(spark, folder, "customer")})))


@made("SELECT 'orders' AS table_name, name AS column_name, CAST(o AS INT) AS ordinal, kind AS data_type, true AS nullable, p AS is_primary_key FROM (VALUES ('o_orderkey', 1, 'bigint', true), ('o_custkey', 2, 'bigint', false), ('o_orderstatus', 3, 'string', false), ('o_totalprice', 4, 'double', false), ('o_orderdate', 5, 'timestamp_ntz', false), ('o_orderpriority', 6, 'string', false)) AS t(name, o, kind, p)")
def catalog_types(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.columns(table(spark, folder, "orders"), "orders", ("o_orderkey",)).select("table_name", "column_name", "ordinal", "data_type", "nullable", "is_primary_key")


@made("SELECT name, is_view FROM (VALUES ('nation', true), ('region', true)) AS t(name, is_view)")
def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    open_tables(spark, folder, ("nation", "region"))
    return catalog.tables(spark).where(F.col("name").isin("nation", "region") & F.col("temporary")).select("name", F.col("temporary").alias("is_view"))


@made("WITH RECURSIVE e AS (SELECT n_nationkey AS parent, n_nationkey * 2 + 1 AS child FROM nation WHERE n_nationkey * 2 + 1 < 25 UNION ALL SELECT n_nationkey, n_nationkey * 2 + 2 FROM nation WHERE n_nationkey * 2 + 2 < 25), r AS (SELECT 1 AS node, 0 AS depth UNION ALL SELECT child, depth + 1 FROM r JOIN e ON node = parent) SELECT node, CAST(depth AS INT) AS depth FROM r")
def reachable_nodes(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("n_nationkey")
    edges = table(spark, folder, "nation").select(k.alias("parent"), F.explode(F.array(k * 2 + 1, k * 2 + 2)).alias("child")).where("child < 25")
    return catalog.reachable(edges, spark.sql("SELECT 1 AS node"))


@made("WITH RECURSIVE e AS (SELECT n_regionkey AS parent, n_nationkey AS child FROM nation WHERE n_regionkey < n_nationkey UNION ALL SELECT n_nationkey, n_nationkey + 5 FROM nation WHERE n_nationkey + 5 < 25), r AS (SELECT parent AS node, 0 AS level FROM e UNION SELECT child, level + 1 FROM r JOIN e ON node = parent) SELECT node, CAST(max(level) AS INT) AS level FROM r GROUP BY node")
def dependency_levels(spark: SparkSession, folder: str) -> DataFrame:
    """The order in which things that depend on each other can be made."""
    nation = table(spark, folder, "nation")
    own = nation.where("n_regionkey < n_nationkey").select(F.col("n_regionkey").alias("parent"), F.col("n_nationkey").alias("child"), F.lit("region").alias("kind"))
    more = nation.where("n_nationkey + 5 < 25").select(F.col("n_nationkey").alias("parent"), (F.col("n_nationkey") + 5).alias("child"), F.lit("next").alias("kind"))
    return manage.levels(manage.dependencies(own, more))


# monitoring: customers stand for databases and jobs, their orders for backups, checks and runs
AS_OF = "TIMESTAMP '2001-06-01'"
DATABASES = "SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 9 = 0 THEN TIMESTAMP '2001-05-20' ELSE TIMESTAMP '1990-01-01' END AS created, CASE c_mktsegment WHEN 'BUILDING' THEN 'FULL' WHEN 'MACHINERY' THEN 'SIMPLE' ELSE 'BULK_LOGGED' END AS recovery_model FROM customer"
AGES = monitor.Ages(datetime.timedelta(days=400), datetime.timedelta(days=300), datetime.timedelta(days=700), datetime.timedelta(days=500))


def databases(spark: SparkSession, folder: str) -> DataFrame:
    open_tables(spark, folder, ("customer",))
    return spark.sql(DATABASES.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))


@made(f"WITH d AS ({DATABASES}), b AS (SELECT o_custkey AS k, max(CASE WHEN o_orderstatus = 'F' AND o_custkey % 7 > 1 THEN o_orderdate END) AS f, max(CASE WHEN o_orderstatus = 'O' AND o_custkey % 5 > 0 THEN o_orderdate END) AS i, max(CASE WHEN o_orderstatus = 'P' THEN o_orderdate END) AS l FROM orders GROUP BY 1) SELECT name, CASE WHEN f IS NULL AND created >= {AS_OF} - INTERVAL 400 DAYS THEN 'New' WHEN f IS NULL THEN 'MissingFull' WHEN f < {AS_OF} - INTERVAL 400 DAYS THEN 'FullOverdue' WHEN recovery_model IN ('FULL', 'BULK_LOGGED') AND (l IS NULL OR l < {AS_OF} - INTERVAL 700 DAYS) THEN 'LogOverdue' WHEN i < {AS_OF} - INTERVAL 300 DAYS THEN 'DifferentialOld' ELSE 'Ok' END AS status FROM d LEFT JOIN b USING (k)")
def freshness_status(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", F.when(F.col("o_custkey") % 7 > 1, "D")).when(F.col("o_orderstatus") == "O", F.when(F.col("o_custkey") % 5 > 0, "I")).otherwise("L")
    made_ = databases(spark, folder)
    backups = orders.select(F.col("o_custkey").alias("k"), kind.alias("type"), F.col("o_orderdate").alias("finished")).join(made_.select("k", "name"), "k")
    return monitor.backup_freshness(made_, backups, F.expr(AS_OF.replace("TIMESTAMP", "TIMESTAMP_NTZ")), AGES).select("name", "status")


@made(f"WITH d AS ({DATABASES}), c AS (SELECT o_custkey AS k, max(CASE WHEN o_orderpriority <> '1-URGENT' AND o_custkey % 4 > 0 THEN o_orderdate END) AS good, max({{'t': o_orderdate, 'e': CASE WHEN o_orderpriority = '1-URGENT' THEN 'failed' WHEN o_custkey % 4 = 0 THEN 'x' ELSE '' END}}).e AS error FROM orders WHERE o_custkey % 11 > 0 GROUP BY 1) SELECT name, CASE WHEN trim(coalesce(error, '')) <> '' THEN 'Unknown' WHEN good IS NULL AND created >= {AS_OF} - INTERVAL 500 DAYS THEN 'New' WHEN good IS NULL THEN 'Missing' WHEN good < {AS_OF} - INTERVAL 500 DAYS THEN 'Overdue' ELSE 'Ok' END AS status FROM d LEFT JOIN c USING (k)")
def check_freshness(spark: SparkSession, folder: str) -> DataFrame:
    made_ = databases(spark, folder)
    error = F.when(F.col("o_orderpriority") == "1-URGENT", "failed").when(F.col("o_custkey") % 4 == 0, "x")
    checks = table(spark, folder, "orders").where("o_custkey % 11 > 0").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("finished"), error.alias("error")).join(made_.select("k", "name"), "k")
    return monitor.check_freshness(made_, checks, F.expr(AS_OF.replace("TIMESTAMP", "TIMESTAMP_NTZ")), AGES).select("name", "status")


@made("SELECT c_name AS name, CASE WHEN c_acctbal < 0 THEN 'READ_ONLY' ELSE 'READ_WRITE' END AS read_write, CASE c_nationkey WHEN 1 THEN 'OFFLINE' ELSE 'ONLINE' END AS state FROM customer WHERE c_name NOT IN ('Customer#000000001', 'Customer#000000005')")
def database_states(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "customer").select(F.col("c_name").alias("name"), F.when(F.col("c_nationkey") == 1, "OFFLINE").otherwise("ONLINE").alias("state"), (F.col("c_acctbal") < 0).alias("is_read_only"))
    return monitor.database_states(found, system=("Customer#000000001", "Customer#000000005")).select("name", "read_write", "state")


@made("WITH h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS k FROM orders WHERE o_orderkey % 2 = 0) WHERE k = 1), s AS (SELECT * FROM (SELECT user_id, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS k FROM events WHERE event_type <> 'view' AND hour(ts) = (SELECT max(hour(ts)) FROM events)) WHERE k = 1) SELECT c_name AS name, r_name AS category, coalesce(s.event_type = 'click', false) AS is_running, CASE WHEN s.event_type = 'click' THEN s.ts END AS current_start, CASE h.o_orderkey % 6 WHEN 0 THEN 'Failed' WHEN 1 THEN 'Succeeded' WHEN 2 THEN 'Retry' WHEN 3 THEN 'Cancelled' WHEN 4 THEN 'InProgress' END AS last_outcome, h.o_orderdate AS last_run, CASE WHEN h.o_orderkey IS NOT NULL THEN (h.o_orderkey % 7) * 3600 + 5 * 60 + 9 END AS last_seconds FROM customer LEFT JOIN region ON c_nationkey = r_regionkey LEFT JOIN h ON h.o_custkey = c_custkey LEFT JOIN s ON s.user_id = c_custkey WHERE c_acctbal > 0")
def job_health(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders, events = (table(spark, folder, n) for n in ("customer", "orders", "events"))
    jobs = customer.select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("category_id"), (F.col("c_acctbal") > 0).alias("enabled"))
    categories = table(spark, folder, "region").select(F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("category"))
    key = F.col("o_orderkey")
    history = orders.select(F.col("o_custkey").alias("job_id"), key.alias("instance_id"), (key % 2).alias("step_id"), (key % 6).cast("int").alias("run_status"), F.col("o_orderdate").alias("run_at"), (key % 7 * 10000 + 509).alias("run_clock"))
    ts = F.col("ts")
    activity = events.select(F.col("user_id").alias("job_id"), F.hour(ts).alias("session_id"), F.when(F.col("event_type") != "view", ts).alias("started"), F.when(F.col("event_type") != "click", ts).alias("stopped"))
    return monitor.job_health(jobs, categories, history, activity).select("name", "category", "is_running", "current_start", "last_outcome", "last_run", "last_seconds")


@made("SELECT r_name AS name, n_name AS replica, CASE WHEN n_nationkey % 4 > 0 THEN 'CONNECTED' END AS state, s_name AS database, coalesce(s_acctbal < 0, false) AS is_suspended FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal < 5000")
def availability(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    groups = table(spark, folder, "region").select(F.col("r_regionkey").alias("group_id"), F.col("r_name").alias("name"))
    replicas = nation.select(F.col("n_regionkey").alias("group_id"), F.col("n_nationkey").alias("replica_id"), F.col("n_name").alias("replica"))
    states = nation.where("n_nationkey % 4 > 0").select(F.col("n_nationkey").alias("replica_id"), F.lit("CONNECTED").alias("state"))
    each = table(spark, folder, "supplier").where("s_acctbal < 5000").select(F.col("s_nationkey").alias("replica_id"), F.col("s_name").alias("database"), (F.col("s_acctbal") < 0).alias("is_suspended"))
    return monitor.availability(groups, replicas, states, each).select("name", "replica", "state", "database", "is_suspended")


@made("SELECT 'customers' AS section, (SELECT count(*) FROM customer) AS n, NULL::VARCHAR AS error UNION ALL SELECT 'broken', NULL, 'failed' UNION ALL SELECT 'late', NULL, 'failed'")
def monitoring_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Sections with their errors, also those that show only when a section runs."""
    customer = table(spark, folder, "customer")
    late = lambda: customer.select(F.when(F.col("c_custkey") >= 0, F.raise_error(F.lit("late"))).alias("x"))
    found, errors = monitor.snapshot({"customers": lambda: customer, "broken": lambda: customer.select("nothing"), "late": late})
    rows = [(n, df.count(), None) for n, df in found.items()] + [(n, None, "failed") for n in errors]
    return spark.createDataFrame(rows, "section string, n long, error string")


@made("SELECT event_type, round(100.0::DOUBLE * amount::DOUBLE / nullif(sum(amount) OVER (), 0)::DOUBLE, 6) AS pct FROM (SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount FROM events GROUP BY 1)")
def total_shares(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.shares(table(spark, folder, "events"), "event_type", F.col("value").cast("decimal(18,2)")).select("event_type", F.round("pct", 6).alias("pct"))


@made(f"SELECT o_orderkey, CAST(date_diff('second', o_orderdate, {AS_OF}) AS BIGINT) AS age FROM orders")
def ages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", monitor.age(F.col("o_orderdate"), F.expr(AS_OF.replace("TIMESTAMP", "TIMESTAMP_NTZ"))).alias("age"))


# management
@made("SELECT c_name AS job_name, o_orderkey AS step_id, CASE o_orderkey % 5 WHEN 1 THEN 'QuitWithSuccess' WHEN 2 THEN 'QuitWithFailure' WHEN 3 THEN 'GoToNextStep' WHEN 4 THEN 'GoToStep' ELSE '0' END AS on_success FROM orders JOIN customer ON o_custkey = c_custkey")
def job_steps(spark: SparkSession, folder: str) -> DataFrame:
    jobs = table(spark, folder, "customer").select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("name"))
    steps = table(spark, folder, "orders").select(F.col("o_custkey").alias("job_id"), F.col("o_orderkey").alias("step_id"), (F.col("o_orderkey") % 5).alias("on_success"), F.lit(1).alias("on_fail"))
    return manage.job_steps(steps, jobs).select("job_name", "step_id", "on_success")


@made("SELECT n_name AS schedule_name, s_name AS job_name FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey WHERE n_regionkey > 0")
def job_schedules(spark: SparkSession, folder: str) -> DataFrame:
    nation, supplier = table(spark, folder, "nation"), table(spark, folder, "supplier")
    schedules = nation.select(F.col("n_nationkey").alias("schedule_id"), F.col("n_name").alias("schedule_name"), (F.col("n_regionkey") > 0).alias("enabled"))
    links = supplier.select(F.col("s_nationkey").alias("schedule_id"), F.col("s_suppkey").alias("job_id"))
    return manage.job_schedules(schedules, links, supplier.select(F.col("s_suppkey").alias("job_id"), F.col("s_name").alias("name")), include_disabled=False).select("schedule_name", "job_name")


@made("SELECT c_name AS name, r_name AS category, c_mktsegment AS description FROM customer LEFT JOIN region ON c_nationkey = r_regionkey WHERE c_acctbal > 0")
def agent_jobs(spark: SparkSession, folder: str) -> DataFrame:
    jobs = table(spark, folder, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("category_id"), F.col("c_mktsegment").alias("description"), (F.col("c_acctbal") > 0).alias("enabled"))
    categories = table(spark, folder, "region").select(F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("category"))
    return manage.jobs(jobs, categories, include_disabled=False).select("name", "category", "description")


@made("SELECT c_name AS name, 'person' AS type, CASE WHEN s_suppkey IS NOT NULL THEN s_acctbal < 0 END AS is_disabled FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey WHERE c_nationkey <> 5 AND c_custkey % 10 <> 9 UNION ALL SELECT s_name, 'login', s_acctbal < 0 FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 9)")
def principals(spark: SparkSession, folder: str) -> DataFrame:
    """Principals with their logins, and logins of no principal; fixed roles left out."""
    people = table(spark, folder, "customer").where("c_custkey % 10 <> 9").select(F.col("c_custkey").alias("principal_id"), F.col("c_name").alias("name"), F.lit("person").alias("type"), (F.col("c_nationkey") == 5).alias("is_fixed_role"))
    logins = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("principal_id"), F.col("s_name").alias("name"), F.lit("login").alias("type"), (F.col("s_acctbal") < 0).alias("is_disabled"))
    return manage.principals(people, logins).select("name", "type", "is_disabled")


@made("SELECT n_name AS role, c_name AS member FROM customer JOIN nation ON c_nationkey = n_nationkey")
def role_members(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    people = nation.select((-F.col("n_nationkey") - 1).cast("long").alias("principal_id"), F.col("n_name").alias("name"), F.lit("R").alias("type")).unionByName(customer.select(F.col("c_custkey").alias("principal_id"), F.col("c_name").alias("name"), F.lit("U").alias("type")))
    links = customer.select((-F.col("c_nationkey") - 1).cast("long").alias("role_id"), F.col("c_custkey").alias("member_id"))
    return manage.role_members(links, people).select("role", "member")


@made("SELECT c_name AS grantee, CASE o_orderstatus WHEN 'F' THEN 'part' WHEN 'O' THEN 'nation' ELSE 'other' END AS class, CASE o_orderstatus WHEN 'F' THEN p_name WHEN 'O' THEN n_name END AS securable, o_orderpriority AS permission, o_orderkey % 25 AS major_id FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON p_partkey = o_orderkey % 25 LEFT JOIN nation ON n_nationkey = o_orderkey % 25")
def permissions(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "part").when(F.col("o_orderstatus") == "O", "nation").otherwise("other")
    grants = orders.select(kind.alias("class"), (F.col("o_orderkey") % 25).alias("major_id"), F.col("o_custkey").alias("grantee_id"), F.col("o_orderpriority").alias("permission"), F.lit("GRANT").alias("state"))
    people = table(spark, folder, "customer").select(F.col("c_custkey").alias("principal_id"), F.col("c_name").alias("name"))
    named = {"part": table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), "nation": table(spark, folder, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))}
    return manage.permissions(grants.withColumn("state", F.col("major_id").cast("string")), people, named).select("grantee", "class", "securable", "permission", F.col("state").cast("long").alias("major_id"))


@made("SELECT property, value FROM (VALUES ('time_zone', 'UTC')) AS t(property, value)")
def instance_properties(spark: SparkSession, folder: str) -> DataFrame:
    return manage.properties(spark).where("property = 'time_zone'")


@made("SELECT p AS provider, c AS capability, CASE WHEN p = 'sqlite' THEN c NOT IN ('stream', 'procedures') ELSE c IN ('query', 'stream', 'write', 'bulk_write') END AS supported FROM (VALUES ('sqlite'), ('csv')) AS x(p), (VALUES ('query'), ('stream'), ('write'), ('bulk_write'), ('procedures'), ('metadata'), ('transaction')) AS y(c)")
def provider_capabilities(spark: SparkSession, folder: str) -> DataFrame:
    return files.capabilities(spark).where(F.col("provider").isin("sqlite", "csv"))


@made("SELECT * FROM (VALUES ('select', 'SELECT `n_nationkey`, `n_name` FROM `nation` WHERE n_regionkey = 1'), ('insert', 'INSERT INTO `b`.`nation` (`n_nationkey`, `n_name`) SELECT `n_nationkey`, `n_name` FROM `nation` WHERE n_regionkey = 1'), ('rows', (SELECT CAST(count(*) AS VARCHAR) FROM nation WHERE n_regionkey = 1))) AS t(verb, text)")
def copy_statements(spark: SparkSession, folder: str) -> DataFrame:
    """The statements that copy one table, and what the first of them finds."""
    open_tables(spark, folder, ("nation",))
    texts = manage.copy_texts("nation", "b.nation", ["n_nationkey", "n_name"], ["n_nationkey"], "n_regionkey = 1")
    return spark.createDataFrame([("select", texts["select"]), ("insert", texts["insert"]), ("rows", str(spark.sql(texts["select"]).count()))], "verb string, text string")


# running queries
@made("SELECT 0 AS place, count(*) AS n FROM customer UNION ALL SELECT 1, count(*) FROM orders WHERE o_totalprice > 100000 UNION ALL SELECT 2, count(*) FROM nation")
def parallel_queries(spark: SparkSession, folder: str) -> DataFrame:
    open_tables(spark, folder, ("customer", "orders", "nation"))
    found = parallel.run_queries(spark, ["SELECT count(*) AS n FROM customer", "SELECT count(*) AS n FROM orders WHERE o_totalprice > :low", "SELECT count(*) AS n FROM nation"], 2, [{}, {"low": 100000}, {}])
    return reduce(DataFrame.unionByName, [df.select(F.lit(i).alias("place"), "n") for i, df in enumerate(found)])


@made("SELECT o_orderkey FROM orders WHERE o_totalprice > 200000.25 AND o_orderdate < TIMESTAMP '1997-01-01' AND o_orderstatus = 'F'")
def typed_parameters(spark: SparkSession, folder: str) -> DataFrame:
    """Named parameters in any case, with given types."""
    open_tables(spark, folder, ("orders",))
    return parallel.query(spark, "SELECT o_orderkey FROM orders WHERE o_totalprice > :low AND o_orderdate < :Day AND o_orderstatus = :status", {"@LOW": "200000.25", "day": "1997-01-01", "STATUS": "F"}, {"low": "double", "DAY": "timestamp_ntz"})[0]


@made("SELECT n_name, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers, (SELECT max(c_custkey) FROM customer) AS top FROM nation WHERE n_regionkey = 2")
def procedure(spark: SparkSession, folder: str) -> DataFrame:
    """A named routine with a parameter, a result set and an output."""
    routines = parallel.Routines()

    def report(session: SparkSession, region: int):
        people = table(session, folder, "customer")
        counts = people.groupBy("c_nationkey").agg(F.count("*").alias("customers"))
        nations = table(session, folder, "nation").where(F.col("n_regionkey") == region)
        return {"rows": nations.join(counts, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_name", F.coalesce("customers", F.lit(0)).alias("customers"))}, {"top": people.agg(F.max("c_custkey")).first()[0]}

    routines.register("Report", report)
    rows, outputs = routines.call(spark, "report", region=2)
    return rows["rows"].withColumn("top", F.lit(outputs["top"]).cast("long"))


@made("SELECT CAST(n_nationkey AS BIGINT) AS \"Key\", n_name AS \"Name\", CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_regionkey AS VARCHAR) ELSE 'r' || n_regionkey END AS \"Mixed\" FROM nation")
def inferred_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Plain objects, keys in several cases, a column of two types."""
    rows = [{"Key" if i % 3 else "KEY": r["n_nationkey"], "Name": r["n_name"], "Mixed": r["n_regionkey"] if r["n_nationkey"] % 2 == 0 else f"r{r['n_regionkey']}"} for i, r in enumerate(table(spark, folder, "nation").collect(), 1)]
    return infer.from_objects(spark, rows)


# streams
@made("SELECT user_id AS key, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1")
def stateful_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Running counts of a stream, as they stand when it has no more."""
    name = f"counts_{uuid.uuid4().hex}"
    events = table(spark, folder, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/events.parquet*")
    found: list[DataFrame] = []
    running = stateful.running_counts(stream, "user_id", "value")
    path = scratch(spark, name)
    running.writeStream.outputMode("update").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(lambda df, i: df.withColumn("batch", F.lit(i)).write.mode("append").parquet(f"{path}/out")).start().awaitTermination()
    found = monitor.latest(spark.read.parquet(f"{path}/out"), ["key"], [F.col("batch").desc()])
    return found.select("key", "n", F.round("total", 6).alias("total"))


@made("SELECT user_id AS key, ts AS time, event_type AS value, before FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS NULL OR before <> event_type")
def value_changes(spark: SparkSession, folder: str) -> DataFrame:
    return stateful.batch_changes(table(spark, folder, "events"), "user_id", "ts", "event_type", ["event_id"])


@made("WITH e AS (SELECT event_id, ts, ts + CASE WHEN event_id % 50 = 0 THEN INTERVAL 3 HOURS ELSE INTERVAL 1 MINUTE END AS arrived FROM events), b AS (SELECT date_trunc('minute', arrived) AS m, max(ts) AS top FROM e GROUP BY 1), w AS (SELECT m, max(top) OVER (ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM b) SELECT event_id, coalesce(ts < mark - INTERVAL 2 HOURS, false) AS late FROM e JOIN w ON date_trunc('minute', arrived) = m")
def late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Which of the events come too late for a wait of two hours."""
    delay = F.when(F.col("event_id") % 50 == 0, F.expr("INTERVAL 3 HOURS")).otherwise(F.expr("INTERVAL 1 MINUTE"))
    events = table(spark, folder, "events").select("event_id", "ts", (F.col("ts") + delay).alias("arrived"))
    good, late = stateful.split_late(events, "ts", "arrived", "2 HOURS")
    return good.select("event_id", F.lit(False).alias("late")).unionByName(late.select("event_id", F.lit(True).alias("late")))


# functions of one's own
@made("SELECT c_custkey, c_acctbal * 1.19 + 1 AS gross, CAST(length(c_name) * 2 AS INT) AS doubled FROM customer")
def user_scalar(spark: SparkSession, folder: str) -> DataFrame:
    open_tables(spark, folder, ("customer",))
    user.scalar(spark, "with_tax", lambda x: x * 1.19 + 1, "double")
    user.sql(spark, "twice_as_long", "s STRING", "INT", "length(s) * 2")
    return spark.sql("SELECT c_custkey, with_tax(c_acctbal) AS gross, twice_as_long(c_name) AS doubled FROM customer")


@made("SELECT c_nationkey, max(c_acctbal) - min(c_acctbal) AS span FROM customer GROUP BY 1")
def user_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    open_tables(spark, folder, ("customer",))

    def span(values):
        return float(values.max() - values.min())

    user.aggregate(spark, "span_of", span, "double")
    return spark.sql("SELECT c_nationkey, span_of(c_acctbal) AS span FROM customer GROUP BY c_nationkey")


@made("SELECT p_partkey, word, CAST(place AS INT) AS place FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS place FROM part)")
def user_table(spark: SparkSession, folder: str) -> DataFrame:
    open_tables(spark, folder, ("part",))
    user.table(spark, "words_of", lambda text: ((i, w) for i, w in enumerate(text.split(" "), 1)), "place int, word string")
    return spark.sql("SELECT p_partkey, w.word, w.place FROM part, LATERAL words_of(p_name) AS w")


built("random_order", Query().select("n_name").from_("nation").order_by_raw("rand(7)"), "SELECT n_name FROM nation ORDER BY random()")
