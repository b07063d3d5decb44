"""Queries over the driver's tables, one or more for each operator, with the SQL that checks them."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import aggregates, convert, matching, nested
from .operators import batches, catalog, copy, dml, monitor, ranks
from .operators import paging
from .plans.query import Query, Raw
from .registry import ORACLES, QUERIES, both, built, made, table
from .session import open_tables
from .streaming import windows

__all__ = ["ORACLES", "QUERIES", "table"]

# projection, filters, predicates (builder)
built("select_columns", Query().select("c_custkey", "c_name").from_("customer"), "SELECT c_custkey, c_name FROM customer")
built("select_raw", Query().select("o_orderkey").select_raw("o_totalprice * 2 AS doubled", "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done").from_("orders"), "SELECT o_orderkey, o_totalprice * 2 AS doubled, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done FROM orders")
built("select_distinct", Query().select("o_orderstatus", "o_orderpriority").distinct().from_("orders"), "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
built("from_raw", Query().select("n_name").from_raw("nation AS n").where("n.n_regionkey", 1), "SELECT n_name FROM nation n WHERE n_regionkey = 1")
built("derived_table", Query().select("x.c_nationkey").select_raw("count(*) AS n").from_(Query().select("c_nationkey").from_("customer").where("c_acctbal", ">", 0), "x").group_by("x.c_nationkey"), "SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1")
built("literal_select", Query().select("1").select_raw("'a' AS letter"), "SELECT 1 AS \"1\", 'a' AS letter")
built("filter_groups", Query().select("c_custkey", "c_name").from_("customer").begin_group().where("c_mktsegment", "BUILDING").or_where("c_acctbal", "<", 0).end_group().where_between("c_nationkey", 3, 9), "SELECT c_custkey, c_name FROM customer WHERE (c_mktsegment = 'BUILDING' OR c_acctbal < 0) AND c_nationkey BETWEEN 3 AND 9")
built("where_raw", Query().select("p_partkey").from_("part").where_raw("length(p_name) + p_size", ">", 40).or_where_raw("p_size % 7", 0), "SELECT p_partkey FROM part WHERE length(p_name) + p_size > 40 OR p_size % 7 = 0")
built("scalar_subquery", Query().select("c_custkey").from_("customer").where("c_acctbal", ">", Query().select_raw("avg(c_acctbal)").from_("customer")), "SELECT c_custkey FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)")
built("in_list", Query().select("n_name").from_("nation").where_in("n_regionkey", [1, 3]).where_not_in("n_nationkey", [2, 3]), "SELECT n_name FROM nation WHERE n_regionkey IN (1, 3) AND n_nationkey NOT IN (2, 3)")
built("in_subquery", Query().select("c_custkey").from_("customer").where_in("c_custkey", Query().select("o_custkey").from_("orders").where("o_totalprice", ">", 200000)), "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
built("not_in_subquery", Query().select("c_custkey").from_("customer").where_not_in("c_custkey", Query().select("o_custkey").from_("orders").where("o_totalprice", ">", 200000)), "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
built("not_between", Query().select("l_orderkey", "l_linenumber").from_("lineitem").where_not_between("l_quantity", 5, 45), "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45")
built("null_tests", Query().select("c_custkey", "o_orderkey").from_("customer").join_raw("orders", "c_custkey = o_custkey AND o_totalprice > 400000", "left").where_null("o_orderkey").or_where("o_totalprice", ">", 450000).where_not_null("c_name"), "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000 WHERE o_orderkey IS NULL OR o_totalprice > 450000 AND c_name IS NOT NULL")
built("raw_in_between", Query().select("o_orderkey").from_("orders").where_in(Raw("o_custkey % 10"), [1, 2]).where_between(Raw("year(o_orderdate)"), 1995, 1996).where_not_null(Raw("nullif(o_orderstatus, 'P')")), "SELECT o_orderkey FROM orders WHERE o_custkey % 10 IN (1, 2) AND year(o_orderdate) BETWEEN 1995 AND 1996 AND nullif(o_orderstatus, 'P') IS NOT NULL")
built("is_distinct_from", Query().select("o_orderkey").from_("orders").where("o_orderstatus", "IS DISTINCT FROM", "F"), "SELECT o_orderkey FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'")
built("null_safe_equal", Query().select("o_orderkey").from_("orders").where("o_orderstatus", "<=>", "P").where("o_orderpriority", "IS NOT", "1-URGENT"), "SELECT o_orderkey FROM orders WHERE o_orderstatus IS NOT DISTINCT FROM 'P' AND o_orderpriority IS DISTINCT FROM '1-URGENT'")
built("like_ilike", Query().select("p_partkey").from_("part").where("p_name", "LIKE", "%a%").where("p_type", "NOT ILIKE", "%BRASS"), "SELECT p_partkey FROM part WHERE p_name LIKE '%a%' AND p_type NOT ILIKE '%BRASS'")
built("not_less_not_greater", Query().select("s_suppkey").from_("supplier").where("s_acctbal", "!<", 100).where("s_acctbal", "!>", 5000), "SELECT s_suppkey FROM supplier WHERE s_acctbal >= 100 AND s_acctbal <= 5000")
built("regex_match", Query().select("p_partkey", "p_name").from_("part").where("p_name", "REGEXP", "^[a-m].*t$").or_where("p_brand", "RLIKE", "#1[0-4]"), "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^[a-m].*t$') OR regexp_matches(p_brand, '#1[0-4]')")
built("similar_to", Query().select("p_partkey").from_("part").where("p_name", "SIMILAR TO", "(red|blue) (bolt|w%)").or_where("p_type", "SIMILAR TO", "_R[A-P]{2}O"), "SELECT p_partkey FROM part WHERE p_name SIMILAR TO '(red|blue) (bolt|w.*)' OR p_type SIMILAR TO '.R[A-P]{2}O'")
built("not_similar_to", Query().select("p_partkey").from_("part").where("p_type", "NOT SIMILAR TO", "(ECONOMY|S%)"), "SELECT p_partkey FROM part WHERE NOT p_type SIMILAR TO '(ECONOMY|S.*)'")
built("glob", Query().select("p_partkey").from_("part").where("p_name", "GLOB", "[a-m]*t"), "SELECT p_partkey FROM part WHERE p_name GLOB '[a-m]*t'")
built("match_terms", Query().select("doc_id").from_("documents").where("text", "MATCH", "the and"), "SELECT doc_id FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'and')")
built("optional_parameter", Query().select("n_name").from_("nation").where_if("n_nationkey", "<", None).where_if("n_regionkey", 2), "SELECT n_name FROM nation WHERE (CAST(NULL AS INT) IS NULL OR n_nationkey < CAST(NULL AS INT)) AND (2 IS NULL OR n_regionkey = 2)")


@made("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS BIGINT) * 2 AS second, NULL::BIGINT AS none FROM events")
def nested_value(spark: SparkSession, folder: str) -> DataFrame:
    """Paths through structs, maps and lists: fields and keys in any case, indexes from 0, null beyond the end."""
    found = nested.json_map(F.col("props"), "bigint")
    df = table(spark, folder, "events").select("event_id", F.struct(found.alias("Inner"), F.array(found["k"], found["k"] * 2).alias("list")).alias("item"))
    return df.select("event_id", nested.value_at(df, "ITEM.inner.K").alias("k"), nested.value_at(df, "item.list[1]").alias("second"), nested.value_at(df, "item.list[7]").alias("none"))



# joins
built("join_inner", Query().select("n_name", "r_name").from_("nation").join("region", "n_regionkey", "r_regionkey"), "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
built("join_left", Query().select("c_custkey", "o_orderkey").from_("customer").join_raw("orders", "c_custkey = o_custkey AND o_totalprice > 300000", "left"), "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000")
built("join_right", Query().select("s_suppkey", "n_name").from_("supplier").right_join("nation", "s_nationkey", "n_nationkey"), "SELECT s_suppkey, n_name FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey")
built("join_full", Query().select("s_suppkey", "c_custkey").from_("supplier").full_outer_join("customer", "s_suppkey", "c_custkey"), "SELECT s_suppkey, c_custkey FROM supplier FULL OUTER JOIN customer ON s_suppkey = c_custkey")
built("cross_join", Query().select("r_name", "n_name").from_("region").cross_join("nation"), "SELECT r_name, n_name FROM region CROSS JOIN nation")
built("theta_join", Query().select("a.n_name").select_raw("count(*) AS n").from_("nation", "a").join("nation", "a.n_nationkey", "<", "b.n_nationkey", alias="b").group_by("a.n_name"), "SELECT a.n_name, count(*) AS n FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey GROUP BY 1")
built("semi_join", Query().select("c_custkey").from_("customer").semi_join("orders", "c_custkey", "o_custkey"), "SELECT c_custkey FROM customer SEMI JOIN orders ON c_custkey = o_custkey")
built("anti_join", Query().select("c_custkey").from_("customer").join_raw("orders", "c_custkey = o_custkey AND o_totalprice > 100000", "anti"), "SELECT c_custkey FROM customer ANTI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 100000")
built("lateral_join", Query().select("n_name", "t.top").from_("nation").lateral_join(Query().select_raw("max(c_acctbal) AS top").from_("customer").where_raw("c_nationkey = n_nationkey", True), "t"), "SELECT n_name, t.top FROM nation LEFT JOIN LATERAL (SELECT max(c_acctbal) AS top FROM customer WHERE c_nationkey = n_nationkey) t ON true")
built("self_join", Query().select_raw("child.n_name AS child", "parent.n_name AS parent").from_("nation", "child").join("nation", "child.n_regionkey", "parent.n_nationkey", alias="parent"), "SELECT child.n_name AS child, parent.n_name AS parent FROM nation child JOIN nation parent ON child.n_regionkey = parent.n_nationkey")
built("multi_join", Query().select("r_name").select_raw("count(*) AS n").from_("customer").join("nation", "c_nationkey", "n_nationkey").join("region", "n_regionkey", "r_regionkey").join("orders", "o_custkey", "c_custkey").group_by("r_name"), "SELECT r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN orders ON o_custkey = c_custkey GROUP BY r_name")
built("positions", Query().select("vec_id", "t.ordinal", "t.x").from_("embeddings").lateral_join(Query().select_raw("p.pos + 1 AS ordinal", "p.col AS x").from_raw("posexplode(embedding) AS p"), "t", left=False), "SELECT vec_id, CAST(o AS INT) AS ordinal, embedding[o] AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS o FROM embeddings)")


@made("SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAYS")
def range_join(spark: SparkSession, folder: str) -> DataFrame:
    return ranks.within(table(spark, folder, "orders"), table(spark, folder, "lineitem"), ["o_orderkey"], ["l_orderkey"], "o_orderdate", "l_shipdate", datetime.timedelta(days=30)).select("o_orderkey", "l_linenumber")


@made("SELECT e.event_id, count(b.event_id) AS n FROM events e LEFT JOIN events b ON b.ts >= e.ts - INTERVAL 10 MINUTES AND b.ts <= e.ts AND b.event_id <> e.event_id GROUP BY 1")
def interval_join(spark: SparkSession, folder: str) -> DataFrame:
    """Events of the ten minutes before each: no key but time."""
    events = table(spark, folder, "events").select("event_id", "ts")
    found = ranks.near_counts(events, events.select(F.col("ts").alias("other_ts")), "ts", "other_ts", datetime.timedelta(minutes=10))
    return found.select("event_id", (F.col("n") - 1).alias("n"))


@made("SELECT e.event_id, p.event_id AS purchase_id FROM (SELECT * FROM events WHERE event_type = 'error') e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY ALL) p ON e.user_id = p.user_id AND e.ts > p.ts")
def asof_join(spark: SparkSession, folder: str) -> DataFrame:
    """The last purchase before each error: one shuffle, no join."""
    events = table(spark, folder, "events")
    errors = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    bought = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    return ranks.as_of(errors, bought, ["user_id"], "ts", ["purchase_id"]).select("event_id", "purchase_id")


# aggregation
built("group_having", Query().select("c_nationkey").select_raw("count(*) AS n").from_("customer").group_by("c_nationkey").having_raw("count(*)", ">", 50), "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 50")
built("group_by_raw", Query().select_raw("year(o_orderdate) AS y", "count(*) AS n", "min(o_totalprice) AS low", "max(o_totalprice) AS high").from_("orders").group_by_raw("year(o_orderdate)"), "SELECT CAST(year(o_orderdate) AS INT) AS y, count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1")


@made("SELECT count(*) AS n FROM lineitem")
def table_count(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.row_count(table(spark, folder, "lineitem"))


@made("SELECT count(*) AS n, (SELECT count(*) FROM (SELECT 1 FROM events GROUP BY lower(event_type), user_id)) AS folded FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def distinct_key_count(spark: SparkSession, folder: str) -> DataFrame:
    exact = copy.keys_of(table(spark, folder, "lineitem"), ("l_orderkey", "l_linenumber")).agg(F.count("*").alias("n"))
    folded = copy.keys_of(table(spark, folder, "events"), ("event_type", "user_id"), True).agg(F.count("*").alias("folded"))
    return exact.join(F.broadcast(folded))  # one row each


@made("SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS last_f, max(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) AS last_o FROM orders GROUP BY o_custkey")
def conditional_max(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.latest_by_kind(table(spark, folder, "orders"), ["o_custkey"], "o_orderstatus", "o_orderdate", {"last_f": "F", "last_o": "O"})


@made("WITH m AS (SELECT max(o_orderdate) AS top FROM orders) SELECT o_orderkey FROM orders CROSS JOIN m WHERE o_orderdate = top")
def global_max(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.at_greatest(table(spark, folder, "orders"), "o_orderdate").select("o_orderkey")


@made("SELECT c_nationkey, string_agg(c_name, ', ' ORDER BY c_acctbal DESC, c_custkey) AS names FROM customer GROUP BY c_nationkey")
def ordered_string_agg(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.joined_text(table(spark, folder, "customer"), ["c_nationkey"], F.col("c_name"), [-F.col("c_acctbal"), F.col("c_custkey")], ", ", "names")


@made("SELECT count(*) AS n, min(l_orderkey) AS low, max(l_orderkey) AS high, CAST(sum(l_orderkey) AS BIGINT) AS keys, CAST(sum(CAST(l_extendedprice AS DECIMAL(38,2))) AS DOUBLE) AS amount FROM lineitem")
def integrity_summary(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.integrity(table(spark, folder, "lineitem"), "l_orderkey", "l_extendedprice")


@made("SELECT c_nationkey, CASE WHEN count(nullif(c_acctbal > 9000, true)) = count(*) THEN CAST(sum(c_custkey) AS BIGINT) END AS total FROM customer GROUP BY 1")
def known_total(spark: SparkSession, folder: str) -> DataFrame:
    """A nation's total is unknown if one of its customers' numbers is (here: of those with much money)."""
    return aggregates.known_total(table(spark, folder, "customer").withColumn("x", F.when(F.col("c_acctbal") <= 9000, F.col("c_custkey"))), ["c_nationkey"], "x")


@made("SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderdate) AS days FROM orders GROUP BY o_orderpriority")
def distinct_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.distinct_counts(table(spark, folder, "orders"), ["o_orderpriority"], {"o_custkey": "customers", "o_orderdate": "days"})


built("cube", Query().select("l_returnflag", "l_linestatus").select_raw("count(*) AS n").from_("lineitem").cube("l_returnflag", "l_linestatus"), "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
built("rollup", Query().select("l_returnflag", "l_linestatus").select_raw("count(*) AS n").from_("lineitem").rollup("l_returnflag", "l_linestatus"), "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
built("grouping_sets", Query().select("l_returnflag", "l_linestatus").select_raw("count(*) AS n").from_("lineitem").grouping_sets(("l_returnflag",), ("l_linestatus",), ()), "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")


@made("SELECT l_returnflag, nullif(count(*) FILTER (WHERE l_linestatus = 'O'), 0) AS o, nullif(count(*) FILTER (WHERE l_linestatus = 'X'), 0) AS x FROM lineitem GROUP BY 1")
def pivot(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.pivot_counts(table(spark, folder, "lineitem"), ["l_returnflag"], "l_linestatus", {"o": "O", "x": "X"})




@made()
def approximate_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("parts"))


# windows
@made("SELECT event_id, event_type, user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY lower(event_type), user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS k FROM events) WHERE k = 1")
def dedupe_latest(spark: SparkSession, folder: str) -> DataFrame:
    return copy.dedupe(table(spark, folder, "events"), ("event_type", "user_id"), ("ts", "event_id"), True).select("event_id", "event_type", "user_id", "value")


@made("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def latest_per_group(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.latest(table(spark, folder, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select("o_custkey", "o_orderkey")


@made("WITH s AS (SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount FROM events GROUP BY 1), p AS (SELECT *, 100.0::DOUBLE * amount::DOUBLE / nullif(sum(amount) OVER (), 0)::DOUBLE AS pct, 100.0::DOUBLE * (sum(amount) OVER (ORDER BY amount DESC, event_type ROWS UNBOUNDED PRECEDING))::DOUBLE / nullif(sum(amount) OVER (), 0)::DOUBLE AS running FROM s) SELECT event_type, round(pct, 6) AS pct, round(running, 6) AS running FROM p WHERE running <= 80 OR pct >= 1")
def pareto_share(spark: SparkSession, folder: str) -> DataFrame:
    out = monitor.pareto(table(spark, folder, "events"), "event_type", F.col("value").cast("decimal(18,2)"))
    return out.select("event_type", F.round("pct", 6).alias("pct"), F.round("running", 6).alias("running"))




@made("SELECT o_orderkey, CAST(ntile(8) OVER (ORDER BY o_orderkey) AS BIGINT) AS part FROM orders")
def ntile_export(spark: SparkSession, folder: str) -> DataFrame:
    return ranks.ntile(table(spark, folder, "orders").select("o_orderkey"), 8, [F.col("o_orderkey")], "part")


@made("SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS n FROM customer")
def row_sequence(spark: SparkSession, folder: str) -> DataFrame:
    return ranks.number_rows(table(spark, folder, "customer").select("c_custkey", "c_acctbal"), [F.col("c_acctbal").desc(), F.col("c_custkey")]).select("c_custkey", "n")


@made("SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS n FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def anti_row_number(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return ranks.number_rows(table(spark, folder, "customer").select("c_custkey").join(orders, "c_custkey", "left_anti"), [F.col("c_custkey")])


@made("SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,2)) AS running FROM events")
def running_sum(spark: SparkSession, folder: str) -> DataFrame:
    return ranks.running_total(table(spark, folder, "events").select("event_id", "ts", "value"), F.col("value").cast("decimal(18,2)"), [F.col("ts"), F.col("event_id")]).select("event_id", F.col("running").cast("decimal(38,2)").alias("running"))


@made("SELECT c_custkey, CAST(rank() OVER w AS BIGINT) AS r, CAST(dense_rank() OVER w AS BIGINT) AS d, lag(c_custkey) OVER w AS before, lead(c_custkey) OVER w AS after, first_value(c_custkey) OVER w AS top FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC NULLS LAST, c_custkey)")
def group_ranks(spark: SparkSession, folder: str) -> DataFrame:
    columns = {"r": F.rank(), "d": F.dense_rank(), "before": F.lag("c_custkey"), "after": F.lead("c_custkey"), "top": F.first("c_custkey")}
    out = aggregates.framed(table(spark, folder, "customer"), ["c_nationkey"], [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey")], columns)
    return out.select("c_custkey", F.col("r").cast("long").alias("r"), F.col("d").cast("long").alias("d"), "before", "after", "top")


@made("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n, last_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last FROM events")
def moving_frame(spark: SparkSession, folder: str) -> DataFrame:
    events, order = table(spark, folder, "events"), [F.col("ts"), F.col("event_id")]
    out = aggregates.framed(events, ["user_id"], order, {"n": F.count("*")}, rows=(-2, 0))
    return aggregates.framed(out, ["user_id"], order, {"last": F.last("event_type")}, rows=(Window.unboundedPreceding, Window.unboundedFollowing)).select("event_id", "n", "last")


@made("SELECT o_orderkey, CAST(count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderkey RANGE BETWEEN 1000 PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM orders")
def range_frame(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.framed(table(spark, folder, "orders"), ["o_custkey"], [F.col("o_orderkey")], {"n": F.count("*")}, range_=(-1000, 0)).select("o_orderkey", "n")



# order, limit, paging, set operations
built("top_k", Query().select("o_orderkey", "o_totalprice").from_("orders").order_by_descending("o_totalprice").order_by("o_orderkey").top(10), "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10")
built("page", Query().select("o_orderkey").from_("orders").order_by("o_orderkey").limit(100).offset(250), "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 250")


@made("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000.5 OR (o_totalprice = 200000.5 AND o_orderkey > 7) ORDER BY o_totalprice, o_orderkey LIMIT 100")
def keyset_page(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import Row

    return paging.page(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 100, Row(o_totalprice=200000.5, o_orderkey=7))


built("union_distinct", Query().select("c_nationkey").from_("customer").union(Query().select("s_nationkey").from_("supplier")), "SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
built("union_all", Query().select("n_nationkey").from_("nation").union_all(Query().select("r_regionkey").from_("region")), "SELECT n_nationkey FROM nation UNION ALL SELECT r_regionkey FROM region")
built("intersect", Query().select("n_nationkey").from_("nation").intersect(Query().select("r_regionkey").from_("region")), "SELECT n_nationkey FROM nation INTERSECT SELECT r_regionkey FROM region")
built("mixed_setops", Query().select("n_nationkey").from_("nation").union_all(Query().select("c_nationkey").from_("customer")).intersect(Query().select("r_regionkey").from_("region")), "SELECT n_nationkey FROM nation UNION ALL SELECT c_nationkey FROM customer INTERSECT SELECT r_regionkey FROM region")
built("limited_setop", Query().select("o_orderkey").from_("orders").order_by("o_orderkey").limit(5).union_all(Query().select("c_custkey").from_("customer").order_by_descending("c_custkey").limit(5)), "SELECT * FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 5) UNION ALL SELECT * FROM (SELECT c_custkey FROM customer ORDER BY c_custkey DESC LIMIT 5)")
built("except_distinct", Query().select("n_nationkey").from_("nation").except_(Query().select("r_regionkey").from_("region")), "SELECT n_nationkey FROM nation EXCEPT SELECT r_regionkey FROM region")
built("except_all", Query().select("c_nationkey").from_("customer").except_all(Query().select("s_nationkey").from_("supplier")), "SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
built("intersect_all", Query().select("c_nationkey").from_("customer").intersect_all(Query().select("s_nationkey").from_("supplier")), "SELECT c_nationkey FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")


@made("SELECT n_nationkey AS id, n_name AS name, NULL::VARCHAR AS segment FROM nation UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def padded_union(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    people = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return nations.unionByName(people, allowMissingColumns=True)


# scalar functions and conversions


@made("SELECT p_partkey, upper(p_name) AS u, CAST(length(p_name) AS INT) AS n, substring(p_name, 2, 3) AS s, replace(p_name, 'b', 'x') AS r, '[' || replace(p_name || ']', ']', ']]') || ']' AS q, CAST(instr(p_name, ' ') AS INT) AS i, ltrim(substring(p_name, instr(p_name, ' '))) AS l, chr(64 + p_size % 26 + 1) AS c FROM part")
def string_functions(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, folder, "part").select("p_partkey", F.upper(name).alias("u"), F.length(name).alias("n"), F.substring(name, 2, 3).alias("s"), F.replace(name, F.lit("b"), F.lit("x")).alias("r"), convert.quote_name(F.concat(name, F.lit("]"))).alias("q"), F.instr(name, " ").alias("i"), F.ltrim(F.substr(name, F.instr(name, " "))).alias("l"), F.char(64 + F.col("p_size") % 26 + 1).alias("c"))


@made("SELECT c_custkey, '0x' || hex(c_name) AS h, decode(unhex(hex(c_name))) AS back FROM customer")
def hex_binary(spark: SparkSession, folder: str) -> DataFrame:
    coded = nested.hex_binary(F.col("c_name").cast("binary"))
    return table(spark, folder, "customer").select("c_custkey", coded.alias("h"), nested.from_hex(coded).cast("string").alias("back"))


both("math_functions", "SELECT c_custkey, abs(c_acctbal) AS a, c_custkey % 7 AS m, CAST(floor(c_acctbal) AS BIGINT) AS f, coalesce(nullif(c_nationkey, 3), -1) AS k FROM customer")
both("date_functions", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, date_trunc('MONTH', o_orderdate) AS first FROM orders", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS first FROM orders")
both("json_field_counts", "SELECT get_json_object(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1", "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1")


@made("SELECT vec_id, CAST(len(embedding) AS INT) AS n, embedding[1] AS first, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INT) AS positive, list_max(embedding) AS top FROM embeddings")
def array_functions(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, folder, "embeddings").select("vec_id", F.size(e).alias("n"), F.element_at(e, 1).alias("first"), F.size(F.filter(e, lambda x: x > 0)).alias("positive"), F.array_max(e).alias("top"))


@made("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'K,user' AS keys, CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) > 50 THEN 1 ELSE 0 END AS large FROM events")
def map_functions(spark: SparkSession, folder: str) -> DataFrame:
    made_ = F.map_concat(nested.json_map(F.col("props"), "bigint"), F.create_map(F.lit("user"), F.col("user_id")))
    upper = F.transform_keys(made_, lambda k, _: F.when(k == "k", F.upper(k)).otherwise(k))
    large = F.map_filter(upper, lambda k, v: (k == "K") & (v > 50))
    return table(spark, folder, "events").select("event_id", upper["K"].alias("k"), F.array_join(F.array_sort(F.map_keys(upper)), ",").alias("keys"), F.cardinality(large).alias("large"))


@made("SELECT p_partkey, p_brand AS brand, CAST(p_size AS VARCHAR) AS size, p_size > 25 AS large FROM part")
def xml_values(spark: SparkSession, folder: str) -> DataFrame:
    part = F.concat(F.lit("<part><brand>"), F.col("p_brand"), F.lit('</brand><size unit="cm">'), F.col("p_size").cast("string"), F.lit("</size></part>"))
    return table(spark, folder, "part").select("p_partkey", nested.xml_value(part, "part/brand").alias("brand"), nested.xml_value(part, "/part/size[@unit='cm']").alias("size"), nested.xml_exists(part, "/part/size[. > 25]").alias("large"))


both("values_table", "SELECT k, v FROM (VALUES (1, 'a'), (2, 'b'), (3, NULL)) AS t(k, v)")
built("bit_test", Query().select("p_partkey").from_("part").where_raw("p_size & 1", 1), "SELECT p_partkey FROM part WHERE (p_size & 1) = 1")
built("try_conversion", Query().select("p_partkey").select_raw("try_cast(split_part(p_brand, '#', 2) AS INT) AS n", "try_cast(split_part(p_name, ' ', 1) AS INT) AS none", "CAST(p_retailprice AS DECIMAL(38,2)) AS price").from_("part"), "SELECT p_partkey, try_cast(split_part(p_brand, '#', 2) AS INT) AS n, try_cast(split_part(p_name, ' ', 1) AS INT) AS none, CAST(p_retailprice AS DECIMAL(38,2)) AS price FROM part")


@made("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN c_custkey % 3 <> 0 WHEN 3 THEN round_even(c_acctbal / 10000, 0) <> 0 END AS flag FROM customer")
def bool_conversion(spark: SparkSession, folder: str) -> DataFrame:
    """Texts true and false in any case, integers as text, fractions rounded half to even, nulls."""
    k = F.col("c_custkey")
    df = table(spark, folder, "customer").select("c_custkey", "c_acctbal", F.when(k % 5 == 0, " True").when(k % 5 == 1, "FALSE").when(k % 5 == 2, (k % 3).cast("string")).alias("x"))
    text, number = convert.convert(F.col("x"), df.schema["x"].dataType, "boolean"), convert.convert(F.col("c_acctbal") / 10000, df.schema["c_acctbal"].dataType, "boolean")
    return df.select("c_custkey", F.when(k % 5 == 3, number).otherwise(text).alias("flag"))


@made("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(38,18)) AS amount, CAST(o_orderkey AS VARCHAR) AS name, CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP) AS at, o_orderkey AS whole FROM orders")
def typed_conversions(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    to = lambda c, t: convert.convert(F.col(c), df.schema[c].dataType, t)
    return df.select("o_orderkey", to("o_totalprice", "decimal").alias("amount"), to("o_orderkey", "string").alias("name"), to("day", "datetime").alias("at"), to("o_orderkey", "int64").alias("whole"))


@made("SELECT l_orderkey, l_linenumber, CAST(round_even(l_extendedprice, 0) AS INT) AS whole FROM lineitem")
def bankers_rounding(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "lineitem")
    return df.select("l_orderkey", "l_linenumber", convert.convert(F.col("l_extendedprice"), df.schema["l_extendedprice"].dataType, "int32").alias("whole"))


@made("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN c_custkey % 8 = 2 END AS flag FROM customer")
def relaxed_bool(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    text = F.when(k % 4 == 0, "yes").when(k % 4 == 1, " n ").when(k % 4 == 2, F.when(k % 8 == 2, "1").otherwise("No")).otherwise("maybe")
    return table(spark, folder, "customer").select("c_custkey", convert.relaxed_boolean(text).alias("flag"))


@made("SELECT event_id, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS seconds FROM events")
def clock_durations(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    clock = F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)
    return table(spark, folder, "events").select("event_id", convert.clock_duration(clock).alias("seconds"))


# DML
# over the whole table: three quarters of its rows match, a quarter is new, at every size
UPSERT_ALL = "SELECT c_custkey + CAST(floor((SELECT max(c_custkey) FROM customer) / 4) AS BIGINT) AS c_custkey, 'new ' || c_name AS c_name, c_acctbal + 1 AS c_acctbal FROM customer"


@made(f"WITH n AS ({UPSERT_ALL}) SELECT coalesce(c.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NOT NULL THEN n.c_name ELSE c.c_name END AS c_name, c_nationkey, CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE c.c_acctbal END AS c_acctbal, c_mktsegment FROM customer c FULL JOIN n ON c.c_custkey = n.c_custkey")
def upsert_merge_all(spark: SparkSession, folder: str) -> DataFrame:
    open_tables(spark, folder, ("customer",))
    return dml.merge(table(spark, folder, "customer"), spark.sql(UPSERT_ALL), ["c_custkey"])


@made(f"WITH n AS ({UPSERT_ALL}) SELECT coalesce(c.c_custkey, n.c_custkey) AS c_custkey, coalesce(c.c_name, n.c_name) AS c_name, CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE c.c_acctbal END AS c_acctbal FROM customer c FULL JOIN n ON c.c_custkey = n.c_custkey")
def upsert_some_columns_all(spark: SparkSession, folder: str) -> DataFrame:
    open_tables(spark, folder, ("customer",))
    return dml.merge(table(spark, folder, "customer"), spark.sql(UPSERT_ALL), ["c_custkey"], ["c_acctbal"]).select("c_custkey", "c_name", "c_acctbal")


@made(f"SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT * FROM ({UPSERT_ALL}) n WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = n.c_custkey)")
def insert_if_missing_all(spark: SparkSession, folder: str) -> DataFrame:
    open_tables(spark, folder, ("customer",))
    return dml.insert_if_missing(table(spark, folder, "customer"), spark.sql(UPSERT_ALL), ["c_custkey"]).select("c_custkey", "c_name", "c_acctbal")


@made("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer")
def update_where(spark: SparkSession, folder: str) -> DataFrame:
    return dml.update(table(spark, folder, "customer"), {"c_acctbal": F.lit(0.0)}, F.col("c_acctbal") < 0).select("c_custkey", "c_acctbal")


@made("SELECT c_custkey FROM customer WHERE NOT coalesce(nullif(c_mktsegment, 'BUILDING') < 'H', false)")
def delete_where(spark: SparkSession, folder: str) -> DataFrame:
    """A predicate that is true for some, false for others and unknown for the rest, which stay."""
    return dml.delete(table(spark, folder, "customer"), F.nullif("c_mktsegment", F.lit("BUILDING")) < "H").select("c_custkey")


@made("SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT 100, 'ATLANTIS', NULL")
def insert_rows(spark: SparkSession, folder: str) -> DataFrame:
    return dml.insert(table(spark, folder, "nation"), spark.sql("SELECT 100 AS n_nationkey, 'ATLANTIS' AS n_name"))


# copy, catalog, batches, streaming
@made("SELECT event_id AS id, ts, user_id, event_type AS kind, CAST(round_even(value, 0) AS BIGINT) AS value FROM events")
def copy_transform(spark: SparkSession, folder: str) -> DataFrame:
    return copy.transform(table(spark, folder, "events"), copy.CopySpec("events", "copied", mappings={"event_id": "id", "event_type": "kind"}, exclusions=("props",), conversions={"value": "int64"}))


@made("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.orphans(table(spark, folder, "orders"), table(spark, folder, "customer").where("c_acctbal >= 0"), [("o_custkey", "c_custkey")]).select("o_orderkey", "o_custkey")


@made("SELECT 'orders' AS table_name, name AS column_name, CAST(o AS INT) AS ordinal FROM (VALUES ('o_orderkey', 1), ('o_custkey', 2), ('o_orderstatus', 3), ('o_totalprice', 4), ('o_orderdate', 5), ('o_orderpriority', 6)) AS t(name, o)")
def catalog_columns(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.columns(table(spark, folder, "orders"), "orders").select("table_name", "column_name", "ordinal")


@made()
def key_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of documents as entities, by language: rows and bytes both bound a batch. Checked by replaying each batch."""
    docs = table(spark, folder, "documents")
    rows = docs.withColumn("size", F.least(batches.entity_size(docs, "lang", "doc_id", ["text", "source", "n_chars"]), F.lit(batches.ENTITY_BYTES)))
    return batches.plan_batches(rows, "lang", "doc_id", "size")


@made("SELECT vec_id, CAST(4 + 2 * length(label::VARCHAR) + 2 * length(vec_id::VARCHAR) + CASE WHEN label IS NULL THEN 0 ELSE 4 + 8 + 2 * 5 END AS BIGINT) AS size FROM embeddings")
def entity_sizes(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "embeddings")
    return df.select("vec_id", batches.entity_size(df, "label", "vec_id", ["label"]).alias("size"))


@made("SELECT '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}' AS line FROM nation")
def json_lines(spark: SparkSession, folder: str) -> DataFrame:
    return batches.json_lines(table(spark, folder, "nation"))


@made("SELECT '[' || string_agg('{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}', ',' ORDER BY n_nationkey) || ']' AS payload FROM nation")
def json_payload(spark: SparkSession, folder: str) -> DataFrame:
    return batches.json_array(table(spark, folder, "nation"), ["n_nationkey"])


@made("SELECT doc_id || chr(9) || regexp_replace(text, '[\r\n\t]+', ' ', 'g') AS line FROM documents")
def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    return batches.text_lines(table(spark, folder, "documents").select("doc_id", "text"))


@made("SELECT date_trunc('hour', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(spark: SparkSession, folder: str) -> DataFrame:
    return windows.tumbling(table(spark, folder, "events"), "ts", "1 hour", ["event_type"]).select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@made("SELECT s::TIMESTAMP AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 30 MINUTES, ts), time_bucket(INTERVAL 30 MINUTES, ts) - INTERVAL 30 MINUTES]) AS s FROM events) GROUP BY ALL")
def sliding_counts(spark: SparkSession, folder: str) -> DataFrame:
    return windows.tumbling(table(spark, folder, "events"), "ts", "1 hour", ["event_type"], slide="30 minutes").select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@made("SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS opens FROM events)) GROUP BY user_id, k")
def session_counts(spark: SparkSession, folder: str) -> DataFrame:
    return windows.sessions(table(spark, folder, "events"), "ts", "30 minutes", ["user_id"]).select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("start"), "n")


FLAGSHIP = Query().select("n_name").select_raw("count(*) AS orders", "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount").from_("customer").join("nation", "c_nationkey", "n_nationkey").join("orders", "o_custkey", "c_custkey").where("c_acctbal", ">", 0).group_by("n_name").having_raw("count(*)", ">", 5).order_by_descending("amount").order_by("n_name").limit(10)
built("flagship", FLAGSHIP, "SELECT n_name, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY n_name HAVING count(*) > 5 ORDER BY amount DESC NULLS LAST, n_name LIMIT 10")


@made("SELECT p_partkey, p_name SIMILAR TO '[a-l].*' AS similar, p_name GLOB '*bolt' AS globbed, contains(lower(p_name), 're') AND contains(lower(p_name), 't') AS matched FROM part")
def pattern_columns(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, folder, "part").select("p_partkey", matching.similar_to(name, "[a-l]%").alias("similar"), matching.glob(name, "*bolt").alias("globbed"), matching.match(name, "RE t").alias("matched"))


from . import queries_more, queries_streams, queries_tables  # noqa: E402, F401  register the rest
