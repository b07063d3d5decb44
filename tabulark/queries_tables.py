"""Queries over the driver's tables, continued: what tables in versions, verification, order indexes, sketches and
aggregates of one's own give."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import nested, partial, sketches
from .operators import copy, dml, paging, ranks, verify
from .plans import statements
from .queries_more import scratch
from .registry import made, table
from .sources import files


@made("""WITH n AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1), f AS (SELECT coalesce(max(n), 0) AS n FROM n WHERE s = 'F'), o AS (SELECT coalesce(max(n), 0) AS n FROM n WHERE s = 'O'), p AS (SELECT coalesce(max(n), 0) AS n FROM n WHERE s = 'P')
SELECT v.version, v.verb, v.affected, v.rows, v.added, v.removed FROM f, o, p, LATERAL (VALUES (1, 'commit', f.n, f.n, 1, 0), (2, 'append', o.n, f.n + o.n, 1, 0), (3, 'append', p.n, f.n + o.n + p.n, 1, 0), (4, 'update', p.n, f.n + o.n + p.n, 1, 1), (5, 'delete', f.n, o.n + p.n, 0, 1)) AS v(version, verb, affected, rows, added, removed)""")
def table_log(spark: SparkSession, folder: str) -> DataFrame:
    """What each verb does to files: appends add some, an update replaces those with rows to change, a delete of whole files writes none."""
    orders = table(spark, folder, "orders")
    part = lambda s: orders.where(F.col("o_orderstatus") == s).coalesce(1)
    target = dml.VersionedTable(spark, scratch(spark, "orders"))
    target.commit(part("F"))
    said = [("commit", target.state().rows()), ("append", target.append(part("O"))), ("append", target.append(part("P")))]
    said.append(("update", statements.update().set("o_orderpriority", "none").where("o_orderstatus", "P").run(spark, target)))
    said.append(("delete", statements.delete().where("o_orderstatus", "F").run(spark, target)))
    states = [{}, *[target.state(n).files for n in range(1, 6)]]
    rows = [(n, verb, hit, sum(f.rows for f in states[n].values()), len(states[n].keys() - states[n - 1].keys()), len(states[n - 1].keys() - states[n].keys())) for n, (verb, hit) in enumerate(said, 1)]
    return spark.createDataFrame(rows, "version int, verb string, affected long, rows long, added int, removed int")


@made("SELECT 'orders' AS name, count(*) AS n, CAST(sum(o_totalprice) AS DECIMAL(38, 2)) AS total FROM orders WHERE o_custkey % 10 <> 3 UNION ALL SELECT 'customer', count(*), CAST(sum(CASE WHEN c_custkey % 10 = 3 THEN 0 ELSE c_acctbal END) AS DECIMAL(38, 2)) FROM customer")
def transaction_statements(spark: SparkSession, folder: str) -> DataFrame:
    """Statements over two tables in one transaction, each seeing those before; then a transaction that fails between two tables, of which
    nothing is left."""
    people, orders = dml.VersionedTable(spark, scratch(spark, "customer")), dml.VersionedTable(spark, scratch(spark, "orders"))
    people.commit(table(spark, folder, "customer"))
    orders.commit(table(spark, folder, "orders"))
    with dml.Transaction() as both:
        one, two = both.table(people), both.table(orders)
        one.update({"c_acctbal": F.lit(-1.0)}, F.col("c_custkey") % 10 == 3)
        one.update({"c_acctbal": F.lit(0.0)}, F.col("c_acctbal") == -1.0)
        two.delete(F.col("o_custkey") % 10 == 3)
    lost = dml.Transaction()
    try:
        with lost:
            lost.table(people).truncate()
            lost.table(orders).truncate()
            lost.tables[max(lost.tables)].publish = _crash
    except OSError:
        pass
    money = lambda c: F.sum(F.col(c).cast("decimal(38,2)")).cast("decimal(38,2)").alias("total")
    return orders.read().agg(F.lit("orders").alias("name"), F.count("*").alias("n"), money("o_totalprice")).unionByName(people.read().agg(F.lit("customer").alias("name"), F.count("*").alias("n"), money("c_acctbal")))


def _crash(*_: object) -> int:
    raise OSError("the disk is gone")


@made("SELECT DISTINCT l_orderkey, l_linenumber, status, column_name FROM (SELECT l_orderkey, l_linenumber, 'missing' AS status, NULL AS column_name FROM lineitem WHERE l_orderkey % 1000 = 7 AND l_linenumber = 1 UNION ALL SELECT l_orderkey, l_linenumber, 'changed', 'l_quantity' FROM lineitem WHERE l_orderkey % 1000 = 8 AND l_linenumber = 1 UNION ALL SELECT -l_orderkey, l_linenumber, 'extra', NULL FROM lineitem WHERE l_orderkey % 1000 = 9 AND l_linenumber = 1)")
def content_differences(spark: SparkSession, folder: str) -> DataFrame:
    """A copy of lineitem that lacks rows, has others too much and some with another quantity: found by digests of key buckets and a look
    into those that differ."""
    lines = table(spark, folder, "lineitem")
    some = F.col("l_linenumber") == 1
    at = F.col("l_orderkey") % 1000
    copied = lines.where(~((at == 7) & some)).withColumn("l_quantity", F.when((at == 8) & some, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    copied = copied.unionByName(lines.where((at == 9) & some).withColumn("l_orderkey", -F.col("l_orderkey")))
    found = verify.compare(lines, copied, ["l_orderkey", "l_linenumber"], 65536)
    return found.rows.select("l_orderkey", "l_linenumber", "status", F.explode_outer("columns").alias("column_name"))


@made("SELECT 'one changed' AS copy, 1 AS buckets, 1 AS rows UNION ALL SELECT 'another order', 0, 0")
def content_digests(spark: SparkSession, folder: str) -> DataFrame:
    """A copy with one changed value differs in one bucket and one row; one in another order and other files in none. Digests of the
    source are kept and read again."""
    lines = table(spark, folder, "lineitem")
    path = scratch(spark, "digests")
    keys = ["l_orderkey", "l_linenumber"]
    verify.digests(lines, keys).write.parquet(path)
    top = lines.agg(F.max(F.struct(*keys))).first()[0]
    hit = (F.col("l_orderkey") == top[0]) & (F.col("l_linenumber") == top[1])
    rows = []
    for name, df in (("one changed", lines.withColumn("l_discount", F.when(hit, F.col("l_discount") + 0.5).otherwise(F.col("l_discount")))), ("another order", lines.repartition("l_partkey"))):
        found = verify.compare(lines, df, keys, known=spark.read.parquet(path))
        rows.append((name, len(found.differing), found.rows.count()))
    return spark.createDataFrame(rows, "copy string, buckets int, rows long")


@made("SELECT l_returnflag, round(var_samp(l_extendedprice) / 1e6, 4) AS spread, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS mean FROM lineitem GROUP BY 1 UNION ALL SELECT 'all', round(var_samp(l_extendedprice) / 1e6, 4), round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) FROM lineitem")
def partial_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    """Variance and a weighted mean as aggregates of one's own, by group and over all rows: only states are shuffled."""
    lines = table(spark, folder, "lineitem")
    spread = partial.aggregate(lines, ["l_returnflag"], ["l_extendedprice"], partial.variance("l_extendedprice"), "spread")
    mean = partial.aggregate(lines, ["l_returnflag"], ["l_extendedprice", "l_quantity"], partial.weighted_mean("l_extendedprice", "l_quantity"), "mean")
    every = partial.aggregate(lines, [], ["l_extendedprice"], partial.variance("l_extendedprice"), "spread").join(F.broadcast(partial.aggregate(lines, [], ["l_extendedprice", "l_quantity"], partial.weighted_mean("l_extendedprice", "l_quantity"), "mean")))  # one row each
    both = spread.join(mean, "l_returnflag").unionByName(every.withColumn("l_returnflag", F.lit("all")))
    return both.select("l_returnflag", F.round(F.col("spread") / 1e6, 4).alias("spread"), F.round("mean", 4).alias("mean"))


@made("SELECT event_type, CAST(date_part('day', ts) AS INT) % 6 AS slot, true AS users_within, true AS median_within, count(*) AS rows FROM events GROUP BY ALL")
def sketch_merges(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of each hour, stored, merged to groups of days: within their bounds (four standard errors) of the exact answers."""
    events = table(spark, folder, "events").withColumn("slot", F.dayofmonth("ts") % 6)
    wanted = {"users": sketches.Distinct("user_id"), "values": sketches.Quantiles("value")}
    path = scratch(spark, "sketches")
    sketches.build(events, ["event_type", "slot", F.date_trunc("hour", "ts").alias("hour")], wanted).write.parquet(path)
    merged = sketches.merge(spark.read.parquet(path), ["event_type", "slot"], wanted)
    asked = merged.select("event_type", "slot", "rows", wanted["users"].estimate("users").alias("users"), wanted["values"].estimate("values", 0.5).alias("median"))
    exact = events.join(asked.select("event_type", "slot", "median"), ["event_type", "slot"]).groupBy("event_type", "slot").agg(F.count_distinct("user_id").alias("exact"), F.count_if(F.col("value") < F.col("median")).alias("below"), F.count_if(F.col("value") <= F.col("median")).alias("upto"), F.count("value").alias("n"))
    both = asked.join(exact, ["event_type", "slot"])
    users = F.abs(F.col("users") - F.col("exact")) <= 4 * wanted["users"].error() * F.col("exact") + 1
    slack = wanted["values"].error() * F.col("n") + 1
    median = (F.col("below") - slack <= F.col("n") / 2) & (F.col("upto") + slack >= F.col("n") / 2)
    return both.select("event_type", "slot", users.alias("users_within"), median.alias("median_within"), "rows")


@made("WITH c AS (SELECT event_type, user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY ALL), t AS (SELECT event_type, sum(n) AS total FROM c GROUP BY 1) SELECT event_type, count(*) AS found, true AS bounded FROM c JOIN t USING (event_type) WHERE n >= 0.002 * total GROUP BY 1")
def heavy_hitters(spark: SparkSession, folder: str) -> DataFrame:
    """Users with a five-hundredth of a kind's events: none is missed, from counts by month that were stored and merged."""
    events = table(spark, folder, "events").withColumn("month", F.date_trunc("month", "ts"))
    own = sketches.Hitters("user_id", width=1 << 14, least=0.002)
    cells, some = own.build(events, ["event_type", "month"])
    path = scratch(spark, "hitters")
    cells.write.parquet(f"{path}/cells")
    some.write.parquet(f"{path}/candidates")
    merged = own.merge(spark.read.parquet(f"{path}/cells"), ["event_type"])
    found = own.estimate(merged, spark.read.parquet(f"{path}/candidates"), ["event_type"])
    counts = events.groupBy("event_type", F.col("user_id").alias("value")).agg(F.count("*").alias("exact"))
    total = counts.groupBy("event_type").agg(F.sum("exact").alias("total"))
    checked = found.join(counts, ["event_type", "value"]).join(total, "event_type")
    real = F.col("exact") >= 0.002 * F.col("total")
    bounded = (F.col("n") >= F.col("exact")) & (F.col("n") <= F.col("exact") + 2.72 / own.width * F.col("total"))
    return checked.groupBy("event_type").agg(F.count_if(real).alias("found"), F.bool_and(bounded).alias("bounded"))


@made("SELECT e.event_id, count(b.event_id) - 1 AS n FROM events e LEFT JOIN events b ON b.user_id IS NOT DISTINCT FROM e.user_id AND b.ts >= e.ts - INTERVAL 1 DAY AND b.ts <= e.ts GROUP BY 1")
def interval_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events of the same user in the day before each."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return ranks.near_counts(events, events.select("user_id", F.col("ts").alias("other")), "ts", "other", datetime.timedelta(days=1), ["user_id"]).select("event_id", (F.col("n") - 1).alias("n"))


@made("SELECT CAST(floor((row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) / 400) AS BIGINT) AS page, o_orderkey FROM orders")
def order_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of orders by price, from the layout alone."""
    index = paging.OrderIndex(dml.VersionedTable(spark, scratch(spark, "index")), ["o_totalprice", "o_orderkey"]).build(table(spark, folder, "orders"), 5000)
    return index.numbered(400).select("page", "o_orderkey")


@made("WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS place FROM orders), k AS (SELECT (SELECT count(*) FROM orders) // 800 AS half) SELECT 'number' AS how, o_orderkey FROM p, k WHERE place >= half * 400 AND place < half * 400 + 400 UNION ALL SELECT 'key', o_orderkey FROM p, k WHERE place >= half * 400 + 400 AND place < half * 400 + 800 UNION ALL SELECT 'opened', 1")
def order_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """A page from the middle by its number, and the next one by the key of its last row: each opens two files at most."""
    index = paging.OrderIndex(dml.VersionedTable(spark, scratch(spark, "index")), ["o_totalprice", "o_orderkey"]).build(table(spark, folder, "orders"), 1000)
    half = index.table.state().rows() // 800
    first = index.by_number(half, 400)
    second = index.after(first[-1], 400)
    few = int(index.opened <= 4)
    rows = [("number", r["o_orderkey"]) for r in first] + [("key", r["o_orderkey"]) for r in second] + [("opened", few)]
    return spark.createDataFrame(rows, "how string, o_orderkey long")


@made("SELECT doc_id, text, lang FROM documents UNION ALL SELECT -1, NULL, '' UNION ALL SELECT -2, ' \"a\" , b' || chr(13) || chr(10) || chr(10) || 'c ', ' x ' UNION ALL SELECT -3, '', NULL")
def csv_text_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line ends, quotes and blanks at their ends as CSV files, a task each; every file is read in several tasks."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, None, ""), (-2, ' "a" , b\r\n\nc ', " x "), (-3, "", None)], docs.schema)
    path = scratch(spark, "csv")
    files.write_csv(docs.unionByName(odd), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")  # small files are to be cut as well
    try:
        files.read_csv(spark, path, "doc_id long, text string, lang string").write.parquet(f"{path}-back")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return spark.read.parquet(f"{path}-back")


@made("SELECT 'orders' AS source, count(*) AS source_rows, count(*) AS copied_rows, CAST(NULL AS BIGINT) AS destination_rows, true AS verified FROM orders UNION ALL SELECT 'customer', count(*), count(*), NULL, true FROM customer")
def verified_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Copies into a store that doesn't count: verified by their content, which is read back and compared by digests."""
    root = scratch(spark, "copies")
    specs = [copy.CopySpec("orders", "a", ("o_orderkey",), {"o_orderkey": "id"}, ("o_orderpriority",)), copy.CopySpec("customer", "b", ("c_custkey",))]
    done = copy.copy_tables(specs, lambda n: table(spark, folder, n), lambda df, n, batch_size: df.write.option("maxRecordsPerFile", batch_size).parquet(f"{root}/{n}"), lambda n: None, options=copy.CopyOptions(batch_size=5000), back=lambda n: spark.read.parquet(f"{root}/{n}"))
    return done.rows(spark).select("source", "source_rows", "copied_rows", "destination_rows", "verified")


@made("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text, CAST(NULL AS BIGINT) AS absent FROM events")
def json_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Properties of events, parsed once each: a number, the same as text, and one that isn't there."""
    events = table(spark, folder, "events").select("event_id", nested.json_variant(F.col("props")).alias("props"))
    at = lambda path, kind: nested.variant_value(F.col("props"), path, kind)
    return events.select("event_id", at("k", "bigint").alias("k"), at("k", "string").alias("k_text"), at("absent.there", "bigint").alias("absent"))


@made("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_id % 7 = 0 THEN concat('no', props) END AS broken FROM events")
def json_typed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Properties of events as typed columns; every seventh text is broken and is kept beside them."""
    props = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("no"), "props")).otherwise(F.col("props"))
    return nested.json_rows(table(spark, folder, "events").select("event_id", props.alias("props")), "props", "k long", "broken")


@made("""SELECT * FROM (SELECT 'nation2' AS destination, count(*) AS n, 'n_nationkey,n_name,n_regionkey' AS columns, 2 AS cleared FROM nation
UNION ALL SELECT 'customer2', count(*), 'c_custkey,c_acctbal', 1 FROM customer UNION ALL SELECT 'part2', 0, 'p_partkey', NULL)""")
def copies_of_what_is_there(spark: SparkSession, folder: str) -> DataFrame:
    """Tables with rows to clear are cleared last to first; one that isn't there yet is made, of a source without rows with its schema
    alone; a source that isn't there is passed over; a copy onto itself, or one whose clearing removes a source, is refused before anything is touched."""
    sources = {"nation": table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey"), "customer": table(spark, folder, "customer").select("c_custkey", "c_acctbal"), "part": table(spark, folder, "part").select("p_partkey").where(F.lit(False))}
    places = {f"{s}2": dml.VersionedTable(spark, scratch(spark, s)) for s in (*sources, "absent")}
    places["nation2"].commit(sources["nation"].union(sources["nation"]))
    places["customer2"].commit(sources["customer"])
    cleared: list[str] = []

    def read(name: str) -> DataFrame:
        if name not in sources:
            raise FileNotFoundError(name)
        return sources[name]

    def clear(name: str) -> None:
        places[name].truncate()
        cleared.append(name)

    def write(df: DataFrame, name: str) -> None:
        places[name].append(df) if places[name].number() else places[name].commit(df)

    count = lambda name: places[name].state().rows()
    for wrong in ([copy.CopySpec("nation", "NATION")], [copy.CopySpec("nation", "customer"), copy.CopySpec("customer", "customer2")]):
        try:
            copy.copy_tables(wrong, read, write, count, clear)
        except copy.CopyError:
            continue
        raise AssertionError("such a copy must be refused")
    specs = [copy.CopySpec("customer", "customer2"), copy.CopySpec("absent", "absent2"), copy.CopySpec("nation", "nation2"), copy.CopySpec("part", "part2")]
    copy.copy_tables(specs, read, write, count, clear, options=copy.CopyOptions(missing_is_empty=True))
    order = {name: i for i, name in enumerate(reversed(cleared), 1)}
    rows = [(name, place.read().count(), ",".join(place.state().schema.names), order.get(name)) for name, place in places.items() if place.number()]
    return spark.createDataFrame(rows, "destination string, n long, columns string, cleared int")
