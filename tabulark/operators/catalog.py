"""Catalog metadata in fixed row shapes, declared keys, and checks of them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut


@dataclass
class Keys:
    """Declared primary keys, indexes (their columns may be expressions or descend; with included columns and a filter)
    and foreign keys (of several columns, with what a delete does): Spark has none of its own."""

    primary: dict[str, tuple[str, ...]] = field(default_factory=dict)
    indexes: list[tuple[str, str, tuple[str, ...], bool]] = field(default_factory=list)
    foreign: list[tuple[str, tuple[str, ...], str, tuple[str, ...]]] = field(default_factory=list)

    details: dict[str, dict] = field(default_factory=dict)

    def index_rows(self, spark: SparkSession) -> DataFrame:
        rows = [(t, f"pk_{t}", c, i + 1, True, True, False, False, None) for t, cs in self.primary.items() for i, c in enumerate(cs)]
        for t, n, cs, unique in self.indexes:
            more = self.details.get(n, {})
            rows += [(t, n, c.removesuffix(" DESC"), i + 1, unique, False, c.endswith(" DESC"), False, more.get("filter")) for i, c in enumerate(cs)]
            rows += [(t, n, c, len(cs) + i + 1, unique, False, False, True, more.get("filter")) for i, c in enumerate(more.get("included", ()))]
        return spark.createDataFrame(rows, "table_name string, index_name string, column_name string, ordinal int, is_unique boolean, is_primary_key boolean, descending boolean, included boolean, filter string")

    def foreign_rows(self, spark: SparkSession) -> DataFrame:
        """A child whose parent columns aren't given refers to the parent's primary key."""
        rows = []
        for t, cs, p, pcs in self.foreign:
            name = f"fk_{t}_{'_'.join(cs)}"
            rows += [(name, t, c, p, pc, i + 1, self.details.get(name, {}).get("on_delete", "NO ACTION")) for i, (c, pc) in enumerate(zip(cs, pcs or self.primary[p], strict=True))]
        return spark.createDataFrame(rows, "constraint_name string, table_name string, column_name string, referenced_table string, referenced_column string, ordinal int, on_delete string")

    def violations(self, frames: dict[str, DataFrame]) -> DataFrame:
        """(constraint_name, rows): how many rows break each primary or foreign key; a key that holds has 0."""
        found = []
        for t, cs in self.primary.items():
            if t in frames:
                twice = frames[t].groupBy(*cs).count()
                bad = F.sum(F.when((F.col("count") > 1) | reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cs]), F.col("count")).otherwise(0))
                found.append(twice.agg(F.coalesce(bad, F.lit(0)).alias("rows")).select(F.lit(f"pk_{t}").alias("constraint_name"), "rows"))
        for t, cs, p, pcs in self.foreign:
            if t in frames and p in frames:
                lost = orphans(frames[t], frames[p], list(zip(cs, pcs or self.primary[p], strict=True)))
                found.append(lost.agg(F.count("*").alias("rows")).select(F.lit(f"fk_{t}_{'_'.join(cs)}").alias("constraint_name"), "rows"))
        return reduce(DataFrame.unionByName, found)


def databases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d.name, d.description) for d in spark.catalog.listDatabases()], "name string, description string")


def tables(spark: SparkSession, database: str | None = None, views: bool = True) -> DataFrame:
    rows = [(".".join(t.namespace or []) or None, t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database) if views or "VIEW" not in t.tableType and not t.isTemporary]
    return spark.createDataFrame(rows, "schema string, name string, type string, temporary boolean")


def columns(df: DataFrame, table: str, primary: tuple[str, ...] = (), identity: tuple[str, ...] = (), generated: tuple[str, ...] = ()) -> DataFrame:
    """A row a column: place, type, nullability, length or precision and scale, default and comment where the schema has
    them, and what is declared of it."""
    rows = []
    for i, f in enumerate(df.schema):
        more, kind = f.metadata or {}, f.dataType.simpleString()
        length = getattr(f.dataType, "length", None)
        rows.append((table, f.name, i + 1, kind, f.nullable, length, getattr(f.dataType, "precision", None), getattr(f.dataType, "scale", None), more.get("CURRENT_DEFAULT"), more.get("comment"), f.name in primary, f.name in identity, f.name in generated))
    return df.sparkSession.createDataFrame(rows, "table_name string, column_name string, ordinal int, data_type string, nullable boolean, length int, precision int, scale int, default_value string, comment string, is_primary_key boolean, is_identity boolean, is_generated boolean")


def routines(spark: SparkSession, pattern: str | None = None) -> DataFrame:
    return spark.createDataFrame([(f.name, f.className, f.isTemporary) for f in spark.catalog.listFunctions(pattern=pattern)], "name string, class string, temporary boolean")


def orphans(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Child rows whose key is not null and not among the parent's."""
    keys = parent.select(*[F.col(p).alias(f"_p_{c}") for c, p in on])
    sound = [F.col(c) == F.col(f"_p_{c}") for c, _ in on]
    return child.dropna(subset=[c for c, _ in on]).join(keys, sound, "left_anti")


def create_table_sql(df: DataFrame, name: str, using: str = "parquet", primary: tuple[str, ...] = (), partitions: tuple[str, ...] = (), comment: str | None = None) -> str:
    """CREATE TABLE text for a schema; nullability is kept, key columns are not null."""
    quoted = lambda s: ".".join("`" + p.replace("`", "``") + "`" for p in s.split("."))
    body = ", ".join("`" + f.name.replace("`", "``") + "` " + f.dataType.simpleString() + ("" if f.nullable and f.name not in primary else " NOT NULL") for f in df.schema)
    text = f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({body}) USING {using}"
    if partitions:
        text += f" PARTITIONED BY ({', '.join(map(quoted, partitions))})"
    return text + (" COMMENT '" + comment.replace("\\", "\\\\").replace("'", "\\'") + "'" if comment else "")


def ensure_table(df: DataFrame, name: str, using: str = "parquet") -> bool:
    """Make a table (and its database) that fits df, if it isn't there; whether it was made."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        return False
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.rsplit('.', 1)[0].replace('`', '``')}`")
    spark.sql(create_table_sql(df, name, using))
    return True


def script(spark: SparkSession, name: str) -> str:
    """The statement that makes a table as it is."""
    return spark.sql(f"SHOW CREATE TABLE {name}").first()[0]


def reachable(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(node, depth): what can be reached over edges (parent, child) from the nodes of start (node), with the fewest
    steps. Rows are as many as nodes; each round adds what is new, until nothing is."""
    edge, rounds = edges.select("parent", "child").distinct(), [cut(start.select("node").distinct().withColumn("depth", F.lit(0)))]
    while rounds[-1].limit(1).count():  # each round writes what is new; what was found stays where it is
        new = rounds[-1].join(edge, F.col("node") == F.col("parent")).select(F.col("child").alias("node")).distinct()
        rounds.append(cut(new.join(reduce(DataFrame.unionByName, rounds).select("node"), "node", "left_anti").withColumn("depth", F.lit(len(rounds)))))
    return reduce(DataFrame.unionByName, rounds)


def closure(edges: DataFrame) -> DataFrame:
    """(ancestor, descendant) pairs reachable over edges (parent, child), by doubling until nothing is new. There are as
    many pairs as there are: for what one node reaches, use reachable()."""
    found = cut(edges.select(F.col("parent").alias("ancestor"), F.col("child").alias("descendant")).distinct())
    count = found.count()
    while True:
        right = found.select(F.col("ancestor").alias("_a"), F.col("descendant").alias("_d"))
        more = found.join(right, F.col("descendant") == F.col("_a")).select("ancestor", F.col("_d").alias("descendant"))
        found = cut(found.union(more).distinct())
        if (now := found.count()) == count:
            return found
        count = now
