"""A Spark data source for SQLite files (a Python DataSource): partitioned reads of tables, views and queries; writes
that are all there or not at all; maintenance.

The file must be reachable from every executor (a shared mount), as SQLite has no server.
"""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sqlite3
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, WriterCommitMessage
from pyspark.sql.types import BinaryType, BooleanType, ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from ..session import ship

#: Parameters that one statement may have, and rows of one INSERT.
PARAMETERS, ROWS = 999, 500


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def affinity(declared: str):
    """SQLite's rules for declared types, in their order."""
    text = (declared or "").upper()
    if "INT" in text or "BOOL" in text:
        return LongType()
    if any(k in text for k in ("CHAR", "CLOB", "TEXT", "DATE", "TIME")):
        return StringType()
    if "BLOB" in text:
        return BinaryType()
    if any(k in text for k in ("REAL", "FLOA", "DOUB", "DEC", "NUM")):
        return DoubleType()
    return StringType()


def connect(path: str, write: bool = False) -> sqlite3.Connection:
    if write:
        return sqlite3.connect(path, timeout=600, isolation_level=None)
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True, timeout=60)


class SqliteSource(DataSource):
    """Options: path; table (or view) or query; partitions (default 1; tables with a rowid are cut in ranges of it)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def _relation(self) -> str:
        if ("table" in self.options) == ("query" in self.options):
            raise ValueError("give a table or a query")
        return quoted(self.options["table"]) if "table" in self.options else f"({self.options['query'].rstrip().rstrip(';')})"

    def schema(self) -> StructType:
        connection = connect(self.options["path"])
        try:
            if "table" in self.options:
                found = connection.execute(f"PRAGMA table_xinfo({quoted(self.options['table'])})").fetchall()
                if not found:
                    raise ValueError(f"no table {self.options['table']}")
                return StructType([StructField(c[1], affinity(c[2]), not c[3]) for c in found if c[6] != 1])
            # a query's types are those of its first values: SQLite has no others
            cursor = connection.execute(f"SELECT * FROM {self._relation()} LIMIT 200")
            rows, names = cursor.fetchall(), [d[0] for d in cursor.description]
        finally:
            connection.close()
        kinds = {int: LongType(), float: DoubleType(), bytes: BinaryType()}
        seen = [{type(r[i]) for r in rows} - {type(None)} for i in range(len(names))]
        pick = lambda s: kinds.get(next(iter(s)), StringType()) if len(s) == 1 else DoubleType() if s == {int, float} else StringType()
        return StructType([StructField(n, pick(s), True) for n, s in zip(names, seen, strict=True)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(dict(self.options), schema, self._relation())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return SqliteStream(dict(self.options), schema, self._relation())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return SqliteWriter(dict(self.options), schema, overwrite)


def _as(kind, value: Any) -> Any:
    """SQLite's values are of any type, whatever their column's."""
    if value is None or isinstance(kind, BinaryType) and isinstance(value, bytes):
        return value
    if isinstance(kind, LongType):
        return int(value)
    if isinstance(kind, DoubleType):
        return float(value)
    if isinstance(kind, BinaryType):
        return str(value).encode()
    return value.decode() if isinstance(value, bytes) else str(value)


#: Comparisons that are pushed down, with SQLite's signs.
SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def condition(filter_: Filter, kinds: dict[str, Any]) -> tuple[str, list] | None:
    """A filter as SQLite's condition, with its parameters; None if SQLite could mean something else by it. Values of any type can stand in any
    column, so a condition also asks for a type that compares alike: what isn't of it goes to Spark, which looks at all again."""
    if isinstance(filter_, Not):
        return (f"{quoted(filter_.child.attribute[0])} IS NOT NULL", []) if isinstance(filter_.child, IsNull) and len(filter_.child.attribute) == 1 else None
    column = getattr(filter_, "attribute", ())
    if len(column) != 1 or column[0] not in kinds:
        return None
    name, kind = quoted(column[0]), kinds[column[0]]
    if isinstance(filter_, (IsNull, IsNotNull)):
        return f"{name} IS {'NOT ' * isinstance(filter_, IsNotNull)}NULL", []
    values = list(filter_.value) if isinstance(filter_, In) else [filter_.value] if type(filter_) in SIGNS else []
    number = isinstance(kind, (LongType, DoubleType)) and all(isinstance(v, (int, float)) and not isinstance(v, bool) and v == v for v in values)
    text = isinstance(kind, StringType) and all(isinstance(v, str) and "\x00" not in v for v in values)
    if not values or not (number or text):
        return None
    odd = f"typeof({name}) NOT IN ('integer', 'real')" if number else f"typeof({name}) <> 'text'"
    collate = "" if number else " COLLATE BINARY"
    test = f"{name}{collate} IN ({', '.join('?' * len(values))})" if isinstance(filter_, In) else f"{name} {SIGNS[type(filter_)]} ?{collate}"
    return f"({test} OR ({name} IS NOT NULL AND {odd}))", values


class SqliteReader(DataSourceReader):
    """Options partitions and column: into how many ranges of which whole numbers (default: the rowid of a table) a read is cut."""

    def __init__(self, options: dict, schema: StructType, relation: str):
        self.options, self.schema, self.relation = options, schema, relation
        self.conditions: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        kinds = {f.name: f.dataType for f in self.schema}
        for filter_ in filters:
            found = condition(filter_, kinds)
            if found:
                self.conditions.append(found)
            yield filter_  # Spark looks again: SQLite only leaves out what can't match

    def partitions(self) -> list[InputPartition]:
        n = int(self.options.get("partitions", 1))
        if n >= 2 and "column" in self.options:
            return self._ranges(n, quoted(self.options["column"]))
        if n < 2 or "query" in self.options:
            return [InputPartition(None)]
        connection = connect(self.options["path"])
        try:
            low, high = connection.execute(f"SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) FROM {self.relation}").fetchone()
        except sqlite3.OperationalError:  # views, and tables without a rowid
            return [InputPartition(None)]
        finally:
            connection.close()
        if not isinstance(low, int):
            return [InputPartition(None)]
        step = max(1, -(-(high - low + 1) // n))
        return [InputPartition((a, min(high, a + step - 1))) for a in range(low, high + 1, step)] or [InputPartition((0, -1))]

    def _ranges(self, n: int, column: str) -> list[InputPartition]:
        """Ranges of a column of whole numbers; what else there is in it (nulls, texts) is a range of its own."""
        connection = connect(self.options["path"])
        try:
            low, high = connection.execute(f"SELECT min({column}), max({column}) FROM {self.relation} WHERE typeof({column}) = 'integer'").fetchone()
        finally:
            connection.close()
        rest = InputPartition((f"typeof({column}) <> 'integer'", []))
        if low is None:
            return [rest]
        step = max(1, -(-(high - low + 1) // n))
        return [InputPartition((f"typeof({column}) = 'integer' AND {column} BETWEEN ? AND ?", [a, min(high, a + step - 1)])) for a in range(low, high + 1, step)] + [rest]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        tests = list(self.conditions)
        if partition.value is not None:
            tests.append(partition.value if isinstance(partition.value[0], str) else ("rowid BETWEEN ? AND ?", list(partition.value)))
        yield from rows_of(self.options["path"], self.relation, self.schema, tests)


def rows_of(path: str, relation: str, schema: StructType, tests: list[tuple[str, list]]) -> Iterator[tuple]:
    names, kinds = ", ".join(quoted(f.name) for f in schema), [f.dataType for f in schema]
    where = f" WHERE {' AND '.join(t for t, _ in tests)}" if tests else ""
    connection = connect(path)
    try:
        for row in connection.execute(f"SELECT {names} FROM {relation}{where}", [v for _, values in tests for v in values]):
            yield tuple(_as(k, v) for k, v in zip(kinds, row, strict=True))
    finally:
        connection.close()


class SqliteStream(DataSourceStreamReader):
    """New rows of a table that only grows, by rowid: the offset is the last one read, which Spark keeps in its checkpoint; a stopped stream goes
    on after it. A batch is cut into ranges, a task each."""

    def __init__(self, options: dict, schema: StructType, relation: str):
        if "table" not in options:
            raise ValueError("a stream reads a table")
        self.options, self.schema, self.relation = options, schema, relation

    def initialOffset(self) -> dict:
        return {"rowid": int(self.options.get("start", 0))}

    def latestOffset(self) -> dict:
        connection = connect(self.options["path"])
        try:
            return {"rowid": max(self.initialOffset()["rowid"], connection.execute(f"SELECT coalesce(max(rowid), 0) FROM {self.relation}").fetchone()[0])}
        finally:
            connection.close()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, high, n = start["rowid"] + 1, end["rowid"], int(self.options.get("partitions", 1))
        step = max(1, -(-(high - low + 1) // n))
        return [InputPartition((a, min(high, a + step - 1))) for a in range(low, high + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from rows_of(self.options["path"], self.relation, self.schema, [("rowid BETWEEN ? AND ?", list(partition.value))])

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Staged(WriterCommitMessage):
    """A task's rows, in a file of its own beside the database."""

    path: str
    rows: int


def _plain(value: Any) -> Any:
    """A value that SQLite stores: exact decimals and times as text."""
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat(sep=" ") if isinstance(value, datetime.datetime) else value.isoformat()
    if isinstance(value, bytearray):
        return bytes(value)
    return value


class SqliteWriter(DataSourceWriter):
    """Tasks write their rows to files of their own; the commit moves all of them into the table in one transaction,
    so a failed or repeated task leaves nothing behind and nothing twice. Zero rows make no table, unless the option
    create is true."""

    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.options, self.schema, self.overwrite, self.job = options, schema, overwrite, uuid.uuid4().hex
        integers = (LongType, IntegerType, ShortType, ByteType, BooleanType)
        kind = lambda t: "INTEGER" if isinstance(t, integers) else "REAL" if isinstance(t, (DoubleType, FloatType)) else "BLOB" if isinstance(t, BinaryType) else "TEXT"
        self.body = ", ".join(f"{quoted(f.name)} {kind(f.dataType)}{'' if f.nullable else ' NOT NULL'}" for f in schema)

    def write(self, rows: Iterator) -> Staged:
        from pyspark import TaskContext

        context = TaskContext.get()
        path = f"{self.options['path']}.part-{self.job}-{context.partitionId()}-{context.taskAttemptId()}"
        width = len(self.schema)
        batch = max(1, min(ROWS, PARAMETERS // width))
        one = "(" + ", ".join("?" * width) + ")"
        connection, held, n = connect(path, True), [], 0
        try:
            connection.execute("PRAGMA synchronous = OFF")
            connection.execute(f"CREATE TABLE rows ({', '.join(f'c{i}' for i in range(width))})")
            connection.execute("BEGIN")
            for row in rows:
                held.append(tuple(map(_plain, row)))
                n += 1
                if len(held) == batch:
                    connection.execute("INSERT INTO rows VALUES " + ", ".join([one] * batch), [v for r in held for v in r])
                    held.clear()
            if held:
                connection.execute("INSERT INTO rows VALUES " + ", ".join([one] * len(held)), [v for r in held for v in r])
            connection.execute("COMMIT")
        except BaseException:
            connection.close()
            _remove(path)
            raise
        connection.close()
        return Staged(path, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        parts = [m for m in messages if m is not None]
        table, names = quoted(self.options["table"]), ", ".join(quoted(f.name) for f in self.schema)
        connection = connect(self.options["path"], True)
        try:
            connection.execute("BEGIN IMMEDIATE")
            if self.overwrite:
                connection.execute(f"DROP TABLE IF EXISTS {table}")
            if any(p.rows for p in parts) or self.options.get("create", "false") == "true":
                connection.execute(f"CREATE TABLE IF NOT EXISTS {table} ({self.body})")
            one = "(" + ", ".join("?" * len(self.schema)) + ")"
            for part in parts:
                source = connect(part.path)
                cursor = source.execute("SELECT * FROM rows")
                while held := cursor.fetchmany(5000):
                    connection.executemany(f"INSERT INTO {table} ({names}) VALUES {one}", held)
                source.close()
            connection.execute("COMMIT")
        except BaseException:
            if connection.in_transaction:
                connection.execute("ROLLBACK")
            raise
        finally:
            connection.close()
            self._clean()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        """Files of all tasks of this job, also of those that failed or were killed."""
        for path in glob.glob(f"{glob.escape(self.options['path'])}.part-{self.job}-*"):
            os.remove(path)


def _remove(path: str) -> None:
    for end in ("", "-journal", "-wal", "-shm"):
        if os.path.exists(path + end):
            os.remove(path + end)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteSource)


def bulk_insert(df: DataFrame, path: str, table: str, mode: str = "append") -> int:
    """Rows written, counted by the job that writes."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    register(df.sparkSession)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("sqlite").options(path=path, table=table).mode(mode).save()
    return seen.get["rows"]


# maintenance: on one file, in the driver


def backup(path: str, target: str, pages: int = 0) -> int:
    """Copy a database while it may be in use, whole or so many pages at a time; the pages copied."""
    copied = 0

    def progress(status: int, remaining: int, total: int) -> None:
        nonlocal copied
        copied = total - remaining

    source, destination = connect(path), sqlite3.connect(target)
    try:
        source.backup(destination, pages=pages or -1, progress=progress)
    finally:
        destination.close()
        source.close()
    return copied


def checkpoint(path: str, mode: str = "PASSIVE") -> tuple[int, int, int]:
    """Move the write-ahead log into the database: busy, pages in the log, pages moved."""
    if mode not in ("PASSIVE", "FULL", "RESTART", "TRUNCATE"):
        raise ValueError(f"unknown mode: {mode}")
    connection = connect(path, True)
    try:
        return connection.execute(f"PRAGMA wal_checkpoint({mode})").fetchone()
    finally:
        connection.close()


def optimize(path: str, vacuum: bool = False) -> None:
    connection = connect(path, True)
    try:
        connection.execute("PRAGMA optimize")
        if vacuum:
            connection.execute("VACUUM")
    finally:
        connection.close()


def check(path: str, quick: bool = False) -> list[str]:
    """Problems of a database; none if it is sound."""
    connection = connect(path)
    try:
        found = [r[0] for r in connection.execute("PRAGMA quick_check" if quick else "PRAGMA integrity_check")]
        found += [f"{r[0]}: row {r[1]} has no parent in {r[2]}" for r in connection.execute("PRAGMA foreign_key_check")]
    finally:
        connection.close()
    return [f for f in found if f != "ok"]


def diagnostics(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) of a database's settings and sizes."""
    connection = connect(path)
    try:
        names = ("page_size", "page_count", "freelist_count", "journal_mode", "user_version", "encoding", "auto_vacuum", "foreign_keys", "schema_version")
        rows = [(n, str(connection.execute(f"PRAGMA {n}").fetchone()[0])) for n in names]
    finally:
        connection.close()
    return spark.createDataFrame([*rows, ("file_size", str(os.path.getsize(path)))], "name string, value string")
