"""Pages of a table, and of sources that hand out pages.

A page by offset costs what all pages before it cost; here a page starts after the last key of the one before, which a
scan can push down. Paging without an order is refused unless it is allowed: its pages may overlap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import cut, ship
from . import ranks
from .dml import VersionedTable
from .versions import File, State


class PagingError(ValueError):
    """Pages can't be told apart."""


def require_order(order: tuple[str, ...] | list[str], allow_unordered: bool = False) -> None:
    if not order and not allow_unordered:
        raise PagingError("paging needs columns to order by; allow_unordered accepts pages that may overlap")


def after(keys: list[str], last: Row) -> Column:
    """Rows that come after a row in order of keys (ascending, nulls last)."""
    tests = []
    for i, key in enumerate(keys):
        same = [F.col(k).eqNullSafe(F.lit(last[k])) for k in keys[:i]]
        further = F.lit(False) if last[key] is None else (F.col(key) > F.lit(last[key])) | F.col(key).isNull()
        tests.append(reduce(lambda a, b: a & b, [*same, further]))
    return reduce(lambda a, b: a | b, tests)


def page(df: DataFrame, keys: list[str], size: int, last: Row | None = None, allow_unordered: bool = False) -> DataFrame:
    """At most `size` rows after `last` (None: from the start), in order of keys, which must tell rows apart."""
    if size <= 0:
        raise PagingError("a page has one row or more")
    require_order(keys, allow_unordered)
    if not keys:
        return df.limit(size)
    rest = df if last is None else df.where(after(keys, last))
    return rest.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(size)


def pages(df: DataFrame, keys: list[str], size: int) -> Iterator[list[Row]]:
    """All pages, one at a time in the driver: for consumers that page. A short page is the last. Rows are sorted once and come range by
    range (session.cut), so all pages cost one sort and not a scan each."""
    if size <= 0:
        raise PagingError("a page has one row or more")
    require_order(keys)
    order = [F.col(k).asc_nulls_last() for k in keys]
    held: list[Row] = []
    for row in cut(df.repartitionByRange(*order).sortWithinPartitions(*order)).toLocalIterator():
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def numbered(df: DataFrame, keys: list[str], size: int, name: str = "page") -> DataFrame:
    """All rows with the number of their page (0, 1, ..) in order of keys, without passing the driver."""
    if size <= 0:
        raise PagingError("a page has one row or more")
    require_order(keys)
    rows = ranks.number_rows(df, [F.col(k).asc_nulls_last() for k in keys], "_number")
    return rows.withColumn(name, F.floor((F.col("_number") - 1) / size)).drop("_number")


#: Files that one task of a layout writes at most.
FILES = 64


class OrderIndex:
    """A versioned table laid out in order of keys: each file holds a range of them, and the log knows rows, least and greatest key of each. So
    a page by number or by key opens the files that it lies in (two at most if pages are smaller than files), and all pages one
    after the other read each file once. The layout holds for the version that build() makes; a table that was changed since is built anew."""

    def __init__(self, table: VersionedTable, keys: list[str]):
        require_order(keys)
        self.table, self.keys = table, keys
        self.order = [F.col(k).asc_nulls_last() for k in keys]
        self.opened = 0

    def build(self, df: DataFrame, rows: int = 1_000_000) -> OrderIndex:
        """Lay df out in files of so many rows (the last: the rest), as the table's next version. A task writes several files if they are
        small: ranges are as many as a million rows or FILES files each need, and not one a file, each with a sample in the driver."""
        per = rows * max(1, min(FILES, 1_000_000 // rows))
        placed = ranks.number_rows(df, self.order, "_number")
        ranges = max(1, -(-(placed.agg(F.max("_number")).first()[0] or 0) // per))
        dealt = placed.withColumn("_range", F.floor((F.col("_number") - 1) / per).cast("int")).repartitionById(ranges, "_range")
        self.table.commit(dealt.sortWithinPartitions("_number").drop("_number", "_range"), file_rows=rows)
        return self

    def _files(self) -> tuple[State, list[File]]:
        state = self.table.state()
        if len({f.path.split("/")[0] for f in state.files.values()}) > 1:
            raise PagingError("the table has changed since it was laid out")
        return state, sorted(state.files.values(), key=lambda f: f.path)  # ranges, and files within, are numbered in file names

    def _read(self, state: State, files: list[File]) -> DataFrame:
        self.opened += len(files)
        return self.table.read_files(state, [f.path for f in files])

    def by_number(self, number: int, size: int) -> list[Row]:
        """Page 0, 1, .. of `size` rows."""
        if size <= 0 or number < 0:
            raise PagingError("a page has one row or more, and a number from 0 on")
        state, files = self._files()
        first, before, some, skip = number * size, 0, [], 0
        for f in files:
            if before + f.rows > first and before < first + size:
                skip = first - before if not some else skip
                some.append(f)
            before += f.rows
        return self._read(state, some).orderBy(*self.order).offset(skip).limit(size).collect() if some else []

    def after(self, last: Row | None, size: int) -> list[Row]:
        """The page of rows after `last` (None: from the start)."""
        if size <= 0:
            raise PagingError("a page has one row or more")
        state, files = self._files()
        kind = state.schema[self.keys[0]].dataType
        if last is not None and last[self.keys[0]] is not None:
            files = [f for f in files if not (b := f.bounds(self.keys[0], kind)) or b[1] is None or f.stats[self.keys[0]][2] or b[1] >= last[self.keys[0]]]
        rows: list[Row] = []
        for i, f in enumerate(files):
            df = self._read(state, [f])
            rows += (df if last is None else df.where(after(self.keys, last))).orderBy(*self.order).limit(size - len(rows)).collect()
            if len(rows) >= size or i == len(files) - 1:
                break
        return rows

    def pages(self, size: int) -> Iterator[list[Row]]:
        """All pages, one at a time in the driver; files are streamed one after the other, each once."""
        if size <= 0:
            raise PagingError("a page has one row or more")
        state, files = self._files()
        held: list[Row] = []
        for f in files:
            for row in self._read(state, [f]).coalesce(1).sortWithinPartitions(*self.order).toLocalIterator():
                held.append(row)
                if len(held) == size:
                    yield held
                    held = []
        if held:
            yield held

    def numbered(self, size: int) -> DataFrame:
        """All rows with the number of their page, without passing the driver: a file's rows start where those of the files before it end."""
        state, files = self._files()
        starts, before = [], 0
        for f in files:
            starts.append((f.path.split("/")[1], before))
            before += f.rows
        known = F.broadcast(self.table.spark.createDataFrame(starts, "_file string, _before long"))  # a row a file
        rows = self.table.read_files(state, [f.path for f in files]).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        return rows.join(known, "_file").withColumn("page", F.floor((F.col("_before") + F.col("_row")) / size)).drop("_file", "_row", "_before")


@dataclass(frozen=True)
class Page:
    rows: list
    token: str | None = None


def by_token(fetch: Callable[[str | None], Page], known: int | None = None) -> Iterator[list]:
    """Pages of a source that continues by token. Short and empty pages are legal while there is a token; a token seen
    before, or more rows than are known to exist, is an error."""
    token, seen, n = None, set(), 0
    while True:
        found = fetch(token)
        n += len(found.rows)
        if known is not None and n > known:
            raise PagingError(f"{n} rows came where {known} are known")
        yield found.rows
        token = found.token
        if token is None:
            return
        if token in seen:
            raise PagingError(f"token comes again: {token}")
        seen.add(token)


class EntityStore:
    """What a paged key-value source offers: subclass it with the calls of a service. Must pickle: executors call it."""

    def partition_keys(self) -> list[str]:
        raise NotImplementedError

    def fetch(self, partition_key: str, filter_: str | None, select: list[str], token: str | None) -> Page:
        """A page of entities (dictionaries with PartitionKey and RowKey)."""
        raise NotImplementedError


def entities(spark: SparkSession, store: EntityStore, schema: str, filter_: str | None = None) -> DataFrame:
    """A paged key-value source as a DataFrame: a task for each partition key, which follows the tokens. The keys are
    read whatever is selected; what an entity lacks is null."""
    ship(spark)
    found = _parse_datatype_string(schema)
    names = [f.name for f in found]
    if missing := {"PartitionKey", "RowKey"} - set(names):
        found = StructType(_parse_datatype_string(", ".join(f"{m} string" for m in sorted(missing))).fields + found.fields)
        names = [f.name for f in found]

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return [InputPartition(k) for k in store.partition_keys()]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            for rows in by_token(lambda token: store.fetch(partition.value, filter_, names, token)):
                for row in rows:
                    yield tuple(row.get(n) for n in names)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return "entities"

        def schema(self) -> StructType:
            return found

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader()

    spark.dataSource.register(Source)
    return spark.read.format("entities").load()
