"""Statements that change a table: insert, update, delete, upsert, in the builder's manner.

A statement is an immutable value; run() applies it to a VersionedTable in one job and gives the rows affected. Column
names and values are taken as they are: no text is built from them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dml import VersionedTable
from .query import Binder, Query, QueryError, Raw, _predicate


def _rows(spark: SparkSession, table: DataFrame, columns: tuple[str, ...], rows: tuple[tuple, ...]) -> DataFrame:
    types = {f.name.lower(): f for f in table.schema}
    if unknown := [c for c in columns if c.lower() not in types]:
        raise QueryError(f"unknown columns: {unknown}")
    schema = type(table.schema)([types[c.lower()] for c in columns])
    return spark.createDataFrame([tuple(r) for r in rows], schema)


@dataclass(frozen=True)
class Insert:
    """INSERT INTO table (columns) VALUES ..: as many values as columns in each row; a value may be null."""

    columns: tuple[str, ...]
    rows: tuple[tuple, ...] = ()

    def values(self, *row: Any) -> Insert:
        if len(row) != len(self.columns):
            raise QueryError(f"{len(row)} values for {len(self.columns)} columns")
        return replace(self, rows=(*self.rows, row))

    def run(self, spark: SparkSession, table: VersionedTable) -> int:
        if not self.rows:
            raise QueryError("no values to insert")
        return table.append(_rows(spark, table.read(), self.columns, self.rows))


def insert_into(*columns: str) -> Insert:
    if not columns or len({c.lower() for c in columns}) < len(columns):
        raise QueryError("an insert names one column or more, each once")
    return Insert(columns)


@dataclass(frozen=True)
class Change:
    """UPDATE (with changes) or DELETE, of rows for which the predicate is true."""

    verb: str
    changes: tuple[tuple[str, Any], ...] = ()
    tests: Query = Query()

    def set(self, column: str, value: Any) -> Change:
        if self.verb != "update":
            raise QueryError("only an update sets columns")
        if value is None:
            raise QueryError("null is no value here; use set_null")
        return replace(self, changes=(*self.changes, (column, value)))

    def set_null(self, column: str) -> Change:
        return replace(self, changes=(*self.changes, (column, None)))

    def where(self, *args: Any) -> Change:
        return replace(self, tests=self.tests.where(*args))

    def matching(self, tests: Query) -> Change:
        """The predicate of a query, whatever its shape."""
        return replace(self, tests=tests)

    def run(self, spark: SparkSession, table: VersionedTable) -> int:
        if self.verb == "update" and not self.changes:
            raise QueryError("an update sets one column or more")
        binder = Binder()
        test = _predicate(self.tests.tests, binder) if self.tests.tests else "true"

        def hit(df: DataFrame) -> DataFrame:
            view = f"t{uuid.uuid4().hex}"
            df.createOrReplaceTempView(view)
            try:
                return spark.sql(f"SELECT *, ({test}) AS _hit FROM {view}", args=binder.args)
            finally:
                spark.catalog.dropTempView(view)

        return table.change(hit, {c: F.lit(v) for c, v in self.changes} if self.verb == "update" else None, bounds_of(self.tests.tests))


def bounds_of(tests: tuple) -> dict[str, tuple[Any, Any]]:
    """Bounds that rows lie within if all tests hold; none if one may be enough, or for what isn't a comparison with values."""
    found: dict[str, tuple[Any, Any]] = {}
    if any(t.kind in ("open", "close") or t.connector == "OR" for t in tests):
        return found
    for t in tests:
        if not isinstance(t.left, str) or t.negated or not t.values or any(v is None or isinstance(v, (Query, Raw)) for v in t.values):
            continue
        if t.kind == "compare":
            low, high = {"=": (t.values[0],) * 2, "<": (None, t.values[0]), "<=": (None, t.values[0]), "!>": (None, t.values[0]), ">": (t.values[0], None), ">=": (t.values[0], None), "!<": (t.values[0], None)}.get(t.op, (None, None))
        elif t.kind == "between":
            low, high = t.values
        elif t.kind == "in":
            try:
                low, high = min(t.values), max(t.values)
            except TypeError:
                continue
        else:
            continue
        before = found.get(t.left, (None, None))
        try:
            found[t.left] = (low if before[0] is None else before[0] if low is None else max(low, before[0]), high if before[1] is None else before[1] if high is None else min(high, before[1]))
        except TypeError:
            continue
    return found


def update() -> Change:
    return Change("update")


def delete() -> Change:
    return Change("delete")


@dataclass(frozen=True)
class Upsert:
    """INSERT .. ON CONFLICT of one row: values by column, the columns that tell a conflict, and what a conflict updates
    (default: all but those; none: insert if missing)."""

    row: tuple[tuple[str, Any], ...]
    keys: tuple[str, ...]
    only: tuple[str, ...] | None = None

    def update_only(self, *columns: str) -> Upsert:
        known = {c.lower() for c, _ in self.row}
        if unknown := [c for c in columns if c.lower() not in known]:
            raise QueryError(f"columns without a value: {unknown}")
        return replace(self, only=columns)

    def run(self, spark: SparkSession, table: VersionedTable) -> int:
        names = tuple(c for c, _ in self.row)
        rows = _rows(spark, table.read(), names, (tuple(v for _, v in self.row),))
        fold = {c.lower(): c for c in rows.columns}
        keys = [fold[k.lower()] for k in self.keys]
        return table.upsert(rows, keys, None if self.only is None else [fold[c.lower()] for c in self.only])


def insert_or_update(values: dict[str, Any], keys: tuple[str, ...]) -> Upsert:
    folded = [c.lower() for c in values]
    if not values or len(set(folded)) < len(folded):
        raise QueryError("an upsert names one column or more, each once")
    if not keys or any(k.lower() not in folded for k in keys):
        raise QueryError("each conflict column needs a value")
    return Upsert(tuple(values.items()), tuple(keys))
