"""One front for what a user of a database client does: queries in several shapes, at once or in time, statements, copies.

The asynchronous forms run the same calls in threads: Spark plans and runs them as ever, and several can run side by side.
"""

from __future__ import annotations

import asyncio
import dataclasses
from collections.abc import AsyncIterator, Callable, Iterator
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from .operators import infer, parallel
from .operators.dml import VersionedTable
from .plans.query import Query


class Client:
    def __init__(self, spark: SparkSession, token: parallel.Token | None = None):
        self.spark, self.token = spark, token

    def frame(self, what: str | Query | DataFrame, values: dict[str, Any] | None = None, types: dict[str, str] | None = None) -> DataFrame:
        if isinstance(what, DataFrame):
            return what
        return what.to_df(self.spark) if isinstance(what, Query) else parallel.query(self.spark, what, values, types)[0]

    def query(self, what: str | Query | DataFrame, values: dict[str, Any] | None = None, shape: str = "table", types: dict[str, str] | None = None) -> Any:
        """A result as table, row, scalar or objects (collected), or stream (an iterator)."""
        df = self.frame(what, values, types)
        if shape == "stream":
            return (r.asDict() for r in parallel.stream_rows(df, self.token))
        with parallel.operation(self.spark, "query", self.token):
            return infer.collect(df, shape)

    def scalar(self, what: str | Query | DataFrame, values: dict[str, Any] | None = None) -> Any:
        return self.query(what, values, "scalar")

    def rows_as(self, kind: type, what: str | Query | DataFrame, values: dict[str, Any] | None = None, convert: Callable[[dict], Any] | None = None) -> Iterator[Any]:
        """Rows as objects of a class, a partition at a time: fields are found among the columns ignoring case, others left
        out; a field without a column or default is an error. convert: another way from a row to an object."""
        df = self.frame(what, values)
        known = {c.lower(): c for c in df.columns}
        fields = [f.name for f in dataclasses.fields(kind)] if dataclasses.is_dataclass(kind) else list(kind.__annotations__)
        pick = {f: known[f.lower()] for f in fields if f.lower() in known}
        for row in parallel.stream_rows(df, self.token):
            yield convert(row.asDict()) if convert else kind(**{f: row[c] for f, c in pick.items()})

    def execute(self, statement: Any, table: VersionedTable) -> int:
        """Run a statement; the rows it affects."""
        with parallel.operation(self.spark, "execute", self.token):
            return statement.run(self.spark, table)

    def ping(self) -> bool:
        return self.scalar("SELECT 1") == 1

    async def _threaded(self, call: Callable, *args: Any) -> Any:
        return await asyncio.to_thread(inheritable_thread_target(self.spark)(call), *args)

    async def query_async(self, what: str | Query | DataFrame, values: dict[str, Any] | None = None, shape: str = "table") -> Any:
        return await self._threaded(self.query, what, values, shape)

    async def execute_async(self, statement: Any, table: VersionedTable) -> int:
        return await self._threaded(self.execute, statement, table)

    async def stream_async(self, what: str | Query | DataFrame, values: dict[str, Any] | None = None) -> AsyncIterator[dict]:
        rows, end = self.query(what, values, "stream"), object()
        while (row := await self._threaded(next, rows, end)) is not end:
            yield row
