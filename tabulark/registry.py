"""Where queries over the driver's tables are registered, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans.query import Query
from .session import named_in, open_tables, table

__all__ = ["ORACLES", "QUERIES", "Run", "both", "built", "made", "table"]

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def both(name: str, spark_sql: str, duck_sql: str | None = None) -> None:
    """A query given as SQL; the oracle has the same text unless another is given."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        open_tables(spark, folder, named_in(spark_sql))
        return spark.sql(spark_sql)

    QUERIES[name], ORACLES[name] = run, duck_sql or spark_sql


def built(name: str, query: Query, duck_sql: str) -> None:
    """A query made with the builder."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        open_tables(spark, folder, named_in(query.to_sql()[0]))
        return query.to_df(spark)

    QUERIES[name], ORACLES[name] = run, duck_sql


def made(duck_sql: str | None = None) -> Callable[[Run], Run]:
    """A query made with DataFrame operators."""

    def register(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if duck_sql:
            ORACLES[run.__name__] = duck_sql
        return run

    return register
