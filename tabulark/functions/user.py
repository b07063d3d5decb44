"""Functions of the user's own: vectorised scalar, grouped aggregate and table functions, and SQL ones."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def scalar(spark: SparkSession, name: str, function: Callable[..., pd.Series], returns: str) -> Callable:
    """Register a function of Series (whole Arrow batches, not rows) for SQL; gives it for DataFrames as well."""
    return spark.udf.register(name, F.pandas_udf(function, returns))


def aggregate(spark: SparkSession, name: str, function: Callable[[pd.Series], Any], returns: str) -> Callable:
    """Register an aggregate: a function of all values of a group, which must fit in memory. Built-in aggregates and
    compositions of them have no such limit: prefer those."""
    function.__annotations__.update({"return": {"double": float, "long": int, "bigint": int, "string": str}.get(returns, float)})
    for argument in function.__code__.co_varnames[: function.__code__.co_argcount]:
        function.__annotations__[argument] = pd.Series
    return spark.udf.register(name, F.pandas_udf(function, returns))


def table(spark: SparkSession, name: str, rows: Callable[..., Iterator[tuple]], returns: str) -> Callable:
    """Register a table function: for each row of arguments, as many rows as `rows` yields. For use in LATERAL joins."""

    class Rows:
        def eval(self, *arguments: Any) -> Iterator[tuple]:
            yield from rows(*arguments)

    made = F.udtf(Rows, returnType=returns)
    spark.udtf.register(name, made)
    return made


def sql(spark: SparkSession, name: str, parameters: str, returns: str, body: str) -> None:
    """A SQL function (scalar, or RETURNS TABLE): Catalyst inlines it, so it costs what its body does."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")
