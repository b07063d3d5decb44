"""Rows of plain objects to DataFrames: names, types, shapes."""

from __future__ import annotations

import dataclasses
import datetime
import decimal
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KINDS = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType(), bytes: T.BinaryType(), decimal.Decimal: T.DecimalType(38, 18), datetime.datetime: T.TimestampNTZType(), datetime.date: T.DateType()}


def unique_names(names: list[str | None]) -> list[str]:
    """Blank names become ColumnN; a repeated one (ignoring case) gets 1, 2, ... appended."""
    used, out = set(), []
    for i, name in enumerate(names):
        base = name if name and name.strip() else f"Column{i + 1}"
        new, k = base, 0
        while new.lower() in used:
            k += 1
            new = f"{base}{k}"
        used.add(new.lower())
        out.append(new)
    return out


def _rows(items: Iterable[Any]) -> list[dict]:
    """Dictionaries, and other items as a column Value; one list alone is the rows; dataclasses are their fields."""
    found = list(items)
    if len(found) == 1 and isinstance(found[0], (list, tuple, set)) or len(found) == 1 and hasattr(found[0], "__next__"):
        found = list(found[0])
    fields = lambda i: {f.name: getattr(i, f.name) for f in dataclasses.fields(i)} if dataclasses.is_dataclass(i) and not isinstance(i, type) else i
    return [i if isinstance(i, dict) else {"Value": i} for i in map(fields, found)]


def from_objects(spark: SparkSession, items: Iterable[Any], first_row_only: bool = False) -> DataFrame:
    """Dictionaries become rows, scalars a column Value, a single list its items. Keys match columns ignoring case, but for
    spellings that occur in one row: those are columns of their own, the later with a number. A column has the one type of
    its values; where they differ, or all are null, it is text."""
    rows = _rows(items)
    apart = {k for row in rows for k in row if sum(o.lower() == k.lower() for o in row) > 1}  # exact spellings only
    fold = lambda k: k if k in apart else k.lower()
    columns: dict[str, str] = {}
    for row in rows[:1] if first_row_only else rows:
        for key in row:
            columns.setdefault(fold(key), key)
    kinds: dict[str, set] = {c: set() for c in columns}
    table = []
    for row in rows:
        folded = {fold(k): v for k, v in row.items() if fold(k) in columns}
        for k, v in folded.items():
            if v is not None:
                kinds[k].add(type(v))
        table.append([folded.get(c) for c in columns])
    types = {c: KINDS.get(next(iter(k)), T.StringType()) if len(k) == 1 else T.StringType() for c, k in kinds.items()}
    text = {c for c, t in types.items() if t == T.StringType()}
    names = unique_names(list(columns.values()))
    schema = T.StructType([T.StructField(n, types[c], True) for n, c in zip(names, columns, strict=True)])
    return spark.createDataFrame([tuple(str(v) if c in text and v is not None else v for c, v in zip(columns, r, strict=True)) for r in table], schema)


def collect(df: DataFrame, shape: str = "table") -> Any:
    """Results at the edge: table (pandas), row (first or None), scalar, objects (dicts), stream (iterator)."""
    if shape == "table":
        return df.toPandas()
    if shape == "row":
        return df.first()
    if shape == "scalar":
        row = df.first()
        return row[0] if row else None
    if shape == "objects":
        return [r.asDict() for r in df.collect()]
    if shape == "stream":
        return (r.asDict() for r in df.toLocalIterator(prefetchPartitions=True))
    raise ValueError(f"unknown shape: {shape}")
