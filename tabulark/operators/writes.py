"""Write plans: what to write, checked before it is written, and parameters from objects.

A plan is made from columns and a map of the items' members to them; items become one DataFrame and one write, whatever
their number. Columns, constraints and defaults of bulk writes are checked in the same job.
"""

from __future__ import annotations

import datetime
import enum
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .dml import Transaction, VersionedTable
from .infer import from_objects

MISSING = object()


def member(item: Any, path: str) -> Any:
    """The value at a dotted path of mappings, lists and attributes, names ignoring case (exact first); MISSING if there is none."""
    for step in path.split("."):
        if isinstance(item, dict):
            hit = [k for k in item if k == step] or [k for k in item if str(k).lower() == step.lower()]
            item = item[hit[0]] if hit else MISSING
        elif isinstance(item, (list, tuple)) and step.lstrip("-").isdigit():
            item = item[int(step)] if -len(item) <= int(step) < len(item) else MISSING
        elif item is not None:
            hit = [n for n in dir(item) if n == step] or [n for n in dir(item) if n.lower() == step.lower()]
            item = getattr(item, hit[0]) if hit else MISSING
        else:
            return MISSING
        if item is MISSING:
            return MISSING
    return item


def parameters(item: Any, names: dict[str, str], ambient: dict[str, Any] | None = None, enums_as: str = "int", converters: dict[type, Callable[[Any], Any]] | None = None) -> dict[str, Any]:
    """Parameter values of an item: names gives each parameter's member path. What the item lacks comes from ambient
    (by parameter or path, ignoring case), else null. Instants become UTC without zone; enumerations their value or
    name; converters, by type, come before both."""
    around = {k.lower(): v for k, v in (ambient or {}).items()}
    out = {}
    for parameter, path in names.items():
        value = member(item, path)
        if value is MISSING:
            value = around.get(parameter.lower(), around.get(path.lower()))
        for kind, convert in (converters or {}).items():
            if isinstance(value, kind):
                value = convert(value)
                break
        else:
            if isinstance(value, datetime.datetime) and value.tzinfo:
                value = value.astimezone(datetime.UTC).replace(tzinfo=None)
            elif isinstance(value, enum.Enum):
                value = value.value if enums_as == "int" else value.name
        out[parameter] = value
    return out


def with_ambient(df: DataFrame, ambient: dict[str, Any]) -> DataFrame:
    """The same for a DataFrame: nulls of a column, and columns that it lacks, take the ambient value."""
    known = {c.lower(): c for c in df.columns}
    found = {known.get(k.lower(), k): v for k, v in ambient.items()}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in found.items()})


@dataclass(frozen=True)
class WritePlan:
    """Columns in order, the member path of each, and the keys of an upsert (none: an insert)."""

    columns: tuple[str, ...]
    members: dict[str, str]
    keys: tuple[str, ...] = ()
    update: tuple[str, ...] | None = None

    def rows(self, spark: SparkSession, items: Iterable[Any], ambient: dict[str, Any] | None = None) -> DataFrame:
        return from_objects(spark, [parameters(i, {c: self.members[c] for c in self.columns}, ambient) for i in items])

    def run(self, spark: SparkSession, table: VersionedTable, items: Iterable[Any], ambient: dict[str, Any] | None = None, degree: int | None = None, expect: int | None = None) -> int:
        """One write for all items; rows affected. A column whose values are all null takes the table's type. degree: in
        how many tasks at once (1 to 1024). expect: how many rows must be affected, else the table stays as it was."""
        if degree is not None and not 1 <= degree <= 1024:
            raise ValueError("degree is 1 to 1024")
        target = table.read()
        types = {f.name.lower(): f.dataType for f in target.schema}
        rows = self.rows(spark, items, ambient)
        rows = rows.select(*[F.col(c).cast(types[c.lower()]).alias(c) for c in rows.columns])
        rows = rows.repartition(degree) if degree else rows
        with Transaction() as one:
            part = one.table(table)
            n = part.upsert(rows, list(self.keys), None if self.update is None else list(self.update)) if self.keys else part.append(rows)
            if expect is not None and n != expect:  # nothing is published yet
                raise ValueError(f"{n} rows affected where {expect} were expected")
        return n


def write_plan(columns: list[str], members: dict[str, str] | None = None, keys: list[str] | None = None, update: list[str] | None = None) -> WritePlan:
    """Checked: one column or more, each once (ignoring case); keys and updated columns among them, and apart."""
    folded = [c.lower() for c in columns]
    if not columns or any(not c.strip() for c in columns):
        raise ValueError("a write names one column or more")
    if len(set(folded)) < len(folded):
        raise ValueError("a column is named twice")
    for what, some in (("key", keys or []), ("updated column", update or [])):
        if unknown := [c for c in some if c.lower() not in folded]:
            raise ValueError(f"{what} isn't written: {unknown}")
    if update is not None and not keys:
        raise ValueError("what a conflict updates needs keys")
    if both := {c.lower() for c in keys or []} & {c.lower() for c in update or []}:
        raise ValueError(f"a key can't be updated: {sorted(both)}")
    maps = {k.lower(): v for k, v in (members or {}).items()}
    return WritePlan(tuple(columns), {c: maps.get(c.lower(), c) for c in columns}, tuple(keys or ()), None if update is None else tuple(update))


@dataclass(frozen=True)
class BulkOptions:
    """Of a bulk write: renames, constraints (name -> condition in SQL) that rows must meet, defaults for nulls unless
    they are kept, and progress after so many rows."""

    mappings: dict[str, str] = field(default_factory=dict)
    constraints: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, Any] = field(default_factory=dict)
    keep_nulls: bool = True
    batch_size: int = 10_000

    def __post_init__(self):
        if self.batch_size <= 0:
            raise ValueError("batch_size must be positive")
        names = [v.lower() for v in self.mappings.values()]
        if len(set(names)) < len(names):
            raise ValueError("two columns have one destination")


def prepared(df: DataFrame, options: BulkOptions) -> DataFrame:
    """df as it is to be written. A row that breaks a constraint (unknown counts as met, as in SQL) fails the job."""
    known = {c.lower(): c for c in df.columns}
    if unknown := [c for c in options.mappings if c.lower() not in known]:
        raise ValueError(f"mapped columns that the source lacks: {unknown}")
    out = df.withColumnsRenamed({known[k.lower()]: v for k, v in options.mappings.items()})
    if len({c.lower() for c in out.columns}) < len(out.columns):
        raise ValueError("two columns have one destination")
    if not options.keep_nulls:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in options.defaults.items()})
    checks: list[Column] = [F.when(~F.expr(test), F.raise_error(F.lit(f"constraint {name} is broken")).cast("boolean")).otherwise(True) for name, test in options.constraints.items()]
    for check in checks:
        out = out.where(F.coalesce(check, F.lit(True)))
    return out


def folded_names(df: DataFrame, fold: str = "lower") -> DataFrame:
    """Simple names in the case that a store folds them to; names in double quotes stay, less the quotes. Two that
    become one are an error."""
    change = {"lower": str.lower, "upper": str.upper, "none": lambda s: s}[fold]
    new = [c[1:-1].replace('""', '"') if len(c) > 1 and c[0] == c[-1] == '"' else change(c) if c.replace("_", "a").isalnum() else c for c in df.columns]
    if len(set(new)) < len(new):
        raise ValueError(f"names become one: {sorted({n for n in new if new.count(n) > 1})}")
    return df.toDF(*new)
