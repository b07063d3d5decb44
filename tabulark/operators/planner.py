"""Plans of table copies from catalog metadata: which tables, under which names, which columns, in which order.

Settings may be given for all tables and for single ones; a single table's setting is looked up by its qualified name,
then by that name without quotes, then by its bare name, then by what a folding store takes for equal.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from .copy import ColumnInfo, CopyError, CopySpec

#: Stores by how they compare and fold simple names.
FOLDS = {"lower": str.lower, "upper": str.upper, "ignore": str.lower, "exact": lambda s: s}
SEGMENT = re.compile(r'"((?:[^"]|"")*)"|`((?:[^`]|``)*)`|\[((?:[^\]]|\]\])*)\]|([^."`\[\]]+)')


def segments(name: str) -> list[tuple[str, bool]]:
    """Parts of a dotted name, unquoted, and whether each was quoted: "a.b".c has two."""
    found, at = [], 0
    for m in SEGMENT.finditer(name):
        if name[at : m.start()] != ("." if found else ""):
            raise CopyError(f"not a name: {name}")
        quoted = m[4] is None
        text = m[1].replace('""', '"') if m[1] is not None else m[2].replace("``", "`") if m[2] is not None else m[3].replace("]]", "]") if m[3] is not None else m[4].strip()
        if not text or any(c in text for c in "\r\n\0") or not quoted and ";" in text:
            raise CopyError(f"not a name: {name!r}")
        found.append((text, quoted))
        at = m.end()
    if not found or at != len(name):
        raise CopyError(f"not a name: {name!r}")
    return found


def normal(name: str, fold: str = "ignore") -> tuple[str, ...]:
    """A name as a store compares it: simple parts folded; quoted ones as they are, where case counts in quotes."""
    change = FOLDS[fold]
    return tuple(text if quoted and fold in ("lower", "upper") else change(text) for text, quoted in segments(name))


@dataclass(frozen=True)
class TableInfo:
    schema: str | None
    name: str
    columns: tuple[ColumnInfo, ...] = ()
    view: bool = False

    @property
    def full(self) -> str:
        return f"{self.schema}.{self.name}" if self.schema else self.name


@dataclass(frozen=True)
class PlanOptions:
    schema: str | None = None
    views: bool = False
    predicate: Callable[[TableInfo], bool] | None = None
    destination_schema: str | None = None
    fold: str = "ignore"
    keep_identity: bool = False
    tables: dict[str, str] = field(default_factory=dict)
    mappings: dict[str, str] = field(default_factory=dict)
    exclusions: tuple[str, ...] = ()
    conversions: dict[str, str] = field(default_factory=dict)
    order_by: dict[str, tuple[str, ...]] = field(default_factory=dict)
    scoped_mappings: dict[str, dict[str, str]] = field(default_factory=dict)
    scoped_exclusions: dict[str, tuple[str, ...]] = field(default_factory=dict)
    scoped_conversions: dict[str, dict[str, str]] = field(default_factory=dict)


def scoped(values: dict[str, Any], table: TableInfo, fold: str = "ignore") -> Any:
    """A single table's setting, or None."""
    bare = ".".join(text for text, _ in segments(table.full))
    for name in (table.full, bare, table.name):
        if name in values:
            return values[name]
    names = (normal(table.full, fold), normal(table.name, fold))
    hits = [v for k, v in values.items() if normal(k, fold) in names]
    if len(hits) > 1:
        raise CopyError(f"{table.full}: more than one setting fits")
    return hits[0] if hits else None


def merged(everywhere: dict[str, str], single: dict[str, str] | None) -> dict[str, str]:
    """Settings by column for all tables and for one: the latter win, ignoring case."""
    own = {k.lower() for k in single or {}}
    return {**{k: v for k, v in everywhere.items() if k.lower() not in own}, **(single or {})}


def destination(table: TableInfo, options: PlanOptions) -> str:
    """A mapped name, in the destination's schema unless it names its own; else the table's own name there."""
    mapped = scoped(options.tables, table, options.fold)
    schema = options.destination_schema or table.schema
    if mapped and len(segments(mapped)) > 1:
        return mapped
    name = mapped or table.name
    return f"{schema}.{name}" if schema else name


def wanted(table: TableInfo, options: PlanOptions) -> bool:
    if table.view and not options.views:
        return False
    if options.schema and (not table.schema or normal(table.schema, options.fold) != normal(options.schema, options.fold)):
        return False
    return options.predicate is None or options.predicate(table)


def plan_table(table: TableInfo, options: PlanOptions, into: dict[tuple[str, ...], tuple[ColumnInfo, ...]] | None = None) -> tuple[CopySpec, list[str]]:
    """A spec and warnings. What the source or destination generates, or the destination lacks, is left out."""
    to = destination(table, options)
    maps = merged(options.mappings, scoped(options.scoped_mappings, table, options.fold))
    names = {k.lower(): v for k, v in maps.items()}
    out = {e.lower() for e in (*options.exclusions, *(scoped(options.scoped_exclusions, table, options.fold) or ()))}
    kinds = merged(options.conversions, scoped(options.scoped_conversions, table, options.fold))
    known = None
    if into is not None:
        path = normal(to, options.fold)
        there = into.get(path) or into.get(path[-2:]) or ()
        known = {c.name.lower(): c for c in there}
    left, used, warnings = [], {}, []
    if not table.columns:
        warnings.append("NoSourceColumns")
    for c in table.columns:
        name = names.get(c.name.lower(), c.name)
        target = None if known is None else known.get(name.lower())
        if c.name.lower() in out or name.lower() in out or c.generated:
            left.append(c.name)
        elif known is not None and target is None:
            left.append(c.name)
            warnings.append(f"MissingDestinationColumn:{c.name}")
        elif target and (target.generated or target.identity and not options.keep_identity):
            left.append(c.name)
        elif name != c.name:
            used[c.name] = name
    if table.columns and len(left) == len(table.columns):
        warnings.append("NoWritableColumns")
    here = {c.name.lower() for c in table.columns}
    order = tuple(scoped(options.order_by, table, options.fold) or ()) or tuple(c.name for c in table.columns if c.primary_key) or tuple(c.name for c in table.columns if c.identity)
    if unknown := [c for c in order if c.lower() not in here]:
        raise CopyError(f"{table.full}: no columns {unknown} to order by")
    if not order:
        warnings.append("NoOrderByColumns")
    conversions = {k: v for k, v in kinds.items() if k.lower() in here or k.lower() in {n.lower() for n in used.values()}}
    return CopySpec(table.full, to, order, used, tuple(left), conversions), warnings


def plan_tables(tables: list[TableInfo], options: PlanOptions = PlanOptions(), into: list[TableInfo] | None = None) -> tuple[list[CopySpec], list[str]]:
    """Specs of the tables that are wanted, and warnings (with their tables). Two tables of one destination are an error."""
    there = None if into is None else {normal(t.full, options.fold): t.columns for t in into}
    specs, warnings = [], []
    for table in tables:
        if wanted(table, options):
            spec, said = plan_table(table, options, there)
            specs.append(spec)
            warnings += [f"{table.full}:{w}" for w in said]
    places = [normal(s.destination, options.fold) for s in specs]
    if len(set(places)) < len(places):
        raise CopyError("two tables have one destination")
    return specs, warnings
