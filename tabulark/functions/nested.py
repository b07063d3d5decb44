"""Nested values, JSON, maps and XML."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP = re.compile(r"([^.\[\]]+)|\[(-?\d+)\]")


def steps(path: str) -> list[str | int]:
    """A dotted path with list indexes, as steps: a.b[0] is a, b, 0."""
    found, at = [], 0
    for m in STEP.finditer(path):
        if path[at : m.start()] not in ("", "."):
            raise ValueError(f"not a path: {path}")
        found.append(m[1] if m[1] is not None else int(m[2]))
        at = m.end()
    if not found or at != len(path):
        raise ValueError(f"not a path: {path}")
    return found


def _folded(column: Column, key: str) -> Column:
    """The value of a map's first key that is `key` in some case."""
    return F.get(F.filter(F.map_entries(column), lambda e: F.lower(e["key"]) == key.lower()), F.lit(0))["value"]


def value_at(df: DataFrame, path: str) -> Column:
    """The value at a path through structs, maps and arrays of df. Names of columns and fields are found ignoring case
    (an exact match first), as are keys of maps; indexes count from 0. What isn't there is null; a field that no value
    can have is an error."""
    kind, column = df.schema, None
    for step in steps(path):
        if isinstance(kind, T.StructType) and isinstance(step, str):
            names = [f for f in kind if f.name == step] or [f for f in kind if f.name.lower() == step.lower()]
            if len(names) != 1:
                raise ValueError(f"{path}: {'more than one' if names else 'no'} {step}")
            column = F.col("`" + names[0].name.replace("`", "``") + "`") if column is None else column[names[0].name]
            kind = names[0].dataType
        elif isinstance(kind, T.MapType) and isinstance(step, str):
            column, kind = F.coalesce(F.try_element_at(column, F.lit(step)), _folded(column, step)), kind.valueType
        elif isinstance(kind, T.ArrayType) and isinstance(step, int):
            column, kind = F.get(column, F.lit(step)), kind.elementType
        else:
            raise ValueError(f"{path}: {step} can't be taken of {kind.simpleString()}")
    return column


def json_value(text: Column, path: str) -> Column:
    """The text at a path of a JSON text; null if it isn't there or the text is no JSON."""
    return F.get_json_object(text, "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in steps(path)))


def json_map(text: Column, values: str = "string") -> Column:
    """A JSON object as a map."""
    return F.from_json(text, f"map<string,{values}>")


def json_variant(text: Column) -> Column:
    """A JSON text as a variant, which is parsed once however many values are taken of it; null if the text is no JSON."""
    return F.try_parse_json(text)


def variant_value(variant: Column, path: str, kind: str = "string") -> Column:
    """The value at a path of a variant, as a type; null if it isn't there or can't be of that type."""
    return F.try_variant_get(variant, "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in steps(path)), kind)


def json_rows(df: DataFrame, text: str, schema: str, broken: str | None = None) -> DataFrame:
    """df with the fields of the JSON objects in a column as columns in its place. broken: a column that takes the texts that don't have
    the schema (their fields are null); without it such a text is an error."""
    names = [f.name for f in T._parse_datatype_string(schema)]
    if clash := {n.lower() for n in [*names, *([broken] if broken else [])]} & {c.lower() for c in df.columns if c != text}:
        raise ValueError(f"columns that are there already: {sorted(clash)}")
    column, lost = F.col("`" + text.replace("`", "``") + "`"), "_" + (broken or "broken")
    while lost in names:
        lost = f"_{lost}"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": lost} if broken else {"mode": "FAILFAST"}
    found = F.from_json(column, f"{schema}, {lost} string" if broken else schema, options)
    rest = df.select("*", found.alias(lost)).drop(text)
    out = [rest[c] for c in rest.columns if c != lost] + [rest[lost][n].alias(n) for n in names]
    return rest.select(*out, *([rest[lost][lost].alias(broken)] if broken else []))


def renamed_keys(column: Column, fold: bool = True) -> Column:
    """A map with keys in lower case (of two that become one the last counts)."""
    entries = F.map_entries(column)
    last = F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda seen, e: F.map_concat(F.map_filter(seen, lambda k, _: k != F.lower(e["key"])), F.create_map(F.lower(e["key"]), e["value"].cast("string"))))
    return last if fold else column


def xml_value(text: Column, path: str) -> Column:
    """The text at an XPath of an XML text; null if it isn't there."""
    return F.xpath_string(text, F.lit(path))


def xml_exists(text: Column, path: str) -> Column:
    return F.xpath_boolean(text, F.lit(path))


def hex_binary(value: Column) -> Column:
    """Bytes as 0x.. text; null stays null."""
    return F.concat(F.lit("0x"), F.hex(value))


def from_hex(text: Column) -> Column:
    """The bytes of 0x.. text; null if it is none."""
    return F.when(text.rlike("^0[xX](?:[0-9A-Fa-f]{2})*$"), F.unhex(F.substring(text, 3, 1 << 30)))
