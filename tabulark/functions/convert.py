"""Value conversions of the copy engine. Null passes through; what can't be converted raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGETS = ("boolean", "int32", "int64", "decimal", "string", "datetime")


def to_boolean(value: Column, kind: T.DataType) -> Column:
    """Booleans as they are; true/false text; else an integer that is not 0 (fractions to even)."""
    if isinstance(kind, T.BooleanType):
        return value
    if isinstance(kind, T.StringType):
        text = F.lower(F.trim(value))
        return F.when(text.isin("true", "false"), text == "true").otherwise(text.cast("long") != 0)
    return F.bround(value) != 0


def to_integer(value: Column, kind: T.DataType, target: str) -> Column:
    """Numbers are rounded half to even; text must be an integer literal; overflow raises."""
    if isinstance(kind, T.StringType):
        text = F.trim(value)
        sound = F.when(value.isNull() | text.rlike(r"^[+-]?\d+$"), text)
        checked = F.when(value.isNotNull() & sound.isNull(), F.raise_error(F.concat(F.lit("not an integer: "), value))).otherwise(sound)
        return checked.cast(target)
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.bround(value, 0).cast(target)
    return value.cast(target)


def convert(value: Column, kind: T.DataType, target: str) -> Column:
    """value (of Spark type kind) as one of TARGETS."""
    if target == "boolean":
        return to_boolean(value, kind)
    if target in ("int32", "int64"):
        return to_integer(value, kind, {"int32": "int", "int64": "long"}[target])
    if target in ("decimal", "string", "datetime"):
        return value.cast({"decimal": "decimal(38,18)", "string": "string", "datetime": "timestamp_ntz"}[target])
    raise ValueError(f"unknown conversion target: {target}")


def relaxed_boolean(value: Column) -> Column:
    """YES/Y/TRUE/1 and NO/N/FALSE/0 in any case; anything else is null."""
    text = F.upper(F.trim(value.cast("string")))
    return F.when(text.isin("YES", "Y", "TRUE", "1"), True).when(text.isin("NO", "N", "FALSE", "0"), False)


def quote_name(value: Column) -> Column:
    return F.concat(F.lit("["), F.replace(value, F.lit("]"), F.lit("]]")), F.lit("]"))


def clock_duration(value: Column) -> Column:
    """An integer HHMMSS as seconds."""
    whole = value.cast("long")
    return F.expr("0L") + F.floor(whole / 10000) * 3600 + F.floor(whole / 100) % 100 * 60 + whole % 100
