"""Pattern predicates that Spark has no syntax for, lowered to rlike and contains."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_SPECIAL = set(r".^$*+?{}[]\|()")


def similar_to_regex(pattern: str) -> str:
    """SQL SIMILAR TO: % and _ are wildcards; | * + ? ( ) [ ] { } keep their meaning; whole value."""
    out, at, in_class = [], 0, False
    while at < len(pattern):
        c = pattern[at]
        if c == "\\" and at + 1 < len(pattern):
            at += 1
            out.append(re.escape(pattern[at]))
        elif in_class:
            in_class = c != "]"
            out.append(c)
        elif c == "[":
            in_class = True
            out.append(c)
        else:
            out.append({"%": ".*", "_": ".", ".": r"\.", "^": r"\^", "$": r"\$"}.get(c, c))
        at += 1
    return f"(?s)^(?:{''.join(out)})$"


def glob_regex(pattern: str) -> str:
    """GLOB: * ? and [...] classes ([^...] negated), case-sensitive, whole value."""
    out, at = [], 0
    while at < len(pattern):
        c = pattern[at]
        close = pattern.find("]", at + 2) if c == "[" else -1
        if close > 0:
            body = pattern[at + 1 : close].replace("\\", r"\\")
            out.append("[^" + body[1:] + "]" if body[0] in "^!" else "[" + body + "]")
            at = close
        else:
            out.append({"*": ".*", "?": "."}.get(c, "\\" + c if c in _REGEX_SPECIAL else c))
        at += 1
    return f"(?s)^(?:{''.join(out)})$"


def similar_to(value: Column, pattern: str) -> Column:
    return value.rlike(similar_to_regex(pattern))


def glob(value: Column, pattern: str) -> Column:
    return value.rlike(glob_regex(pattern))


def match(value: Column, query: str) -> Column:
    """All terms of the query occur in the value, ignoring case. Null stays null."""
    found = value.isNotNull() | F.lit(None).cast("boolean")
    for term in query.lower().split():
        found = found & F.lower(value).contains(term)
    return found
