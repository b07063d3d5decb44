"""A fluent, immutable query builder with two lowerings: to a DataFrame and to SQL text with bound values.

Names are quoted, values are bound, operators come from a closed list. Methods ending in `_raw` take trusted
SQL text. Each call returns a new Query.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions import matching

#: Operators that a comparison may use.
OPERATORS = ("=", "<>", "!=", "<", "<=", ">", ">=", "!<", "!>", "<=>", "LIKE", "NOT LIKE", "ILIKE", "NOT ILIKE", "IN", "NOT IN", "IS", "IS NOT", "IS DISTINCT FROM", "IS NOT DISTINCT FROM", "SIMILAR TO", "NOT SIMILAR TO", "REGEXP", "RLIKE", "GLOB", "MATCH")
JOINS = {"inner": "JOIN", "left": "LEFT JOIN", "right": "RIGHT JOIN", "full": "FULL OUTER JOIN", "cross": "CROSS JOIN", "semi": "LEFT SEMI JOIN", "anti": "LEFT ANTI JOIN", "lateral": "JOIN LATERAL", "left lateral": "LEFT JOIN LATERAL"}
GROUPINGS = ("ROLLUP", "CUBE", "GROUPING SETS")
LITERAL = re.compile(r"^(?:-?\d+(?:\.\d+)?|NULL|TRUE|FALSE)$", re.IGNORECASE)


class QueryError(ValueError):
    """The query isn't sound."""


def operator(text: str) -> str:
    found = re.sub(r"\s+", " ", text.strip()).upper()
    if found not in OPERATORS:
        raise QueryError(f"operator not allowed: {text}")
    return found


def quote(name: str) -> str:
    """Each dotted segment in backticks; * stays."""
    if not name or not name.strip():
        raise QueryError("empty name")
    return ".".join(s if s == "*" else "`" + s.replace("`", "``") + "`" for s in name.split("."))


@dataclass(frozen=True)
class Raw:
    sql: str


@dataclass(frozen=True)
class Test:
    """One leaf of a predicate; connector joins it to what stands before."""

    connector: str
    kind: str  # compare, in, between, null, open, close
    left: Any = None
    op: str = ""
    values: tuple = ()
    negated: bool = False


class Binder:
    """Collects bound values as named parameters."""

    def __init__(self):
        self.args: dict[str, Any] = {}

    def bind(self, value: Any) -> str:
        name = f"p{len(self.args)}"
        self.args[name] = value
        return f":{name}"


@dataclass(frozen=True)
class Query:
    columns: tuple = ()
    unique: bool = False
    source: Any = None
    alias: str | None = None
    joins: tuple = ()
    tests: tuple = ()
    groups: tuple = ()
    grouping: str = ""
    havings: tuple = ()
    orders: tuple = ()
    count: int | None = None
    skip: int | None = None
    compounds: tuple = ()
    pending: str | None = field(default=None, compare=False)

    # projection and source
    def select(self, *names: str) -> Query:
        return replace(self, columns=self.columns + tuple(names or ("*",)))

    def select_raw(self, *expressions: str) -> Query:
        return replace(self, columns=self.columns + tuple(map(Raw, expressions)))

    def distinct(self) -> Query:
        return replace(self, unique=True)

    def from_(self, source: str | Query, alias: str | None = None) -> Query:
        if isinstance(source, Query) and not alias:
            raise QueryError("a sub-query needs an alias")
        return replace(self, source=source, alias=alias)

    def from_raw(self, sql: str) -> Query:
        return replace(self, source=Raw(sql), alias=None)

    # joins
    def _join(self, kind: str, table: Any, args: tuple, alias: str | None) -> Query:
        if len(args) == 2:
            args = (args[0], "=", args[1])
        if kind != "cross" and len(args) != 3:
            raise QueryError("a join takes left, [operator,] right")
        return replace(self, joins=(*self.joins, (kind, table, alias, (args[0], operator(args[1]), args[2]) if args else None)))

    def join(self, table: str, *on: str, alias: str | None = None) -> Query:
        return self._join("inner", table, on, alias)

    def left_join(self, table: str, *on: str, alias: str | None = None) -> Query:
        return self._join("left", table, on, alias)

    def right_join(self, table: str, *on: str, alias: str | None = None) -> Query:
        return self._join("right", table, on, alias)

    def full_outer_join(self, table: str, *on: str, alias: str | None = None) -> Query:
        return self._join("full", table, on, alias)

    def cross_join(self, table: str, alias: str | None = None) -> Query:
        return self._join("cross", table, (), alias)

    def semi_join(self, table: str, *on: str, alias: str | None = None) -> Query:
        """Rows with a partner; the partner's columns aren't seen."""
        return self._join("semi", table, on, alias)

    def anti_join(self, table: str, *on: str, alias: str | None = None) -> Query:
        """Rows without a partner. Unlike where_not_in, a null key has none."""
        return self._join("anti", table, on, alias)

    def lateral_join(self, query: Query | Raw, alias: str, left: bool = True) -> Query:
        """A sub-query (or table function) that may use columns of what stands before it, for each of its rows."""
        return replace(self, joins=(*self.joins, ("left lateral" if left else "lateral", query, alias, Raw("true"))))

    def join_raw(self, table: str, condition: str | None = None, kind: str = "inner") -> Query:
        if kind not in JOINS or (condition is None) != (kind == "cross"):
            raise QueryError("join kind and condition don't fit")
        return replace(self, joins=(*self.joins, (kind, Raw(table), None, Raw(condition) if condition else None)))

    # predicates
    def _test(self, test: Test) -> Query:
        last = self.tests[-1].kind if self.tests else None
        connector = self.pending or test.connector
        if last is None or last == "open":
            if self.pending:
                raise QueryError("nothing stands before OR")
            connector = ""
        return replace(self, tests=(*self.tests, replace(test, connector=connector)), pending=None)

    @staticmethod
    def _given(value: Any) -> Any:
        if value is None:
            raise QueryError("null is no value here; use where_null")
        return value

    def _compare(self, connector: str, left: Any, args: tuple) -> Query:
        op, value = ("=", args[0]) if len(args) == 1 else args
        return self._test(Test(connector, "compare", left, operator(op), (self._given(value),)))

    def where(self, column: str, *args: Any) -> Query:
        return self._compare("AND", column, args)

    def or_where(self, column: str, *args: Any) -> Query:
        return self._compare("OR", column, args)

    def where_raw(self, expression: str, *args: Any) -> Query:
        return self._compare("AND", Raw(expression), args)

    def or_where_raw(self, expression: str, *args: Any) -> Query:
        return self._compare("OR", Raw(expression), args)

    def where_in(self, column: str | Raw, values: Any, negated: bool = False, connector: str = "AND") -> Query:
        values = (values,) if isinstance(values, Query) else tuple(values)
        if not values or any(v is None for v in values):
            raise QueryError("IN takes one value or more, none of them null")
        return self._test(Test(connector, "in", column, values=values, negated=negated))

    def where_not_in(self, column: str | Raw, values: Any, connector: str = "AND") -> Query:
        return self.where_in(column, values, True, connector)

    def where_between(self, column: str | Raw, low: Any, high: Any, negated: bool = False, connector: str = "AND") -> Query:
        return self._test(Test(connector, "between", column, values=(self._given(low), self._given(high)), negated=negated))

    def where_not_between(self, column: str | Raw, low: Any, high: Any, connector: str = "AND") -> Query:
        return self.where_between(column, low, high, True, connector)

    def where_null(self, column: str | Raw, negated: bool = False, connector: str = "AND") -> Query:
        return self._test(Test(connector, "null", column, negated=negated))

    def where_not_null(self, column: str | Raw, connector: str = "AND") -> Query:
        return self.where_null(column, True, connector)

    def or_(self) -> Query:
        if self.pending or not self.tests or self.tests[-1].kind == "open":
            raise QueryError("OR needs a predicate before it, once")
        return replace(self, pending="OR")

    def begin_group(self, connector: str = "AND") -> Query:
        return self._test(Test(connector, "open"))

    def end_group(self) -> Query:
        depth = sum((t.kind == "open") - (t.kind == "close") for t in self.tests)
        if depth < 1 or self.pending or self.tests[-1].kind == "open":
            raise QueryError("no group to end, or an empty one")
        return replace(self, tests=(*self.tests, Test("", "close")))

    def where_if(self, column: str, *args: Any) -> Query:
        """An optional filter: no test at all if the value is null."""
        return self if args[-1] is None else self.where(column, *args)

    # the rest
    def rollup(self, *names: str) -> Query:
        return replace(self, groups=names, grouping="ROLLUP")

    def cube(self, *names: str) -> Query:
        return replace(self, groups=names, grouping="CUBE")

    def grouping_sets(self, *sets: tuple[str, ...]) -> Query:
        return replace(self, groups=sets, grouping="GROUPING SETS")

    def group_by(self, *names: str) -> Query:
        return replace(self, groups=self.groups + names)

    def group_by_raw(self, *expressions: str) -> Query:
        return replace(self, groups=self.groups + tuple(map(Raw, expressions)))

    def having(self, column: str | Raw, *args: Any) -> Query:
        op, value = ("=", args[0]) if len(args) == 1 else args
        return replace(self, havings=(*self.havings, Test("AND", "compare", column, operator(op), (self._given(value),))))

    def having_raw(self, expression: str, op: str, value: Any) -> Query:
        return self.having(Raw(expression), op, value)

    def order_by(self, *names: str, descending: bool = False) -> Query:
        return replace(self, orders=self.orders + tuple((n, descending) for n in names))

    def order_by_descending(self, *names: str) -> Query:
        return self.order_by(*names, descending=True)

    def order_by_raw(self, *expressions: str) -> Query:
        return replace(self, orders=self.orders + tuple((Raw(e), None) for e in expressions))

    def limit(self, n: int) -> Query:
        return replace(self, count=self._size(n))

    def offset(self, n: int) -> Query:
        return replace(self, skip=self._size(n))

    def top(self, n: int) -> Query:
        return replace(self, count=self._size(n), skip=None)

    @staticmethod
    def _size(n: int) -> int:
        if n < 0:
            raise QueryError("limit and offset are not negative")
        return n

    def union(self, other: Query) -> Query:
        return replace(self, compounds=(*self.compounds, ("UNION", other)))

    def union_all(self, other: Query) -> Query:
        return replace(self, compounds=(*self.compounds, ("UNION ALL", other)))

    def intersect(self, other: Query) -> Query:
        return replace(self, compounds=(*self.compounds, ("INTERSECT", other)))

    def intersect_all(self, other: Query) -> Query:
        return replace(self, compounds=(*self.compounds, ("INTERSECT ALL", other)))

    def except_(self, other: Query) -> Query:
        return replace(self, compounds=(*self.compounds, ("EXCEPT", other)))

    def except_all(self, other: Query) -> Query:
        return replace(self, compounds=(*self.compounds, ("EXCEPT ALL", other)))

    # lowering
    def to_sql(self, binder: Binder | None = None) -> tuple[str, dict[str, Any]]:
        """Spark SQL text and its named arguments."""
        binder = binder or Binder()
        return _select(self, binder), binder.args

    def tables(self) -> set[str]:
        """Names of the tables that the query reads, but for those in raw text."""
        found = {self.source} if isinstance(self.source, str) else self.source.tables() if isinstance(self.source, Query) else set()
        for _, table, _, _ in self.joins:
            found |= {table} if isinstance(table, str) else table.tables() if isinstance(table, Query) else set()
        inner = [v for t in (*self.tests, *self.havings) for v in t.values if isinstance(v, Query)]
        return found.union(*(q.tables() for q in inner), *(q.tables() for _, q in self.compounds))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The query as a lazy DataFrame; Catalyst plans it."""
        text, args = self.to_sql()
        return spark.sql(text, args=args)


def _name(item: Any) -> str:
    return item.sql if isinstance(item, Raw) else quote(item)


def _operand(value: Any, binder: Binder) -> str:
    return f"({_select(value, binder)})" if isinstance(value, Query) else binder.bind(value)


def _test_sql(test: Test, binder: Binder) -> str:
    if test.kind in ("open", "close"):
        return "(" if test.kind == "open" else ")"
    left, no = _name(test.left), "NOT " if test.negated else ""
    if test.kind == "null":
        return f"{left} IS {no}NULL"
    if test.kind == "between":
        low, high = (binder.bind(v) for v in test.values)
        return f"{left} {no}BETWEEN {low} AND {high}"
    if test.kind == "in":
        inner = ", ".join(_select(v, binder) if isinstance(v, Query) else binder.bind(v) for v in test.values)
        return f"{left} {no}IN ({inner})"
    op, value = test.op, test.values[0]
    if op in ("SIMILAR TO", "NOT SIMILAR TO"):
        return f"{'NOT ' if op[0] == 'N' else ''}{left} RLIKE {binder.bind(matching.similar_to_regex(value))}"
    if op == "GLOB":
        return f"{left} RLIKE {binder.bind(matching.glob_regex(value))}"
    if op == "MATCH":
        return "(" + " AND ".join(f"contains(lower({left}), {binder.bind(t)})" for t in value.lower().split()) + ")"
    if op in ("IN", "NOT IN"):
        if not isinstance(value, Query):
            raise QueryError(f"{op} takes a sub-query here; use where_in for values")
        return f"{left} {op} ({_select(value, binder)})"
    if op == "IS" or op == "IS NOT":
        return f"{'NOT ' if op == 'IS NOT' else ''}({left} <=> {_operand(value, binder)})"
    op = {"!<": ">=", "!>": "<=", "REGEXP": "RLIKE"}.get(op, op)
    return f"{left} {op} {_operand(value, binder)}"


def _predicate(tests: tuple, binder: Binder) -> str:
    if sum((t.kind == "open") - (t.kind == "close") for t in tests):
        raise QueryError("a group is not ended")
    return " ".join(f"{t.connector} {_test_sql(t, binder)}".strip() for t in tests)


def _table(source: Any, alias: str | None, binder: Binder) -> str:
    text = f"({_select(source, binder)})" if isinstance(source, Query) else _name(source)
    return f"{text} AS {quote(alias)}" if alias else text


def _select(q: Query, binder: Binder) -> str:
    if q.pending:
        raise QueryError("nothing follows OR")
    item = lambda c: c if isinstance(c, str) and not q.source and LITERAL.match(c) else _name(c)
    parts = [f"SELECT {'DISTINCT ' if q.unique else ''}{', '.join(map(item, q.columns or ('*',)))}"]
    if q.source is not None:
        parts.append(f"FROM {_table(q.source, q.alias, binder)}")
    for kind, table, alias, on in q.joins:
        text = f"{JOINS[kind]} {_table(table, alias, binder)}"
        if isinstance(on, Raw):
            text += f" ON {on.sql}"
        elif on:
            left, op, right = on
            op = {"!<": ">=", "!>": "<=", "REGEXP": "RLIKE"}.get(op, op)
            if op in ("SIMILAR TO", "NOT SIMILAR TO", "GLOB", "MATCH", "IN", "NOT IN", "IS", "IS NOT"):
                raise QueryError(f"{op} can't join two columns")
            text += f" ON {quote(left)} {op} {quote(right)}"
        parts.append(text)
    if q.tests:
        parts.append(f"WHERE {_predicate(q.tests, binder)}")
    if q.grouping == "GROUPING SETS":
        parts.append(f"GROUP BY GROUPING SETS ({', '.join('(' + ', '.join(map(_name, g)) + ')' for g in q.groups)})")
    elif q.groups:
        listed = ", ".join(map(_name, q.groups))
        parts.append(f"GROUP BY {q.grouping} ({listed})" if q.grouping else f"GROUP BY {listed}")
    if q.havings:
        parts.append(f"HAVING {' AND '.join(_test_sql(t, binder) for t in q.havings)}")
    if q.orders:
        ends = {None: "", False: " ASC NULLS LAST", True: " DESC NULLS LAST"}
        parts.append(f"ORDER BY {', '.join(_name(n) + ends[d] for n, d in q.orders)}")
    if q.count is not None:
        parts.append(f"LIMIT {q.count}")
    if q.skip is not None:
        parts.append(f"OFFSET {q.skip}")
    text = " ".join(parts)
    if q.compounds:
        wrap = lambda sql, query: f"SELECT * FROM ({sql})" if query.orders or query.count is not None or query.skip is not None or query.compounds else sql
        own = replace(q, compounds=())
        text = " ".join([wrap(text, own), *(f"{op} {wrap(_select(other, binder), other)}" for op, other in q.compounds)])
    return text
