"""Insert, update, delete and upsert over immutable data.

Each verb maps a DataFrame to its next version. VersionedTable applies them to a table in files, with a log (see
versions): a failed write changes nothing that readers see, and of two writers of the same rows the second fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import replace
from types import TracebackType

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .versions import Change, ConflictError, Log, Ranges, State, q

__all__ = ["ConflictError", "Transaction", "VersionedTable", "delete", "insert", "insert_if_missing", "key_columns", "last_of_each", "merge", "update"]


def insert(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows appended by name; columns that they lack become null; unknown ones are an error."""
    if extra := {c.lower() for c in rows.columns} - {c.lower() for c in target.columns}:
        raise ValueError(f"unknown columns: {sorted(extra)}")
    return target.unionByName(rows, allowMissingColumns=True).select(*target.columns)


def update(target: DataFrame, changes: dict[str, Column], where: Column) -> DataFrame:
    """Rows for which the predicate is true get the changes."""
    if unknown := set(changes) - set(target.columns):
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    return target.select(*[F.when(where, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in target.columns])


def delete(target: DataFrame, where: Column) -> DataFrame:
    """Rows stay unless the predicate is true; unknown is not true."""
    return target.where(~F.coalesce(where, F.lit(False)))


def last_of_each(rows: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """The last row in order of arrival for each key, as upserts one by one would leave it."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(arrival).desc_nulls_last()))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _once(rows: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """rows with a true flag; a key (null is one) that comes twice fails the job that reads the flag."""
    times = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    said = F.raise_error(F.concat(F.lit("merge: more than one source row has the key "), F.to_json(F.struct(*keys))))
    return rows.withColumn(flag, F.when(times > 1, said.cast("boolean")).otherwise(F.lit(True)))


def _joined(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    new = _once(rows, keys, "_new").select(*[F.col(c).alias(f"_new_{c}") for c in rows.columns], "_new")
    old = target.withColumn("_old", F.lit(True))
    return old.join(new, [old[k].eqNullSafe(new[f"_new_{k}"]) for k in keys], "full")


def _taken(both: DataFrame, target: DataFrame, rows: DataFrame, keys: list[str], update_columns: list[str] | None) -> DataFrame:
    changed = [c for c in rows.columns if c not in keys] if update_columns is None else update_columns
    take = []
    for c in target.columns:
        if c not in rows.columns:
            take.append(F.col(c))
        elif c in changed and c not in keys:
            take.append(F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            take.append(F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c))
    return both.select(*take)


def merge(target: DataFrame, rows: DataFrame, keys: list[str], update_columns: list[str] | None = None) -> DataFrame:
    """Upsert: matched rows get update_columns (default: all that rows has, but the keys), others are inserted. An
    empty list inserts what is missing only. Null keys match null keys. A key that rows has twice is an error, raised by
    the job itself (use last_of_each() to choose)."""
    if unknown := {*keys, *(update_columns or [])} - set(rows.columns) or {*rows.columns} - {*target.columns}:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    return _taken(_joined(target, rows, keys), target, rows, keys, update_columns)


def insert_if_missing(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key (null is one) the target lacks, appended; keys must be distinct, as in merge()."""
    old = target.select(*[F.col(k).alias(f"_old_{k}") for k in keys]).distinct()
    new = _once(rows, keys, "_new")
    fresh = new.join(old, [new[k].eqNullSafe(old[f"_old_{k}"]) for k in keys], "left_anti").where("_new").drop("_new")
    return insert(target, fresh)


def key_columns(primary: list[str], columns: list[str], identity: list[str] | None = None) -> tuple[list[str], list[str]]:
    """For a generated merge: what rows are matched by, and what is updated: neither keys nor identities."""
    if not primary:
        raise ValueError("a merge needs a primary key")
    fixed = {c.lower() for c in (*primary, *(identity or []))}
    return primary, [c for c in columns if c.lower() not in fixed]


class VersionedTable(Log):
    """A Parquet table with versions in a folder (see versions). Verbs give the rows they affect. An append reads nothing
    of the table; others rewrite files that hold a row they affect, and look only into those whose least
    and greatest values allow one."""

    def append_once(self, rows: DataFrame, source: str, number: int) -> int:
        """Append what a source gives as its part `number` (parts come in order), unless that is there already: a part that is
        repeated after a failure adds nothing. The entry that adds the rows says so, thus neither is there without the other."""
        if self.state().sources.get(source, -1) >= number:
            return 0
        return self.append(rows, ((source, number),))

    def append(self, rows: DataFrame, sources: tuple[tuple[str, int], ...] = ()) -> int:
        base = self.number()
        state = self.state(base)
        known = {c.lower(): c for c in rows.columns}
        if extra := known.keys() - {f.name.lower() for f in state.schema}:
            raise ValueError(f"unknown columns: {sorted(extra)}")
        made = self.stage(rows.select(*[(F.col(q(known[f.name.lower()])) if f.name.lower() in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in state.schema]))
        if sources and any(self.state().sources.get(s, -1) >= n for s, n in sources):  # another attempt came first meanwhile
            return 0
        self.publish(replace(made, replace=False, schema=None, sources=sources), base)
        return sum(f.rows for f in made.add)

    def _named(self, state: State, paths: Iterable[str]) -> DataFrame:
        """Rows of files with _file, the file's path below the table's folder."""
        rows = self.read_files(state, paths)
        if not rows.inputFiles():
            return rows.withColumn("_file", F.lit(None).cast("string"))
        return rows.select("*", F.substring_index("_metadata.file_path", "/", -2).alias("_file"))

    def change(self, hit: Callable[[DataFrame], DataFrame], changes: dict[str, Column] | None, ranges: Ranges | None = None) -> int:
        """Update (changes) or delete (None) rows for which the column _hit, which hit() adds, is true. ranges: bounds that such
        rows lie within, if they are known."""
        base = self.number()
        state = self.state(base)
        if changes and (unknown := {c.lower() for c in changes} - {f.name.lower() for f in state.schema}):
            raise ValueError(f"unknown columns: {sorted(unknown)}")
        found = hit(self._named(state, [f.path for f in state.matching(ranges)])).where("_hit").groupBy("_file").count().collect()  # a row a file
        counts = {r["_file"]: r["count"] for r in found}
        columns = [F.col(q(c)) for c in state.schema.names]
        whole = [p for p, n in counts.items() if changes is None and n == state.files[p].rows]  # these just go
        part = [p for p in counts if p not in whole]
        made = Change()
        if part:
            rows = hit(self.read_files(state, part))
            out = delete(rows, F.col("_hit")) if changes is None else update(rows, changes, F.col("_hit"))
            made = self.stage(out.select(*columns))
        if counts:
            self.publish(Change(made.add, frozenset(counts), looked=(ranges or {},)), base)
        return sum(counts.values())

    def update(self, changes: dict[str, Column], where: Column, ranges: Ranges | None = None) -> int:
        return self.change(lambda df: df.withColumn("_hit", where), changes, ranges)

    def delete(self, where: Column, ranges: Ranges | None = None) -> int:
        return self.change(lambda df: df.withColumn("_hit", where), None, ranges)

    def upsert(self, rows: DataFrame, keys: list[str], update_columns: list[str] | None = None) -> int:
        """merge() with the files that hold a key of rows; the others stay."""
        if unknown := {*keys, *(update_columns or [])} - set(rows.columns):
            raise ValueError(f"unknown columns: {sorted(unknown)}")
        base = self.number()
        state = self.state(base)
        bounds = rows.agg(*[x for i, k in enumerate(keys) for x in (F.min(q(k)).alias(f"a{i}"), F.max(q(k)).alias(f"b{i}"), F.count_if(F.col(q(k)).isNull()).alias(f"z{i}"))]).first()
        ranges = {k: (bounds[f"a{i}"], bounds[f"b{i}"]) for i, k in enumerate(keys) if not bounds[f"z{i}"] and bounds[f"a{i}"] is not None}
        old = self._named(state, [f.path for f in state.matching(ranges)]).select("_file", *[F.col(q(k)).alias(f"_old_{k}") for k in keys])
        new = rows.select(*[F.col(q(k)) for k in keys]).distinct()
        touched = [r[0] for r in old.join(new, [old[q(f"_old_{k}")].eqNullSafe(new[q(k)]) for k in keys], "left_semi").select("_file").distinct().collect()]
        seen = Observation()
        target = self.read_files(state, touched)
        hit = F.col("_new") if update_columns is None or update_columns else F.col("_new") & F.col("_old").isNull()
        both = _joined(target, rows, keys).observe(seen, F.count_if(hit).alias("rows"))
        made = self.stage(_taken(both, target, rows, keys, update_columns).select(*[F.col(q(f.name)).cast(f.dataType).alias(f.name) for f in state.schema]))
        self.publish(Change(made.add, frozenset(touched), looked=(ranges,)), base)
        return seen.get["rows"]

    def truncate(self) -> int:
        """No row is read: the log knows how many there were."""
        base = self.number()
        state = self.state(base)
        self.publish(Change(replace=True, schema=state.schema), base)
        return state.rows()


class Part(VersionedTable):
    """A table within a transaction: its verbs see what the transaction has done so far, and nobody else does."""

    def __init__(self, table: VersionedTable):
        super().__init__(table.spark, table.path)
        self.base = table.number()
        self.first = self.current = table.state(self.base) if self.base else None
        self.looked: list[Ranges] = []
        self.replaced = False

    def number(self) -> int:
        return self.base

    def state(self, number: int | None = None) -> State:
        if self.current is None:
            raise FileNotFoundError(self.path)
        return self.current

    def publish(self, change: Change, base: int, decision: str | None = None) -> int:
        self.current = change.after(self.current)
        self.replaced |= change.replace
        self.looked += change.looked or ()
        return self.base

    def sum(self) -> Change | None:
        """All that was done, as one change."""
        if self.current is self.first:
            return None
        old, new = self.first.files if self.first else {}, self.current.files
        sources = tuple((self.current.sources.items() - self.first.sources.items()) if self.first else self.current.sources.items())
        schema = None if self.first and self.first.schema == self.current.schema else self.current.schema
        if self.replaced:
            return Change(tuple(new.values()), replace=True, schema=self.current.schema, sources=sources)
        return Change(tuple(f for p, f in new.items() if p not in old), frozenset(old.keys() - new.keys()), schema=schema, looked=tuple(self.looked) or None, sources=sources)


class Transaction:
    """Changes of several tables that are published together when the block ends well, and none if it doesn't, whatever
    the reason, and if the driver is lost. table() gives a table whose verbs belong to the transaction."""

    def __init__(self):
        self.parts: dict[str, Part] = {}
        self.tables: dict[str, VersionedTable] = {}

    def table(self, table: VersionedTable) -> Part:
        if table.path not in self.parts:
            self.parts[table.path], self.tables[table.path] = Part(table), table
        return self.parts[table.path]

    def write(self, table: VersionedTable, df: DataFrame) -> None:
        """df as the table's whole content."""
        self.table(table).commit(df)

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        changes = {p: c for p, part in self.parts.items() if (c := part.sum()) is not None}
        if error is not None or not changes:
            return
        if len(changes) == 1:
            (path, change), = changes.items()
            self.tables[path].publish(change, self.parts[path].base)
            return
        first = self.tables[min(changes)]
        decision = f"{first.path}/decisions/{uuid.uuid4().hex}"
        try:
            for path in sorted(changes):  # in one order for all, so that two rarely stop each other
                self.tables[path].publish(changes[path], self.parts[path].base, decision)
            if not first.folder.put(decision, "committed"):
                raise ConflictError("another writer met the transaction before it was decided")
        except BaseException:
            first.folder.put(decision, "aborted")
            raise
