"""Table copies: plan, preflight, clear, one write, verification, manifest.

The data path of a table is one lazy plan (read, dedupe, rename, convert) and one write job; the row count
copied is observed in that job. Guards and plans run in the driver on metadata alone.
"""

from __future__ import annotations

import functools
import hashlib
import inspect
import os
import re
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .. import VERSION
from ..functions.convert import TARGETS, convert
from . import verify


class CopyError(ValueError):
    """A rule of the copy engine is broken; nothing was changed unless the message says so."""


@dataclass(frozen=True)
class CopySpec:
    """What to copy: names, order, renames, exclusions, conversions, and how duplicates are told."""

    source: str
    destination: str
    order_by: tuple[str, ...] = ()
    mappings: dict[str, str] = field(default_factory=dict)
    exclusions: tuple[str, ...] = ()
    conversions: dict[str, str] = field(default_factory=dict)
    dedupe_keys: tuple[str, ...] = ()
    ignore_case: bool = False
    winners: tuple[str, ...] = ()


def dedupe(df: DataFrame, keys: tuple[str, ...], winners: tuple[str, ...] = (), ignore_case: bool = False) -> DataFrame:
    """One row for each key: the greatest by winners; ties by key, then by every other column."""
    strings = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    part = [F.lower(k) if ignore_case and k in strings else F.col(k) for k in keys]
    rest = [c for c in df.columns if c not in keys and c not in winners]
    order = [F.col(w).desc_nulls_last() for w in winners] + [F.col(c).asc_nulls_last() for c in (*keys, *rest)]
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where("_rank = 1").drop("_rank")


def keys_of(df: DataFrame, keys: tuple[str, ...], ignore_case: bool = False) -> DataFrame:
    """A row for each group of equal keys; nulls form one group."""
    strings = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    return df.select(*[F.lower(k).alias(k) if ignore_case and k in strings else F.col(k) for k in keys]).distinct()


def distinct_keys(df: DataFrame, keys: tuple[str, ...], ignore_case: bool = False) -> int:
    return keys_of(df, keys, ignore_case).count()


def transform(df: DataFrame, spec: CopySpec, case_sensitive: bool = False) -> DataFrame:
    """Exclude by source or destination name, rename, convert (source name first). One select."""
    fold = (lambda s: s) if case_sensitive else str.lower
    maps = {fold(k): v for k, v in spec.mappings.items()}
    kinds = {fold(k): v for k, v in spec.conversions.items()}
    out = {fold(e) for e in spec.exclusions}
    taken, columns = {}, []
    for f in df.schema:
        name = maps.get(fold(f.name), f.name)
        if fold(f.name) in out or fold(name) in out:
            continue
        if fold(name) in taken:
            raise CopyError(f"columns {taken[fold(name)]} and {f.name} would both become {name}")
        taken[fold(name)] = f.name
        target = kinds.get(fold(f.name), kinds.get(fold(name)))
        if target and target not in TARGETS:
            raise CopyError(f"unknown conversion {target} of {f.name}")
        column = F.col("`" + f.name.replace("`", "``") + "`")
        columns.append((convert(column, f.dataType, target) if target else column).alias(name))
    if not columns:
        raise CopyError("no column is left to copy")
    return df.select(*columns)


@dataclass(frozen=True)
class ColumnInfo:
    name: str
    primary_key: bool = False
    identity: bool = False
    generated: bool = False


@dataclass(frozen=True)
class CopyOptions:
    """Of a whole run. allow_unordered: pages of sources that page may come in any order. missing_is_empty: a source that
    isn't there has no rows. schema_only: a source without rows is written as an empty table (else nothing is written)."""

    page_size: int | None = None
    batch_size: int | None = None
    timeout: float = 600.0
    allow_unordered: bool = False
    missing_is_empty: bool = False
    schema_only: bool = True

    def __post_init__(self):
        for name in ("page_size", "batch_size", "timeout"):
            if getattr(self, name) is not None and getattr(self, name) <= 0:
                raise CopyError(f"{name} must be positive")


@dataclass
class TableResult:
    source: str
    destination: str
    source_rows: int | None
    copied_rows: int
    destination_rows: int | None
    verified: bool


@dataclass
class Manifest:
    operation: str
    started: float
    ended: float
    fingerprint: str
    tables: list[TableResult]
    warnings: list[str]
    version: str = VERSION

    def total(self) -> int | None:
        """Rows copied; unknown if any table's count is."""
        counts = [t.copied_rows for t in self.tables]
        return None if any(c is None for c in counts) else sum(counts)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The manifest as a table, for an audit."""
        found = [(self.operation, self.fingerprint, self.version, t.source, t.destination, t.source_rows, t.copied_rows, t.destination_rows, t.verified) for t in self.tables]
        return spark.createDataFrame(found, "operation string, fingerprint string, version string, source string, destination string, source_rows long, copied_rows long, destination_rows long, verified boolean")


def fingerprint(specs: list[CopySpec]) -> str:
    """SHA-256 of the specs as length-prefixed canonical text."""
    digest = hashlib.sha256()
    for s in specs:
        parts = [s.source, s.destination, *s.order_by, *(x for kv in sorted(s.mappings.items()) for x in kv), *sorted(s.exclusions), *(x for kv in sorted(s.conversions.items()) for x in kv), *s.dedupe_keys, *s.winners, str(s.ignore_case)]
        for part in parts:
            digest.update(f"{len(part)}:{part};".encode())
        digest.update(b"|")
    return digest.hexdigest()


#: Ports that a server has if none is said.
PORTS = {"postgresql": "5432", "mysql": "3306", "mariadb": "3306", "sqlserver": "1433", "oracle": "1521"}


def identity(place: str) -> str:
    """A place in one spelling: real paths of files; servers without credentials, the local one as localhost, with its
    port; names without quotes, ignoring case."""
    text = place.strip()
    if m := re.match(r"^(?:jdbc:)?(\w+)://(?:[^@/]*@)?(\(local\)|[^/:?;#]+)(?::(\d+))?(/[^?;#]*)?(?:[?;]([^#]*))?(?:#(.*))?$", text):
        kind, host, port, path, _, table = m.groups()
        if kind.lower() in PORTS:
            host = "localhost" if host.lower() in (".", "(local)", "127.0.0.1", "localhost", "::1") else host.lower()
            return f"{kind.lower()}://{host}:{port or PORTS[kind.lower()]}{(path or '').lower()}#{identity(table) if table else ''}"
    if text.startswith("file:") or text.startswith("/"):
        path, _, table = re.sub("^file:/*", "/", text).partition("#")
        return f"file://{os.path.realpath(path)}" + (f"#{identity(table)}" if table else "")
    if "://" in text:
        return text.rstrip("/")
    return re.sub(r'["`\[\]]', "", text).lower()


def same_place(a: str, b: str) -> bool:
    """Whether two names mean one table. One with fewer parts is compared by its last parts: it may mean the other."""
    x, y = identity(a), identity(b)
    if "://" in x or "://" in y:
        return x == y
    n = min(x.count("."), y.count(".")) + 1
    return x.split(".")[-n:] == y.split(".")[-n:]


#: How stores say that a table isn't there, and how they say that of a column, which is another matter.
NO_TABLE = re.compile(r"no such table|invalid object name|table_or_view_not_found|path_not_found|ora-00942|\b(?:relation|schema|table|view)\b.*\b(?:does not|doesn't) exist", re.DOTALL)
NO_COLUMN = re.compile(r"no such column|unknown column|invalid column name|unresolved_column|\bcolumn\b.*\bdoes not exist", re.DOTALL)


def missing_table(error: BaseException | None) -> bool:
    """Whether an error, or one that caused it, says that a table isn't there. What says that of a column, a role or a function isn't one."""
    while error is not None:
        said = str(error).split("\n== SQL")[0].lower()
        if NO_COLUMN.search(said):
            return False
        if isinstance(error, FileNotFoundError) or NO_TABLE.search(said):
            return True
        error = error.__cause__
    return False


def _absent(work: Callable[[], Any], options: CopyOptions, without: Any) -> Any:
    """What work gives, or `without` if a table isn't there and that is allowed."""
    try:
        return work()
    except Exception as error:
        if options.missing_is_empty and missing_table(error):
            return without
        raise


def check_run(specs: list[CopySpec], clear: bool, options: CopyOptions, paged: bool = False) -> None:
    """The rules of a run that metadata alone can tell."""
    for s in specs:
        if same_place(s.source, s.destination):
            raise CopyError(f"{s.source} would be copied onto itself")
        if clear and any(same_place(s.destination, o.source) for o in specs):
            raise CopyError(f"clearing {s.destination} would remove a source")
        if paged and not s.order_by and not options.allow_unordered:
            raise CopyError(f"{s.source} is read in pages and has no order: allow_unordered accepts that pages may overlap")
        if s.winners and not s.dedupe_keys:
            raise CopyError(f"{s.source}: winners without keys to dedupe by")
    if any(same_place(a.destination, b.destination) for i, a in enumerate(specs) for b in specs[:i]):
        raise CopyError("two tables have one destination")


def taking(function: Callable[..., Any], name: str, value: int | None) -> Callable[..., Any]:
    """The function with an option that was given; one that it doesn't take is refused, as it would do nothing."""
    if value is None:
        return function
    known = inspect.signature(function).parameters
    if name not in known and not any(p.kind == p.VAR_KEYWORD for p in known.values()):
        raise CopyError(f"{name} is given, and nothing takes it")
    return functools.partial(function, **{name: value})


def within_time(spark: SparkSession, seconds: float, work: Callable[[], None], what: str) -> None:
    """work, whose Spark jobs are stopped after so many seconds."""
    context, tag, late = spark.sparkContext, f"copy-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    context.addJobTag(tag)
    timer.start()
    try:
        work()
    except Exception as error:
        if late.is_set():
            raise CopyError(f"{what} took more than {seconds} seconds and was stopped") from error
        raise
    finally:
        timer.cancel()
        context.removeJobTag(tag)


def _renamed(spec: CopySpec) -> list[str]:
    maps = {k.lower(): v for k, v in spec.mappings.items()}
    return [maps.get(k.lower(), k) for k in spec.order_by]


def copy_tables(specs: list[CopySpec], read: Callable[[str], DataFrame], write: Callable[[DataFrame, str], None], count: Callable[[str], int | None], clear: Callable[[str], None] | None = None, progress: Callable[[str, int], None] | None = None, options: CopyOptions = CopyOptions(), columns: Callable[[str], list[str] | None] | None = None, paged: bool = False, warnings: list[str] | None = None, back: Callable[[str], DataFrame] | None = None) -> Manifest:
    """Copy each table. read may take a page_size and write a batch_size: options that nobody takes are refused. A table takes at most
    options.timeout seconds to write, then its jobs are stopped. back: given, reads a destination back, whose content is compared by digests with the
    source's (which is read again for that); counts alone don't tell what changed, and where a store doesn't know its count, only this verifies.
    clear: given, destinations are emptied first, last to first, after every table has
    passed preflight: it can be read, its plan is sound, and the destination (columns(name): its columns, None if it isn't
    there yet) has a place for each column. Source rows and copied rows are counted by the job that writes: nothing
    is read twice, so a source that changes meanwhile does no harm. Counts that don't fit raise."""
    started, said, frames = time.time(), list(warnings or []), []
    check_run(specs, clear is not None, options, paged)
    read, given = taking(read, "page_size", options.page_size), {} if options.batch_size is None else {"batch_size": options.batch_size}
    taking(write, "batch_size", options.batch_size)
    for s in specs:
        df = _absent(lambda s=s: read(s.source), options, None)
        if df is None:
            said.append(f"{s.source}:MissingSourceTable")
            frames.append((None, None))
            continue
        seen = Observation(f"source-{uuid.uuid4().hex}")
        if s.dedupe_keys:
            df = dedupe(df, s.dedupe_keys, s.winners, s.ignore_case)
        df = transform(df.observe(seen, F.count(F.lit(1)).alias("rows")), s)
        there = columns(s.destination) if columns else None
        if there is not None and (lost := {c.lower() for c in df.columns} - {c.lower() for c in there}):
            raise CopyError(f"{s.destination} has no columns {sorted(lost)}")
        some = transform(read(s.source), s).limit(1).collect()  # preflight: the plan runs before anything is cleared
        frames.append((df if some or options.schema_only else df.limit(0), seen if some else None))
    if clear:
        for s in reversed(specs):
            if not _absent(lambda s=s: (clear(s.destination), True)[1], options, False):
                said.append(f"{s.destination}:MissingDestinationTable")
    results = []
    for s, (df, source_seen) in zip(specs, frames, strict=True):
        before = _absent(lambda s=s: count(s.destination), options, 0)
        if df is None or source_seen is None and not options.schema_only:
            results.append(TableResult(s.source, s.destination, 0, 0, before, True))
        elif clear and before:
            raise CopyError(f"{s.destination} still has {before} rows after it was cleared; nothing was written to it")
        else:
            seen = Observation(f"copy-{uuid.uuid4().hex}")
            frame = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            within_time(frame.sparkSession, options.timeout, lambda s=s, frame=frame: write(frame, s.destination, **given), s.destination)
            copied, source_rows, after = seen.get["rows"], source_seen.get["rows"] if source_seen else 0, count(s.destination)
            sound = source_rows == copied and (after is None or after == (before or 0) + copied)
            if sound and back is not None:
                if before:
                    raise CopyError(f"{s.destination} had rows before: its content can't be compared with the source's")
                found = verify.compare(df, back(s.destination), list(df.columns if not s.order_by else _renamed(s)))
                if not found.same():
                    raise CopyError(f"{s.destination}: {len(found.differing)} of {found.buckets} buckets differ from the source")
            results.append(TableResult(s.source, s.destination, source_rows, copied, after, sound and (after is not None or back is not None)))
            if not sound:
                raise CopyError(f"{s.destination}: source {source_rows}, copied {copied}, before {before}, now {after}")
        if progress:
            progress(s.destination, min(100, 100 * len(results) // len(specs)))
    return Manifest(uuid.uuid4().hex, started, time.time(), fingerprint(specs), results, said)
