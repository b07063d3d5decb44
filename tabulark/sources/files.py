"""File sources and sinks: CSV (plain or gzip), JSON, Parquet, ORC, text; CSV loads as plans; option checks; providers."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import csv_blocks

REQUIRED = {"csv": ("path",), "json": ("path",), "parquet": ("path",), "orc": ("path",), "text": ("path",), "jdbc": ("url", "dbtable"), "sqlite": ("path",)}
#: What providers of tables can do.
CAPABILITIES = ("query", "stream", "write", "bulk_write", "procedures", "metadata", "transaction")
PROVIDERS = {
    "parquet": ("query", "stream", "write", "bulk_write", "metadata", "transaction"),
    "csv": ("query", "stream", "write", "bulk_write"),
    "json": ("query", "stream", "write", "bulk_write"),
    "orc": ("query", "stream", "write", "bulk_write"),
    "text": ("query", "stream", "write"),
    "jdbc": ("query", "write", "bulk_write", "metadata"),
    "sqlite": ("query", "write", "bulk_write", "metadata", "transaction"),
    "entities": ("query", "write"),
}
ALIASES = {"pq": "parquet", "tsv": "csv", "sqlite3": "sqlite", "postgres": "jdbc", "postgresql": "jdbc", "mysql": "jdbc", "sqlserver": "jdbc", "oracle": "jdbc", "derby": "jdbc"}
SECRETS = ("password", "token", "secret", "key")


def check_options(format_: str, options: dict[str, str]) -> None:
    if format_ not in REQUIRED:
        raise ValueError(f"unknown format: {format_}")
    if missing := [k for k in REQUIRED[format_] if not options.get(k)]:
        raise ValueError(f"{format_} needs {', '.join(missing)}")


def provider(name: str) -> str:
    """A provider by its name or an alias, ignoring case."""
    found = ALIASES.get(name.strip().lower(), name.strip().lower())
    if found not in PROVIDERS:
        raise ValueError(f"unknown provider: {name}")
    return found


def capabilities(spark: SparkSession) -> DataFrame:
    """(provider, capability, supported) for each of both."""
    rows = [(p, c, c in has) for p, has in PROVIDERS.items() for c in CAPABILITIES]
    return spark.createDataFrame(rows, "provider string, capability string, supported boolean")


def connection_url(kind: str, host: str, database: str, port: int | None = None, encrypt: bool = True, trust_server: bool = False, **options: str) -> str:
    """A JDBC URL, encrypted unless asked otherwise; credentials don't belong in it."""
    ports = {"postgresql": 5432, "mysql": 3306, "sqlserver": 1433}
    if kind not in ports:
        raise ValueError(f"unknown kind: {kind}")
    if not host or not database or re.search(r"[;/?#\s@]", host + database):
        raise ValueError("host and database are names")
    if bad := [k for k in options if any(s in k.lower() for s in SECRETS) or k.lower() in ("user", "uid")]:
        raise ValueError(f"credentials don't belong in a URL: {bad}")
    if trust_server and not encrypt:
        raise ValueError("a server is trusted only where the connection is encrypted")
    at = f"{host}:{port or ports[kind]}"
    if kind == "sqlserver":
        pairs = {"databaseName": database, "encrypt": str(encrypt).lower(), "trustServerCertificate": str(trust_server).lower(), **options}
        return f"jdbc:sqlserver://{at};" + ";".join(f"{k}={v}" for k, v in pairs.items())
    mode = {"postgresql": ("sslmode", "require" if trust_server else "verify-full", "disable"), "mysql": ("sslMode", "REQUIRED" if trust_server else "VERIFY_IDENTITY", "DISABLED")}[kind]
    pairs = {mode[0]: mode[1] if encrypt else mode[2], **options}
    return f"jdbc:{kind}://{at}/{database}?" + "&".join(f"{k}={v}" for k, v in pairs.items())


def shown(options: dict[str, str]) -> dict[str, str]:
    """Options as they may be logged."""
    return {k: "***" if any(s in k.lower() for s in SECRETS) else v for k, v in options.items()}


def read(spark: SparkSession, format_: str, schema: str | None = None, **options: str) -> DataFrame:
    check_options(format_, options)
    reader = spark.read.format(format_)
    if schema:
        reader = reader.schema(schema)
    path = options.pop("path", None) if format_ not in ("jdbc", "sqlite") else None
    return reader.options(**options).load(path)


#: What CSV is written and read with: quotes are doubled, blanks stay, and a quoted empty text isn't null.
CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
NOTHING = "\x01null"


def read_csv(spark: SparkSession, path: str, schema: str, static: dict[str, str] | None = None, **options: str) -> DataFrame:
    """CSV with a header and a given schema; bad rows fail unless mode says otherwise; static columns are added. Texts may hold
    line ends: see load_csv()."""
    asked = {**CSV, "nullValue": NOTHING, "mode": "FAILFAST", **options}
    df = _parsed(spark, path, schema, asked, True, 0, None)
    return df.withColumns({k: F.lit(v) for k, v in (static or {}).items()})


def _parsed(spark: SparkSession, path: str, schema: str, asked: dict[str, str], header: bool, skip_rows: int, comment: str | None) -> DataFrame:
    """Spark's reader where every line is a record, else records cut out of blocks (see csv_blocks): one pass tells."""
    quote, encoding = asked.get("quote", '"'), asked.get("encoding", "UTF-8")
    if not skip_rows and csv_blocks.plain(csv_blocks.lines_of(spark, path, encoding), quote):
        return spark.read.schema(schema).options(header=str(header).lower(), **asked).csv(path)
    rows = csv_blocks.records(spark, path, quote, comment, skip_rows, header, encoding)
    own = {k: v for k, v in asked.items() if k not in ("encoding", "comment")}
    # no line end ends a record here
    return rows.select(F.from_csv("record", schema, {**own, "lineSep": "\x00", "multiLine": "true"}).alias("row")).select("row.*")


@dataclass(frozen=True)
class CsvOptions:
    """How a CSV is read. delimiter None: the one of , ; tab | that cuts the head evenly most often. skip_rows: lines
    before the header. null_tokens: texts that stand for null, besides the empty one. mismatch, for rows with too
    many or too few fields or values of another type: fail, drop or null (what can't be read; the line is in
    _corrupt). static: columns with one value. checks: name -> condition in SQL that rows must meet."""

    header: bool = True
    delimiter: str | None = ","
    quote: str = '"'
    comment: str | None = None
    skip_rows: int = 0
    null_tokens: tuple[str, ...] = ()
    date_format: str | None = None
    timestamp_format: str | None = None
    encoding: str = "UTF-8"
    mismatch: str = "fail"
    static: dict[str, str] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.mismatch not in MODES:
            raise ValueError(f"unknown policy: {self.mismatch}")
        if self.skip_rows < 0 or self.delimiter is not None and len(self.delimiter) != 1:
            raise ValueError("skip_rows isn't negative, a delimiter is one character")


MODES = {"fail": "FAILFAST", "drop": "PERMISSIVE", "null": "PERMISSIVE"}


def delimiter_of(lines: list[str]) -> str:
    """The candidate that occurs equally often (once at least) in most of the lines; the first of equals."""
    best = max(",;\t|", key=lambda d: (sum(line.count(d) == lines[0].count(d) > 0 for line in lines), -",;\t|".index(d))) if lines else ","
    return best


def load_csv(spark: SparkSession, path: str, schema: str, options: CsvOptions = CsvOptions()) -> DataFrame:
    """A CSV with a given schema, in parallel whatever its files hold: line ends in quoted texts, lines before the header."""
    text = spark.read.option("encoding", options.encoding)
    delimiter = options.delimiter or delimiter_of([r[0] for r in text.text(path).limit(20).collect()][options.skip_rows :])
    asked = {**CSV, "sep": delimiter, "quote": options.quote, "escape": options.quote, "comment": options.comment, "dateFormat": options.date_format, "timestampFormat": options.timestamp_format, "timestampNTZFormat": options.timestamp_format, "encoding": options.encoding, "mode": MODES[options.mismatch], "nullValue": NOTHING, "columnNameOfCorruptRecord": "_corrupt"}
    shape = schema + ("" if options.mismatch == "fail" else ", _corrupt string")
    df = _parsed(spark, path, shape, {k: v for k, v in asked.items() if v is not None}, options.header, options.skip_rows, options.comment)
    if options.mismatch == "drop":
        # which rows are malformed is known only if all columns are read: the hash (never 0 here) asks for them
        df = df.where(F.col("_corrupt").isNull() & (F.xxhash64(*[c for c in df.columns if c != "_corrupt"]).bitwiseOR(F.lit(1).cast("long")) != 0)).drop("_corrupt")
    if options.null_tokens:
        df = df.withColumns({f.name: F.when(~F.col(f.name).isin(*options.null_tokens), F.col(f.name)) for f in df.schema if f.dataType.simpleString() == "string" and f.name != "_corrupt"})
    df = df.withColumns({k: F.lit(v) for k, v in options.static.items()})
    for name, test in options.checks.items():
        df = df.where(F.coalesce(F.when(~F.expr(test), F.raise_error(F.lit(f"check {name} failed")).cast("boolean")).otherwise(True), F.lit(True)))
    return df


@dataclass(frozen=True)
class CsvPlan:
    """A load that is looked at before it is run: if what it was made from has changed meanwhile, it isn't run."""

    path: str
    schema: str
    destination: str
    options: CsvOptions
    rows: int
    sources: tuple[tuple[str, int, int], ...]
    fingerprint: str


def _files(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of each file."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(root)
    if not found:
        raise FileNotFoundError(path)
    listed = [f for s in found for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s])]
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in listed if not f.getPath().getName().startswith(("_", "."))))


def plan_csv(spark: SparkSession, path: str, schema: str, destination: str, options: CsvOptions = CsvOptions()) -> CsvPlan:
    """Reads the whole CSV once, so a plan that was made can be read; nothing is written."""
    sources = _files(spark, path)
    rows = load_csv(spark, path, schema, options).count()
    spec = {"path": path, "schema": schema, "destination": destination, "options": asdict(options), "rows": rows, "sources": sources}
    return CsvPlan(path, schema, destination, options, rows, sources, spec_fingerprint(spec))


def run_csv(spark: SparkSession, plan: CsvPlan, write: Callable[[DataFrame, str], None], expect: str | None = None, refresh: Callable[[str], None] | None = None) -> dict:
    """Load what was planned; rows are counted by the write and must be as many as planned. refresh: what is to be
    done with the destination after that."""
    from pyspark.sql import Observation

    spec = {"path": plan.path, "schema": plan.schema, "destination": plan.destination, "options": asdict(plan.options), "rows": plan.rows, "sources": _files(spark, plan.path)}
    if spec_fingerprint(spec) != plan.fingerprint or expect is not None and expect != plan.fingerprint:
        raise ValueError("the plan or its files have changed since it was made")
    began, seen = time.time(), Observation()
    write(load_csv(spark, plan.path, plan.schema, plan.options).observe(seen, F.count(F.lit(1)).alias("rows")), plan.destination)
    if seen.get["rows"] != plan.rows:
        raise ValueError(f"{seen.get['rows']} rows came where {plan.rows} were planned")
    if refresh:
        refresh(plan.destination)
    return {"rows": plan.rows, "destination": plan.destination, "fingerprint": plan.fingerprint, "seconds": time.time() - began, "refreshed": refresh is not None}


def write_csv(df: DataFrame, path: str, gzip: bool = False, mode: str = "error") -> None:
    """CSV with a header, as RFC 4180 has it: quotes doubled, texts with line ends quoted, null unquoted and empty."""
    df.write.mode(mode).options(header="true", **CSV).csv(path, compression="gzip" if gzip else "none")


def spec_fingerprint(spec: dict) -> str:
    return hashlib.sha256(json.dumps(spec, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def probe(df: DataFrame) -> bool:
    """Whether a source answers: its plan runs for no rows."""
    df.limit(0).collect()
    return True
