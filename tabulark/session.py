"""Sessions, table views, and tables in the shared folder."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
_schemas: dict[str, tuple[tuple, StructType]] = {}


def session(app: str = "tabulark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with time zone UTC, ANSI errors and adaptive execution; further settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    pinned = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true"}
    for key, value in {**pinned, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _listing(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a table's files: what its schema depends on."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(root)) if fs.exists(root) else ()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder. Its schema is read once for as long as its files are the same."""
    path = f"{folder}/{name}.parquet"
    files = _listing(spark, path)
    if path not in _schemas or _schemas[path][0] != files:
        _schemas[path] = files, spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path][1]).parquet(path)


def named_in(text: str, tables: tuple = TABLES) -> tuple[str, ...]:
    """Tables whose names occur in a text."""
    words = set(re.findall(r"\w+", text))
    return tuple(t for t in tables if t in words)


def open_tables(spark: SparkSession, folder: str, tables: tuple = TABLES) -> None:
    """Register Parquet tables of a folder as temporary views."""
    for name in tables:
        table(spark, folder, name).createOrReplaceTempView(name)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, for Python functions that run there: its sources, zipped. Once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tabulark-"), "tabulark_engine.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
    context.addPyFile(target)


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the folder that spark.checkpoint.dir names (in local mode without one: a folder
    of our own): what follows starts from files that outlive any executor."""
    context = df.sparkSession.sparkContext
    if not (df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()):
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tabulark-"))
    elif not context.getCheckpointDir():
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir"))
    return df.checkpoint()
