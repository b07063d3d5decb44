"""What the operators of this subpackage share: tables in the shared folder, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in
    spark.checkpoint.dir. Only where that is unset, in local mode (tests), a folder of our own is used."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='tabulark-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh(columns: list[str], name: str) -> str:
    """name, with as many underscores as make it unlike any column."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def materialize(df: DataFrame, name: str, parts: list[str] | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: later plans start from
    files that outlive any executor, and nothing above is computed twice. parts: columns whose values have folders of
    their own (see part_of)."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*parts) if parts else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tabulark_path = path
    return out


def part_of(table: DataFrame, column: str, value: int) -> DataFrame:
    """The rows of a table with parts that have the value, without that column; may be discarded on its own. No rows
    make no folder."""
    spark, path = table.sparkSession, f"{table._tabulark_path}/{column}={value}"
    schema = type(table.schema)([f for f in table.schema if f.name != column])
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    out = spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
    out._tabulark_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by materialize(), once nothing unfinished reads it."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._tabulark_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a few bytes each that may be sent to every executor.
FEW = 500_000


def bounded(df: DataFrame, most: int = FEW) -> DataFrame:
    """A slim table, marked for broadcast if it has at most `most` rows; beyond that it is joined by shuffles.
    df: read from materialize(), so counting it costs next to nothing."""
    return broadcast(df) if df.count() <= most else df


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lift a function of one Arrow batch to what mapInArrow takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run


_shipped: dict[str, bool] = {}


def ship(spark: SparkSession) -> None:
    """Give executors this package: its sources, zipped, by Spark's own file server. Once a context."""
    import os
    import zipfile

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped[context.applicationId] = True
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tabulark-"), "tabulark_sources.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
    context.addPyFile(target)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of jobs that are over and that nothing refers to."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
