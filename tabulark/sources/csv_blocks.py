"""CSV with line ends in quoted fields, read in parallel.

Whether a line end ends a record depends on all quotes before it, so a reader that starts in the middle of a file can't
know. Blocks of lines are read twice. The first pass counts each block's quotes, and keeps, for either state that the block may
begin in (outside a field or inside one), the lines before its first record end and after its last. A prefix sum of the blocks'
parities says which state it was. The second pass then cuts each block into the records that lie within it, and
those that cross borders are put together from the pieces of the first. Records are parsed by Spark (from_csv).

Quotes within a field are doubled, and a field with a quote is quoted itself, as RFC 4180 has it. Lines end in LF or CR LF. A piece is
as long as a record is; a file's pieces are two for each of its blocks. Lines to skip lie in a file's first block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship

#: More blocks than this are refused: what is known of each is sent to every task.
BLOCKS = 1_000_000
PIECES = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("parity", pa.int32()), ("head0", pa.string()), ("tail0", pa.string()), ("whole0", pa.int64()), ("head1", pa.string()), ("tail1", pa.string()), ("whole1", pa.int64())])


def lines_of(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(value, file, block): the lines of files, in order within each block."""
    rows = spark.read.option("lineSep", "\n").option("encoding", encoding).text(path)
    return rows.select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def plain(lines: DataFrame, quote: str = '"') -> bool:
    """Whether every line is a record, and so Spark's own reader will do: no line has an odd number of quotes or a CR."""
    n = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    odd = lines.agg(F.max((n % 2 == 1) | F.contains("value", F.lit("\r")))).first()[0]
    return not odd


class Block:
    """Lines of one block, and the state after each, if it begins outside a field."""

    def __init__(self, quote: str, comment: str | None, skip: int):
        self.quote, self.comment, self.skip = quote, comment, skip
        self.lines: list[str] = []

    def ends(self, inside: int) -> np.ndarray:
        """For each line whether a record ends with it."""
        if not self.lines:
            return np.zeros(0, bool)
        quotes = np.array([s.count(self.quote) for s in self.lines], np.int64) & 1
        if not self.comment or not any(s.startswith(self.comment) for s in self.lines):
            return (np.cumsum(quotes) + inside) % 2 == 0
        out = np.zeros(len(quotes), bool)
        for i, s in enumerate(self.lines):
            if inside or not s.startswith(self.comment):
                inside ^= int(quotes[i])
            out[i] = not inside
        return out

    def pieces(self, inside: int) -> tuple[str | None, str | None, int, int]:
        """What comes before the first record end (None: the block begins with a record), after the last (None: nothing),
        how many records lie within, and the state at the end. A block without a record end is all tail."""
        done = np.flatnonzero(self.ends(inside))
        if not len(done):
            return None, "\n".join(self.lines), 0, 1
        first, last = int(done[0]), int(done[-1])
        tail = "\n".join(self.lines[last + 1 :]) if last + 1 < len(self.lines) else None
        return ("\n".join(self.lines[: first + 1]) if inside else None), tail, len(done) - bool(inside), int(tail is not None)

    def records(self, inside: int) -> list[str]:
        """Records that lie within the block, without comments and empty ones."""
        ended = self.ends(inside)
        done = np.flatnonzero(ended)
        if not len(done):
            return []
        starts = np.concatenate([[0], done[:-1] + 1])
        pairs = list(zip(starts.tolist(), done.tolist(), strict=True))[bool(inside) :]
        return ["\n".join(self.lines[a : b + 1]) if b > a else self.lines[a] for a, b in pairs]


def _by_block(batches: Iterator[pa.RecordBatch], quote: str, comment: str | None, skip: int) -> Iterator[tuple[int, int, Block, dict]]:
    """Whole blocks, one after the other."""
    current, held, more = None, None, {}
    for batch in batches:
        files, blocks = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        cuts = np.flatnonzero(np.r_[True, (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])]) if len(files) else []
        for a, b in zip(cuts, [*cuts[1:], len(files)], strict=True):
            key = int(files[a]), int(blocks[a])
            if key != current:
                if held:
                    yield *current, held, more
                current, held = key, Block(quote, comment, skip)
                more = {n: batch.column(i)[int(a)].as_py() for i, n in enumerate(batch.schema.names) if i > 2}
            lines = batch.column(0).slice(a, b - a).to_pylist()
            if key[1] == 0 and held.skip:
                n = min(held.skip, len(lines))
                lines, held.skip = lines[n:], held.skip - n
            if key[1] == 0 and held.skip and b < len(files):
                raise ValueError("the lines to skip go beyond the first block of a file")
            if key[1] == 0 and not held.lines and lines:
                lines[0] = lines[0].removeprefix("﻿")
            held.lines += lines
    if held:
        yield *current, held, more


def records(spark: SparkSession, path: str, quote: str = '"', comment: str | None = None, skip_rows: int = 0, header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """(record): the records of all files, without the lines to skip and the header of each."""
    ship(spark)
    lines = lines_of(spark, path, encoding)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, held, _ in _by_block(batches, quote, comment, skip_rows):
            h0, t0, n0, end0 = held.pieces(0)
            h1, t1, n1, _ = held.pieces(1)
            yield pa.RecordBatch.from_pylist([dict(zip(PIECES.names, (file, block, end0, h0, t0, n0, h1, t1, n1), strict=True))], PIECES)

    kinds = "file long, block long, parity int, head0 string, tail0 string, whole0 long, head1 string, tail1 string, whole1 long"
    from ..session import cut

    known = cut(lines.mapInArrow(measure, kinds))
    n = known.count()
    if n > BLOCKS:
        raise ValueError(f"{n} blocks: raise spark.sql.files.maxPartitionBytes")
    before = Window.partitionBy("file").orderBy("block")  # a row a block
    # a block that has no comments turns the state round by its parity; with comments it may not, but then ends outside either way
    known = known.withColumn("inside", F.pmod(F.coalesce(F.sum("parity").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lit(2)))
    pick = lambda c: F.when(F.col("inside") == 1, F.col(f"{c}1")).otherwise(F.col(f"{c}0")).alias(c)
    known = known.select("file", "block", F.col("inside").cast("int").alias("inside"), pick("head"), pick("tail"), pick("whole"))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, held, more in _by_block(batches, quote, comment, skip_rows):
            if more["inside"] is None:
                raise ValueError("files have changed while they were read")
            found = held.records(more["inside"])
            if block == 0 and header:
                found = [r for r in found if not comment or not r.startswith(comment)][1:]
            for at in range(0, len(found), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(found[at : at + 10_000], pa.string())], ["record"])

    states = F.broadcast(known.select(F.col("file").alias("_f"), F.col("block").alias("_b"), "inside"))
    joined = lines.join(states, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")), "left").select("value", "file", "block", "inside")
    within = joined.mapInArrow(cut_up, "record string")
    # pieces: a head ends the record that a tail began; a block without a record end is a tail between
    pieces = known.select("file", "block", "whole", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("head").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("tail").alias("text")))).alias("piece"), "inside").where("piece.text IS NOT NULL")
    begins = (F.col("piece.kind") == 1) & ~((F.col("inside") == 1) & (F.col("whole") == 0) & F.col("_only"))
    pieces = pieces.withColumn("_only", F.count(F.lit(1)).over(Window.partitionBy("file", "block")) == 1)
    group = F.sum(F.when(begins, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("block", "piece.kind").rowsBetween(Window.unboundedPreceding, 0))
    whole = pieces.withColumn("_group", group).groupBy("file", "_group").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", F.col("piece.kind").alias("kind"), F.col("piece.text").alias("text")))), lambda p: p["text"]), "\n").alias("record"), F.min("block").alias("_first"), F.min_by("whole", "block").alias("_whole"))
    if header:
        whole = whole.where(~((F.col("_first") == 0) & (F.col("_whole") == 0)))
    ends = F.regexp_replace("record", "\r$", "")
    every = within.unionByName(whole.select("record")).select(ends.alias("record")).where("record <> ''")
    return every.where(~F.startswith("record", F.lit(comment))) if comment else every
