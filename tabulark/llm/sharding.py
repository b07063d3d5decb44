"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group that no shard boundary may cut. Groups, largest first, go to the
bin with the least remaining capacity that still takes them; a balanced tree (a treap over
(remaining, bin)) finds it in logarithmic time. Groups of one size are packed as a run: the tightest bin
takes as many as fit before the next is looked up, which is what one-by-one packing does too, so the
driver handles the histogram of sizes and never the groups themselves. Sizes below 2^EXACT_BITS (2 MiB) are exact;
larger ones are packed as if up to a 2^20th larger, so the histogram has a bounded number of entries.

With a fixed number of shards the capacity is the least, found by galloping up from the average and bisection, at
which no more bins are needed. A group larger than total / shards can't be balanced whole; it is split at row
boundaries into pieces below that (the `bytes` law comes before indivisibility; only such groups are cut).
Law: `bytes`: sizes near equal. Slots are gapless from 0 in each shard, by two-level ranks.

Defined results: null texts count as empty (size 1); equal texts incl. null and empty form one
group; repeated rows, also of null ids, are members like any other; a text of any length is one row of one shard;
an empty table has no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import discard, materialize

EXACT_BITS = 21


class Treap:
    """Balanced search tree of keys; ceiling(x) is the least key >= x."""

    def __init__(self, seed: int = 42):
        self.root, self.rng = None, random.Random(seed)

    @staticmethod
    def _split(node, key):
        if node is None:
            return None, None
        if node[0] < key:
            left, right = Treap._split(node[3], key)
            node[3] = left
            return node, right
        left, right = Treap._split(node[2], key)
        node[2] = right
        return left, node

    @staticmethod
    def _merge(a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = Treap._merge(a[3], b)
            return a
        b[2] = Treap._merge(a, b[2])
        return b

    def add(self, key) -> None:
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self.rng.random(), None, None]), right)

    def remove(self, key) -> None:
        left, right = self._split(self.root, key)
        _, right = self._split(right, (*key[:-1], key[-1] + 1))
        self.root = self._merge(left, right)

    def ceiling(self, key):
        node, best = self.root, None
        while node is not None:
            if node[0] < key:
                node = node[3]
            else:
                best, node = node[0], node[2]
        return best


def best_fit_decreasing(runs: list[tuple[int, int]], capacity: int, bins: int | None = None) -> list[tuple[int, int, int]] | None:
    """runs: (size, how many), any order. Returns (size, bin, how many) in the order packed; bins
    are opened as needed, or None if that takes more than `bins` or a group exceeds the capacity."""
    tree, opened, out = Treap(), 0, []
    for size, left in sorted(runs, reverse=True):
        if size > capacity:
            return None
        while left:
            found = tree.ceiling((size, -1))
            if found is None:
                if opened == bins:
                    return None
                found, opened = (capacity, opened), opened + 1
            else:
                tree.remove(found)
            room, number = found
            take = min(left, room // size)
            out.append((size, number, take))
            left -= take
            tree.add((room - take * size, number))
    return out


def pack(runs: list[tuple[int, int]], bins: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Least capacity found at which best fit decreasing needs at most `bins` bins, and the packing."""
    total = sum(s * n for s, n in runs)
    low = high = max([1, -(-total // bins), *(s for s, _ in runs)])
    step, best = 1, best_fit_decreasing(runs, high, bins)
    while best is None:  # a capacity of total takes all
        low, high, step = high + 1, min(high + step, max(total, 1)), 2 * step
        best = best_fit_decreasing(runs, high, bins)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(runs, middle, bins)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    return high, best


def rounded(size):
    """Column: size, up to EXACT_BITS significant bits."""
    unit = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.floor(F.log2(size.cast("double"))) - (EXACT_BITS - 1))).cast("long")
    return (F.ceil(size / unit) * unit).cast("long")


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", fine: int = 256) -> DataFrame:
    """One row per document: id_col, size, text_crc32, law, shard, slot, grown_shard (null: not by key)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = materialize(rows.withColumn("deal", F.pmod(F.monotonically_increasing_id(), F.lit(fine)).cast("int")), "rows")
    groups = rows.groupBy("digest", "size").agg(F.count("*").alias("members"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # pieces of a group: one, unless it is larger than a shard's share
    share = max(1, total // shards)
    per_piece = F.greatest(F.lit(1), F.floor(F.lit(share // 2) / F.col("size"))).cast("long")
    groups = groups.withColumn("per_piece", F.when(F.col("members") * F.col("size") > share, per_piece).otherwise(F.col("members")))
    pieces = groups.select("digest", "size", "per_piece", "members", F.explode(F.expr("sequence(0L, (members - 1) div per_piece)")).alias("piece"))
    pieces = pieces.select("digest", "piece", "per_piece", rounded(F.least("per_piece", F.expr("members - piece * per_piece")) * F.col("size")).alias("bulk"), F.pmod(F.xxhash64("digest", "piece"), F.lit(fine)).cast("int").alias("cell"))
    pieces = materialize(pieces, "pieces")
    # rank of a piece among those of its size: cells of a size first, then within the cell
    cells = pieces.groupBy("bulk", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bulk").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("bulk", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    runs = [(r["bulk"], r["n"]) for r in pieces.groupBy("bulk").agg(F.count("*").alias("n")).collect()]  # bounded: sizes of EXACT_BITS significant bits
    packed, spans, done = pack(runs, shards)[1], [], {}
    for bulk, number, n in packed:
        spans.append((bulk, done.get(bulk, 0), done.get(bulk, 0) + n, number))
        done[bulk] = done.get(bulk, 0) + n
    # at most (sizes + shards) spans, as small as the histogram
    plan = spark.createDataFrame(spans, "bulk long, from long, to long, shard int").groupBy("bulk").agg(F.array_sort(F.collect_list(F.struct("from", "to", "shard"))).alias("spans"))
    ranked = pieces.join(cells.hint("merge"), ["bulk", "cell"])
    ranked = ranked.withColumn("rank", F.col("offset") + F.row_number().over(Window.partitionBy("bulk", "cell").orderBy("digest", "piece")) - 1)
    placed = ranked.join(plan, "bulk").select("digest", "piece", "per_piece", F.expr("filter(spans, s -> rank >= s.from and rank < s.to)[0].shard").alias("shard"))
    small = placed.groupBy("digest").agg(F.first("per_piece").alias("per_piece"), F.max(F.col("piece") + 1).alias("n_pieces"), F.sort_array(F.collect_list(F.struct("piece", "shard"))).alias("where"))
    # members of a cut group are dealt to its pieces by rank, in two levels as well
    joined = rows.join(small.hint("merge"), "digest").withColumnRenamed("deal", "cell")
    whole = joined.where("n_pieces = 1").select("id", "size", "crc", "cell", F.expr("where[0].shard").alias("shard"))
    cut = joined.where("n_pieces > 1")
    in_cell = cut.groupBy("digest", "cell").agg(F.count("*").alias("n"))
    in_cell = in_cell.select("digest", "cell", F.coalesce(F.sum("n").over(Window.partitionBy("digest").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    cut = cut.join(in_cell, ["digest", "cell"]).withColumn("rank", F.col("offset") + F.row_number().over(Window.partitionBy("digest", "cell").orderBy("id")) - 1)
    cut = cut.select("id", "size", "crc", "cell", F.expr("where[int(rank div per_piece)].shard").alias("shard"))
    dealt = materialize(whole.unionByName(cut), "dealt")
    discard(rows)
    discard(pieces)
    slots = dealt.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    slots = slots.select("shard", "cell", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    out = dealt.join(slots, ["shard", "cell"]).withColumn("slot", F.col("offset") + F.row_number().over(Window.partitionBy("shard", "cell").orderBy("id", "crc")) - 1)
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
