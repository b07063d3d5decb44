"""Near-duplicate detection by SimHash and tables of distances to pivots.

A document's 64-bit fingerprint has bit i set if over half of its shingle hashes have it set.
Two documents are linked if their fingerprints differ in at most `radius` bits; a component is
what links connect. Copies share a fingerprint, so links are sought between *distinct*
fingerprints only and a group of copies costs one row.

Search. Every distinct fingerprint x gets its Hamming distances to reference fingerprints:

* an anchor and, for each bit j, the anchor with bit j flipped. The offsets
  d(x, flipped_j) - d(x, anchor) of a group of such pivots depend on the bits of that group
  alone. The 64 pivots form six groups; two fingerprints at distance <= 3 differ in at most three
  of them, so they have the same offsets in some *three* groups (20 choices). The offsets of three
  groups are the bucket key: no pair of texts is lost, and a bucket holds about n / 2^32 others.
* `spread` pivots at random. |d(x,p) - d(y,p)| <= d(x,y) for each, so pairs in a bucket whose
  largest coordinate difference is over the radius are discarded; survivors are verified.

Random pivots alone can't give the buckets: distances to them lie within 32 +- 4, so a cell as wide as the
radius allows holds a quarter of all fingerprints in each coordinate and must be probed with its neighbours.

A bucket of m near copies is not expanded into m^2 pairs: long runs are reduced to a spanning forest (a star
for each local component), so rows out stay linear. A task holds one bucket at a time, 8 bytes for each distinct
fingerprint that has half of its bits in common with the others; copies are one. Components are then joined
up by alternating large-star and small-star steps on tables in the shared folder.

Defined results: null and blank texts have fingerprint zero and link like any other; fewer than
`width` words hash as one shingle; texts of any length are read whole; repeated rows each get a row; a null
doc_id is ignored in the minimum (a component of nulls alone has a null id); an empty table gives no rows;
extra input columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import discard, map_arrow, materialize, per_batch, raw_texts

SEED = 42
#: Bits of the six pivot groups, of which three are equal.
GROUPS, EQUAL = (11, 11, 11, 11, 10, 10), 3
ANCHOR = 0x9E3779B97F4A7C15
#: Runs longer than this become stars in place instead of being listed pair by pair.
SHORT_RUN = 16
TILE = 1024


def fingerprint(raw: bytes, width: int = 3) -> int:
    words = raw.lower().split()  # bytes: A-Z only, and splits at \x20 \x09-\x0D only
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(s, SEED) for s in shingles), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set where over half of the hashes have them set."""
    counts, step = np.zeros(64, np.int64), 1 << 16
    for at in range(0, len(hashes), step):
        part = hashes[at : at + step]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): one row per document, fp a signed 64-bit fingerprint."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(b, width) for b in raw_texts(batch.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["id", "fp"])

    return map_arrow(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")), per_batch(run), "id long, fp long")


def pivots(spread: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor and its 64 flips; `spread` pivots at random."""
    flips = np.uint64(ANCHOR) ^ np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
    return flips, np.random.default_rng(SEED).integers(0, 2**64, spread, np.uint64)


def distances(fps: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ to[None, :]).astype(np.int8)


def bucket_keys(fps: np.ndarray) -> np.ndarray:
    """(n, 20) keys: offsets of three pivot groups, packed, with the number of the choice on top."""
    table = distances(fps, pivots(0)[0])
    nearer = table[:, 1:] < table[:, :1]
    packed, at = [], 0
    for bits in GROUPS:
        packed.append(nearer[:, at : at + bits] @ (1 << np.arange(bits, dtype=np.int64)))
        at += bits
    return np.stack([(k << 33) | (packed[a] << 22) | (packed[b] << 11) | packed[c] for k, (a, b, c) in enumerate(combinations(range(len(GROUPS)), EQUAL))], axis=1)


def _survivors(x: np.ndarray, y: np.ndarray, tx: np.ndarray, ty: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs (x[i], y[i]) are links: pivot table first, then the exact distance."""
    keep = np.flatnonzero(np.abs(tx - ty).max(axis=1) <= radius)
    return keep[np.bitwise_count(x[keep] ^ y[keep]) <= radius]


def run_stars(fps: np.ndarray, table: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars of the components within one bucket, without listing its pairs.

    Breadth first: each fingerprint reached is compared once with those not reached yet, which
    are sorted by their distance to the first pivot, so that only a window of it is looked at."""
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    first, left = table[:, 0], np.ones(len(fps), bool)
    hubs, leaves = [], []
    for root in range(len(fps)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            lo, hi = np.searchsorted(first, first[i] - radius, "left"), np.searchsorted(first, first[i] + radius, "right")
            for at in range(lo, hi, TILE * 16):
                near = np.flatnonzero(left[at : min(hi, at + TILE * 16)]) + at
                if not len(near):
                    continue
                near = near[np.abs(table[near] - table[i]).max(axis=1) <= radius]
                near = near[np.bitwise_count(fps[near] ^ fps[i]) <= radius]
                left[near] = False
                queue.extend(near.tolist())
                hubs.append(np.full(len(near), fps[root]))
                leaves.append(fps[near])
    empty = np.zeros(0, np.uint64)
    return np.concatenate(hubs or [empty]), np.concatenate(leaves or [empty])


def _links_in(keys: np.ndarray, fps: np.ndarray, radius: int, spread: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within equal keys; keys are sorted and no run is cut."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    size_of = np.repeat(sizes, sizes)
    out_a, out_b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    _, to = pivots(spread)
    some = np.flatnonzero((size_of > 1) & (size_of <= SHORT_RUN))
    if len(some):
        k, x = keys[some], fps[some]
        table = distances(x, to)
        for shift in range(1, min(SHORT_RUN, len(some))):
            same = np.flatnonzero(k[shift:] == k[:-shift])
            if not len(same):
                break
            hit = same[_survivors(x[same], x[same + shift], table[same], table[same + shift], radius)]
            out_a.append(x[hit])
            out_b.append(x[hit + shift])
    for at, n in zip(starts[sizes > SHORT_RUN].tolist(), sizes[sizes > SHORT_RUN].tolist(), strict=True):
        x = fps[at : at + n]
        a, b = run_stars(x, distances(x, to), radius)
        out_a.append(a)
        out_b.append(b)
    return np.concatenate(out_a), np.concatenate(out_b)


def links(nodes: DataFrame, radius: int = 3, spread: int = 32) -> DataFrame:
    """Edges (u > v) that connect what is linked, from a column fp of distinct fingerprints."""
    if not 0 <= radius <= len(GROUPS) - EQUAL:
        raise ValueError("radius must be 0 to 3: three of six pivot groups must stay equal")

    def spread_out(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column(0).to_numpy().view(np.uint64)
        keys = bucket_keys(fps)
        return pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(fps, keys.shape[1]).view(np.int64))], ["key", "fp"])

    def emit(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        a, b = a.view(np.int64), b.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["u", "v"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            cut = int(np.searchsorted(k, k[-1], "left"))  # the last run may go on in the next batch
            if cut or held_k and held_k[-1][-1] != k[0]:
                if not cut:
                    ready_k, ready_f, held_k, held_f = held_k, held_f, [k], [f]
                else:
                    ready_k, ready_f, held_k, held_f = [*held_k, k[:cut]], [*held_f, f[:cut]], [k[cut:]], [f[cut:]]
                if ready_k:
                    yield emit(*_links_in(np.concatenate(ready_k), np.concatenate(ready_f), radius, spread))
            else:
                held_k.append(k)
                held_f.append(f)
        if held_k:
            yield emit(*_links_in(np.concatenate(held_k), np.concatenate(held_f), radius, spread))

    keyed = map_arrow(nodes.select("fp"), per_batch(spread_out), "key long, fp long")
    dealt = keyed.repartition(F.col("key")).sortWithinPartitions("key", "fp")
    return map_arrow(dealt, compare, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of edges (u > v), root the least node reachable.

    Alternating large-star and small-star steps; each round is a table in the shared folder."""
    spark = edges.sparkSession
    current, state = materialize(edges, "links"), None
    while True:
        seen = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        small = small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u > v").distinct()
        following = materialize(small, "links")
        discard(current)
        current = following
    out = current.select("u", F.col("v").alias("root"))
    return spark.createDataFrame([], "u long, root long") if not state else out.unionByName(out.select(F.col("root").alias("u"), "root").distinct())


def roots(nodes: DataFrame, radius: int = 3, spread: int = 32) -> DataFrame:
    """(fp, root): what links connect has one root. nodes: distinct fingerprints fp."""
    found = components(links(nodes, radius, spread))
    return nodes.join(found, nodes.fp == found.u, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3, spread: int = 32) -> DataFrame:
    """One row per document: id_col, fingerprint (16 hex digits), component_id."""
    base = materialize(with_fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = materialize(base.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    joined = materialize(nodes.join(roots(nodes.select("fp"), radius, spread), "fp"), "classes")
    discard(nodes)
    classes = joined.join(joined.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return base.join(classes, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
