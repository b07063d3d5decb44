"""Near-dedup of a corpus: SimHash classes, completed by sets of five-word shingles.

First, one row stays of what SimHash over five-word shingles links (three bits or fewer). But at a Jaccard
similarity of 0.8, the least that a near copy has, 64-bit fingerprints differ in some 10 bits and up to 20, too
many for keys that lose no pair. So what is left meets again as sets of its shingles, by candidates from MinHash:

* 24 bands of 4 values each. A pair at 0.8 agrees in no band with probability (1 - 0.8^4)^24 = 3e-6,
  less above. Equal sets cost one row.
* 64 values, a byte of each, discard candidates of which fewer than 35 agree (at 0.8: 1e-6 or less).
* candidates are compared as shingle sets, exactly.

Buckets aren't held or expanded into pairs. In each round the first `hubs` rows of a bucket (in order of set
digest) are compared with all that follow, which stream by; a row that proves alike to a hub goes. The first round
(one hub) removes near copies of one text in a star, however many they are; the second (four hubs) finishes buckets
of six. A bucket that has more left may be of texts that are alike below 0.8, whose pairs would be compared for
nothing, so all that is left in such buckets is dealt anew, by its rarest shingles: with the shingles of each set in
one order (that of how many of these sets have them), a pair that is alike shares one among the first fifth of both,
at places i and j that leave enough for what they must have in common, 1 + min(m - i - 1, n - j - 1) >= 4/9 (m + n).
So the shorter has it in its first ninth; only such rows are hubs of these buckets. What texts have in common with
hundreds of others comes last in the order, so texts with a common part and each with a fifth of its own don't meet.
Rounds go on, with four times as many hubs each, until every pair that shares a bucket, and stays, has been compared.
Candidates meet their hubs in blocks (a bucket's hubs, BLOCK at a time), a text once a block and in parts of PART
texts, so the texts that travel are fewer than the pairs by the size of a block, and a hub of a third of all rows is
compared in many tasks.

Defined results: null and blank texts are one set, the empty; fewer than five words are one shingle; of equal
sets, and of a SimHash class, the row of the least id stays, nulls last, then by a hash of the row; equal rows
are one; of two sets that are alike the one of the lesser digest stays, unless it goes for one that is less
still; an empty table gives no rows; texts are read whole; extra columns stay, whatever their names.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from ._shared import bounded, discard, fresh, map_arrow, materialize, raw_texts

SEED, WIDTH = 42, 5
BANDS, DEEP, SKETCH, ALIKE = 24, 4, 64, 35
TILE, ROWS = 1 << 12, 256
#: Hubs of a block, members of a part of it, bytes of hubs' sets in memory.
BLOCK, PART, HELD = 64, 256, 1 << 26
#: Hubs of a bucket in the last round of MinHash bands.
LAST = 4
_draw = np.random.default_rng(SEED)
MASKS, FACTORS = (_draw.integers(0, 1 << 64, BANDS * DEEP, np.uint64) for _ in range(2))
FACTORS |= np.uint64(1)
MIX = _draw.integers(0, 1 << 64, (BANDS, DEEP), np.uint64) | np.uint64(1)


def shingle_hashes(raw: bytes, width: int = WIDTH) -> np.ndarray:
    """Hashes of all shingles in order, repeats included."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) > width else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in shingles), np.uint64)


def shingle_set(raw: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes."""
    return np.unique(shingle_hashes(raw, width))


def least_values(hashes: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * DEEP, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), TILE):
        least = np.minimum(least, ((hashes[at : at + TILE] ^ MASKS[:, None]) * FACTORS[:, None]).min(axis=1))
    return least


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Similarity of at least 0.8; the empty set is like none but itself."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * common >= 4 * (len(a) + len(b) - common)


def sketched(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, place, text, digest, fp, keys, sketch): place hashes the row, digest the set; fp is the SimHash."""
    names = ["id", "place", "text", "digest", "fp", "keys", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sets, fps = [], []
                for raw in raw_texts(part.column(2)):
                    hashes = shingle_hashes(raw)
                    fps.append(simhash.majority(hashes))
                    sets.append(np.unique(hashes))
                least = np.array([least_values(s) for s in sets])
                keys = (least.reshape(-1, BANDS, DEEP) * MIX).sum(axis=2, dtype=np.uint64).view(np.int64)
                sketch = ((least[:, :SKETCH] * MIX[0, 0]) >> np.uint64(56)).astype(np.uint8)
                digest = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(digest), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(list(keys), pa.list_(pa.int64())), pa.array([s.tobytes() for s in sketch], pa.binary())], names)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), place_of(docs).alias("place"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(rows, run, "id long, place long, text string, digest long, fp long, keys array<long>, sketch binary")


def place_of(docs: DataFrame):
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def compare_hubs(hubs: int):
    """For rows (key, digest, sketch) sorted by key and digest: candidates (key, digest, hub) of the first `hubs` rows of
    each key, and (key, digest, sketch) of all rows after those. Holds the hubs of one key only."""
    names = ["key", "digest", "hub", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held_d, held_s = None, np.zeros(0, np.int64), np.zeros((0, SKETCH), np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, digests = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sketches = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, SKETCH)
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            edges, left = [], []
            alone = np.diff(np.r_[starts, len(keys)]) == 1
            alone[0] &= keys[0] != current
            for a, b in zip(starts[~alone].tolist(), np.r_[starts, len(keys)][1:][~alone].tolist(), strict=True):
                if keys[a] != current:
                    current, held_d, held_s = keys[a], np.zeros(0, np.int64), np.zeros((0, SKETCH), np.uint8)
                more = min(b - a, hubs - len(held_d))
                held_d, held_s = np.r_[held_d, digests[a : a + more]], np.r_[held_s, sketches[a : a + more]]
                for h in range(len(held_d)):  # rows are sorted: the hub of a pair is the lesser
                    after = a + int(np.searchsorted(digests[a:b], held_d[h], "right"))
                    hit = after + np.flatnonzero((sketches[after:b] == held_s[h]).sum(axis=1) >= ALIKE)
                    edges.append(np.stack([digests[hit], np.full(len(hit), held_d[h]), np.full(len(hit), current)]))
                left.append(np.arange(a + more, b))
            if alone[-1]:
                current, held_d, held_s = keys[-1], digests[-1:].copy(), sketches[-1:].copy()
            *pair, of = np.concatenate(edges, axis=1) if edges else np.zeros((3, 0), np.int64)
            rest = np.concatenate(left) if left else np.zeros(0, np.int64)
            n, m = len(of), len(rest)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[of, keys[rest]]), pa.array(np.r_[pair[0], digests[rest]]), pa.array(np.r_[pair[1], np.zeros(m, np.int64)], mask=np.r_[np.zeros(n, bool), np.ones(m, bool)]), pa.array([None] * n + [s.tobytes() for s in sketches[rest]], pa.binary())], names)

    return run


def rarest(left: DataFrame, base: DataFrame) -> DataFrame:
    """(key, late, digest, sketch, size, at): the shingles of the first fifth of each set, in order of how many sets of `left`
    (digest, sketch) have them; those of one set only come first and make no rows. late: beyond the first ninth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sets = [shingle_set(raw).view(np.int64) for raw in raw_texts(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["digest", "size", "shingles"])

    texts = base.select("digest", "text").join(bounded(left), "digest", "left_semi").dropDuplicates(["digest"])
    sets = materialize(map_arrow(texts, run, "digest long, size long, shingles array<long>"), "shingles")
    rows = sets.select("digest", "size", F.explode("shingles").alias("key"))
    shared = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    held = rows.join(bounded(shared), "key").groupBy("digest").agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("n", "key"))).alias("held"))
    held = held.withColumn("own", F.col("size") - F.size("held"))
    first = held.withColumn("held", F.slice("held", 1, F.greatest(F.lit(0), F.expr("size div 5 + 1 - own")).cast("int")))
    placed = first.select("digest", "size", "own", F.posexplode("held").alias("at", "one")).select("digest", "size", (F.col("own") + F.col("at")).alias("at"), F.col("one.key").alias("key"))
    out = placed.join(bounded(left), "digest").select("key", F.expr("at > size div 9").alias("late"), "digest", "sketch", "size", "at")
    out = materialize(out, "rarest")
    for t in (sets, shared):
        discard(t)
    return out


def compare_rarest(hubs: int):
    """For rows of rarest() sorted by key, late and digest: candidates (key, digest, hub) of the first `hubs` rows of each key that
    aren't late, and the rows after those, as long as one that isn't late is among them. Holds the hubs of one key only."""
    names = ["key", "late", "digest", "hub", "sketch", "size", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, more = None, [], False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, late, digests = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            sizes, places = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            sketches = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, SKETCH)
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            ends = np.r_[starts[1:], len(keys)]
            last = len(starts) - 1
            edges, left = [], []
            for k in np.flatnonzero((ends - starts > 1) & ~late[starts] | np.isin(np.arange(last + 1), [0, last])).tolist():
                a, b = int(starts[k]), int(ends[k])
                if keys[a] != current:
                    current, held, more = keys[a], [], False
                early = a + int(np.count_nonzero(~late[a:b]))
                new = min(early - a, hubs - len(held))
                more |= early - a > new
                held += [(i, digests[i], sketches[i].copy(), sizes[i], places[i]) for i in range(a, a + new)]
                for i, digest, sketch, size, place in held:
                    after = max(a, i + 1)
                    rest = np.minimum(size - place, sizes[after:b] - places[after:b])  # what can be common, with this shingle
                    near = after + np.flatnonzero(9 * rest >= 4 * (size + sizes[after:b]))
                    hit = near[(sketches[near] == sketch).sum(axis=1) >= ALIKE]
                    edges.append(np.stack([np.full(len(hit), current), digests[hit], np.full(len(hit), digest)]))
                left.append(np.arange(a + new, b if more else a + new))
            held = [(-1, *h[1:]) for h in held]
            key, member, hub = np.concatenate(edges, axis=1) if edges else np.zeros((3, 0), np.int64)
            rest = np.concatenate(left) if left else np.zeros(0, np.int64)
            n, m = len(key), len(rest)
            none, there = np.r_[np.ones(n, bool), np.zeros(m, bool)], np.r_[np.zeros(n, bool), np.ones(m, bool)]
            blank = np.zeros(n, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[key, keys[rest]]), pa.array(np.r_[blank.astype(bool), late[rest]], mask=none), pa.array(np.r_[member, digests[rest]]), pa.array(np.r_[hub, np.zeros(m, np.int64)], mask=there), pa.array([None] * n + [s.tobytes() for s in sketches[rest]], pa.binary()), pa.array(np.r_[blank, sizes[rest]], mask=none), pa.array(np.r_[blank, places[rest]], mask=none)], names)

    return run


class Held:
    """Sets of hubs, in memory up to so many bytes, and in a file beyond."""

    def __init__(self, most: int):
        self.most, self.sets, self.bytes = most, {}, 0

    def add(self, hub: int, hashes: np.ndarray) -> None:
        self.bytes += hashes.nbytes
        if self.bytes > self.most and len(hashes):
            with tempfile.TemporaryFile() as out:
                out.write(hashes.tobytes())
                out.flush()
                hashes = np.memmap(out, np.uint64, "r")
        self.sets[hub] = hashes


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of members and hubs that prove alike the greater digest, from (key, block, part, member, hubs, text) sorted so, a row for
    each hub (member null) first. A member's set is made once for all hubs of a block."""
    held, at = Held(HELD), None
    for batch in batches:
        found = []
        for *group, member, hubs, raw in zip(*(batch.column(i).to_pylist() for i in range(5)), raw_texts(batch.column(5)), strict=True):
            if group != at:
                held, at = Held(HELD), group
            hashes = shingle_set(raw)
            if member is None:
                held.add(hubs[0], hashes)
            else:
                goes = False
                for hub in sorted(hubs):
                    s = held.sets[hub]
                    if (hub > member or not goes) and 5 * min(len(s), len(hashes)) >= 4 * max(len(s), len(hashes)) and alike(s, hashes):
                        found.append(max(hub, member))
                        goes |= hub < member
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["digest"])


def proven(edges: DataFrame, texts: DataFrame, hubs: int) -> DataFrame:
    """(digest) of what goes by those edges (digest, hub, key) whose sets are alike. texts: (digest, text), one row a digest; hubs: how many a
    key has at most. A text goes once to each block of hubs that it has edges to, not once an edge."""
    blocks = edges.withColumn("block", F.pmod(F.xxhash64("hub"), F.lit(-(-hubs // BLOCK))).cast("int"))
    pairs = blocks.groupBy("key", "block", "digest").agg(F.collect_list("hub").alias("hubs"))
    pairs = materialize(pairs, "pairs")
    large = pairs.groupBy("key", "block").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts")).where("parts > 1")
    pairs_ = pairs.join(large, ["key", "block"], "left").withColumn("part", F.pmod(F.xxhash64("digest"), F.coalesce("parts", F.lit(1))).cast("int"))
    members = pairs_.join(texts, "digest").select("key", "block", "part", F.col("digest").alias("member"), "hubs", "text")
    owned = blocks.select("key", "block", "hub").distinct().join(large, ["key", "block"], "left").select("key", "block", "hub", F.explode(F.sequence(F.lit(0), (F.coalesce("parts", F.lit(1)) - 1).cast("int"))).alias("part"))
    owners = owned.join(texts.withColumnRenamed("digest", "hub"), "hub").select("key", "block", "part", F.lit(None).cast("long").alias("member"), F.array("hub").alias("hubs"), "text")
    both = owners.unionByName(members).repartition("key", "block", "part").sortWithinPartitions("key", "block", "part", F.col("member").asc_nulls_first())
    out = materialize(map_arrow(both, _check, "digest long").distinct(), "near")
    discard(pairs)
    return out


def near_copies(nodes: DataFrame, base: DataFrame) -> DataFrame:
    """(digest) of the sets that go. nodes: (digest, keys, sketch), one row a digest; base: (digest, text)."""
    spark = base.sparkSession
    rest = nodes.select(F.explode("keys").alias("key"), "digest", "sketch")
    gone, tables, hubs, by, compare = spark.createDataFrame([], "digest long"), [], 1, ["key", "digest"], compare_hubs
    while True:
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest.schema).replace("digest bigint", "digest bigint, hub bigint")
        dealt = rest.repartition(F.col("key")).sortWithinPartitions(*by)
        found = materialize(map_arrow(dealt, compare(hubs), kinds), "candidates")
        edges = materialize(found.where("hub IS NOT NULL").groupBy("digest", "hub").agg(F.min("key").alias("key")), "edges")
        named = materialize(edges.select("digest").union(edges.select("hub")).distinct(), "named")
        texts = materialize(base.select("digest", "text").join(bounded(named), "digest", "left_semi").dropDuplicates(["digest"]), "texts")
        lost = proven(edges, texts, hubs)
        tables += [found, edges, named, texts, lost]
        gone = gone.union(lost)
        rest = found.where("hub IS NULL").drop("hub").join(bounded(lost), "digest", "left_anti").select(*rest.columns)  # the join puts digest first
        late = F.col("late") if compare is compare_rarest else F.lit(False)
        crowded = rest.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.every(late).alias("late")).where("n > 1 AND NOT late")
        if compare is compare_hubs and hubs == LAST:
            left = materialize(rest.join(crowded.select("key"), "key", "left_semi").select("digest", "sketch").distinct(), "left")
            rest = rarest(left, base)
            tables += [left, rest]
            by, compare = ["key", "late", "digest"], compare_rarest
            crowded = rest.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.every("late").alias("late")).where("n > 1 AND NOT late")
        hubs = 4 * hubs
        if not crowded.limit(1).count():
            break
    out = materialize(gone.distinct(), "gone")
    for t in tables:
        discard(t)
    return out


def drop(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """docs without near copies."""
    base = materialize(sketched(docs, id_col, text_col), "sketches")
    row = F.struct(F.col("id").isNull().alias("none"), "id", "place")
    roots = materialize(simhash.roots(base.select("fp").distinct(), radius), "roots")
    sets = base.groupBy("digest", "fp").agg(F.min(row).alias("row"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    classes = sets.join(roots, "fp").groupBy("root").agg(F.min(F.struct("row", "digest", "keys", "sketch")).alias("least"))
    nodes = materialize(classes.groupBy(F.col("least.digest").alias("digest")).agg(F.min("least.row").alias("row"), F.first("least.keys").alias("keys"), F.first("least.sketch").alias("sketch")), "sets")
    gone = near_copies(nodes, base)
    kept = nodes.select("digest", "row").join(bounded(gone), "digest", "left_anti").select(F.col("row.id").alias("_id"), F.col("row.place").alias("_place"))
    rows = base.groupBy("id", "place").count()
    rows = materialize(rows.join(kept.withColumn("_stays", F.lit(True)), F.col("id").eqNullSafe(F.col("_id")) & (F.col("place") == F.col("_place")), "left").select("id", "place", "count", F.col("_stays").isNotNull().alias("stays")), "rows")
    lost = materialize(rows.where("NOT stays").select(F.col("id").alias("_id"), F.col("place").alias("_place")), "lost")
    again = rows.where("stays AND count > 1").limit(1).count()
    at = fresh(docs.columns, "_at")
    out = docs.withColumn(at, place_of(docs))
    out = out.join(bounded(lost), F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("_id")) & (F.col(at) == F.col("_place")), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    for t in (base, roots, nodes, gone, rows):
        discard(t)
    return out.dropDuplicates() if again else out
