"""Document fingerprints by one-permutation MinHash.

The shingles of a text (five lower-cased words) are hashed once to 64 bits. The top bits name
one of k bins; a bin keeps its least remaining value. An empty bin copies the bin that a fixed
hash sequence (bin, attempt) reaches first among the filled (optimal densification), so the
chance that two texts agree in a bin stays their Jaccard similarity. Of each bin the low b bits
are kept and packed. Two fingerprints agree in a bin by chance with probability 2^-b; likeness
is corrected for it: (matches / k - 2^-b) / (1 - 2^-b), within 0 and 1.

To meet its neighbour in doc_id order, a document is sent to the range of ids it belongs to; the
least of each range also goes to the range before (the very least to the last), so each range has
all it needs. Texts cross the network once. Ranges hold about `range_bytes` of text, or more where there would be
more than RANGES of them; rows of a range stream by, sorted, two at a time.

Defined results: null texts count as empty; no words: the empty text's fingerprint (of the shingle
""); fewer than five words: one shingle; null ids come last; rows with equal ids, also null ones, share a range and
are ordered by text; repeated rows follow each other; a lone document is its own next; an empty table gives no
rows; texts of any length are read whole; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow, per_batch

SEED = 0x5EED
BINS, BITS, WIDTH = 256, 4, 5
RANGE_BYTES, RANGES, ROWS = 4 << 20, 20_000, 256


def shingle_hashes(raw: bytes, width: int = WIDTH) -> np.ndarray:
    words = raw.lower().split()
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))), np.uint64)


@cache
def probes(bins: int, turn: int, attempts: int = 64) -> np.ndarray:
    """Fixed bins to look at for each empty bin: row i, attempt by attempt; turn 0 first, then turn 1, .."""
    return np.random.default_rng([SEED, turn]).integers(0, bins, (bins, attempts))


def signature(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Least value of each bin, empty bins filled. bins is a power of two."""
    shift = np.uint64(64 - bins.bit_length() + 1)
    ordered = np.sort(hashes)
    where, first = np.unique(ordered >> shift, return_index=True)
    least, filled = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    least[where] = ordered[first] & ((np.uint64(1) << shift) - np.uint64(1))
    filled[where] = True
    empty, turn = np.flatnonzero(~filled), 0
    while len(empty):  # some bin is filled, so every path ends
        path = probes(bins, turn)[empty]
        hit = filled[path]
        done = hit.any(axis=1)
        least[empty[done]] = least[path[done, hit[done].argmax(axis=1)]]
        empty, turn = empty[~done], turn + 1
    return least


def packed(least: np.ndarray, bits: int = BITS) -> bytes:
    low = (least & np.uint64((1 << bits) - 1)).astype(np.uint8)
    return np.packbits(np.unpackbits(low[:, None], axis=1)[:, 8 - bits :]).tobytes()


def fingerprint(raw: bytes, bins: int = BINS, bits: int = BITS, width: int = WIDTH) -> bytes:
    return packed(signature(shingle_hashes(raw, width), bins), bits)


def likeness(a: bytes, b: bytes, bins: int = BINS, bits: int = BITS) -> float:
    """Estimate of the Jaccard similarity of the shingle sets, 0 to 1."""
    x = np.unpackbits(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8))[: bins * bits].reshape(bins, bits)
    chance = 2.0**-bits
    return float(min(1.0, max(0.0, ((~x.any(axis=1)).mean() - chance) / (1 - chance))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, bits: int = BITS, width: int = WIDTH) -> DataFrame:
    """(id_col, fingerprint binary), in place: no shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t or b"", bins, bits, width) for t in texts], pa.binary())], ["id", "fingerprint"])

    out = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(out, per_batch(run), f"id {docs.schema[id_col].dataType.simpleString()}, fingerprint binary").withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """text with its last half (floor) replaced by the first as many characters of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per document: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    last = (1 << 63) - 1
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = docs.select(F.coalesce(id_.cast("long"), F.lit(last)).alias("id"), id_.isNull().alias("no_id"), F.coalesce(text, F.lit("")).alias("text"))
    total, n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    ranges = min(RANGES, max(1, -(-total // range_bytes)))
    cuts = rows.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] if ranges > 1 and n else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.searchsorted(cuts, batch.column(0).to_numpy(), "right").astype(np.int32)), *batch.columns], ["part", *batch.schema.names])

    least = map_arrow(rows.select("id"), per_batch(place), "part int, id long").groupBy("part").agg(F.min("id").alias("id")).orderBy("part").collect()  # one row a range
    firsts = {r["id"]: least[i - 1]["part"] for i, r in enumerate(least)}  # the very least goes to the last range
    known = np.array(sorted(firsts), np.int64)
    nothing = np.zeros(0, np.int32)

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Each row to its range, and rows with a range's least id to the range before as well."""
        ids = batch.column(0).to_numpy()
        parts = np.searchsorted(cuts, ids, "right").astype(np.int32)
        again = np.flatnonzero(np.isin(ids, known)) if firsts else nothing
        guests = np.array([firsts[i] for i in ids[again].tolist()], np.int32)
        both = pa.RecordBatch.from_arrays([pa.array(parts), pa.array(np.zeros(len(ids), bool)), *batch.columns], ["part", "guest", *batch.schema.names])
        extra = batch.take(pa.array(again))
        extra = pa.RecordBatch.from_arrays([pa.array(guests), pa.array(np.ones(len(again), bool)), *extra.columns], both.schema.names)
        return pa.Table.from_batches([both, extra]).combine_chunks().to_batches()[0]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of range, guests last; each is finished when the next one is seen. Only
        the first guest in text order is a neighbour: others share its id and live elsewhere."""
        held, out = None, []

        def finish(row, following):
            (id_, no_id, text, own), (next_text, next_print) = row, following
            new = edited(text, next_text)
            fp = fingerprint(new.encode())
            out.append((None if no_id else id_, len(text), hashlib.sha256(new.encode()).hexdigest(), own.hex(), fp.hex(), likeness(own, fp), likeness(own, next_print)))

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                for part, guest, id_, no_id, text in zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns), strict=True):
                    if held and held[0] != part:
                        held = None  # what is left of that range has met its guest
                    own = fingerprint(text.encode())
                    if held:
                        finish(held[1:], (text, own))
                    held = None if guest else (part, id_, no_id, text, own)
                yield results(out)
                out.clear()

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def results(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    dealt = map_arrow(rows, per_batch(deal), "part int, guest boolean, id long, no_id boolean, text string")
    dealt = dealt.repartitionById(ranges, F.col("part")).sortWithinPartitions("part", "guest", "id", "no_id", "text")
    out = map_arrow(dealt, walk, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)
