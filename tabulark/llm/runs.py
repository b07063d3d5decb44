"""Periodic runs of words: a suffix automaton whose suffix links are accessed as in a link-cut tree.

A run is a stretch of words with smallest period q (words q apart are identical) and length >= max(`least`, 2 q) that
no neighbouring word extends. For the words of a stretch:

* Automaton.append() adds a word: states are classes of factors that end at the same places, len the longest factor of
  each, link the class of its longest suffix that ends at more places. The links are a tree.
* The tree is cut into preferred paths, each with the end at which its factors were seen last. Appending word i accesses
  the state of the prefix that ends there: on the way to the root every preferred path that is met gives up its upper
  segment, whose deepest state has the length L of what is common to the ends `before` and i (no longer factor ends at
  both), and the whole path gets the colour i. Preferred paths are splay trees; the colour is kept at their roots.
  All accesses together recolour O(n log n) segments.
* If L >= d = i - before, the last 2 d words are a square, and words before - L + 1 to i have period d. That is
  the smallest one, or a nearer end would have been met. It begins where the run begins; on the right it is extended
  word by word. A run is extended once: later squares of the same period that end within it are parts of it.

Every run of smallest period q has such a segment at the end of its first square: its last q words were seen last q
words before. So no run is lost, and no candidate has to be thrown away but for being short.

Words that no run can hold aren't appended: a run has period 12 or more, and then repeats 12 words, or a smaller one,
and then repeats 6 words within 11. Stretches in which every word lies in such a repeat are found by
hashes of word windows (a collision only lengthens a stretch) and no run crosses their borders, as all its words lie in one.

Defined results: null, empty and blank texts have no words and no runs; each row gives one row, repeated or with a
null id; texts of any length are taken whole, a task holds one at a time, with about 1 KB for a word of a stretch;
of runs that tie for the longest the first in order of start and period counts; an empty table gives no rows; extra
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow, raw_texts

LEAST = 12
#: Two windows of words that runs repeat; the second within so many words.
WIDE, NARROW, WITHIN = 12, 6, 11
#: Rows and bytes of text in a batch of results.
ROWS, BYTES = 512, 1 << 22
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Automaton:
    """Suffix automaton of a sequence of numbers; state 0 is the root."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.len, self.link, self.last = [0], [-1], 0

    def append(self, c: int) -> int:
        """The state of the whole sequence, with c at its end."""
        nxt, length, link = self.next, self.len, self.link
        new, p = len(nxt), self.last
        nxt.append({})
        length.append(length[p] + 1)
        link.append(0)
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = clone
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
        self.last = new
        return new


class LastEnds:
    """Preferred paths over a tree of suffix links, each with the end at which its factors were seen last."""

    def __init__(self, link: list[int]) -> None:
        n = len(link)
        self.up, self.shallow, self.deep, self.colour = list(link), [-1] * n, [-1] * n, [-1] * n

    def splay(self, x: int) -> None:
        """Make x the root of its splay tree; the colour of the path moves to it."""
        up, shallow, deep = self.up, self.shallow, self.deep
        top = None
        while True:
            p = up[x]
            if p < 0 or (shallow[p] != x and deep[p] != x):
                break
            g = up[p]
            inner = g >= 0 and (shallow[g] == p or deep[g] == p)
            if inner:
                self._rotate(p if (shallow[g] == p) == (shallow[p] == x) else x)
            top = g if inner else p
            self._rotate(x)
        if top is not None:
            self.colour[x] = self.colour[top]

    def _rotate(self, x: int) -> None:
        up, shallow, deep = self.up, self.shallow, self.deep
        p = up[x]
        g = up[p]
        if shallow[p] == x:
            b = shallow[p] = deep[x]
            deep[x] = p
        else:
            b = deep[p] = shallow[x]
            shallow[x] = p
        if b >= 0:
            up[b] = p
        up[p], up[x] = x, g
        if g >= 0:
            if shallow[g] == p:
                shallow[g] = x
            elif deep[g] == p:
                deep[g] = x

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """Colour the path from the root to state with end. What it was coloured by parts, deepest first: (end of the
        part, its deepest state)."""
        up, deep, colour, parts = self.up, self.deep, self.colour, []
        below, x = -1, state
        while x >= 0:
            self.splay(x)
            before, rest = colour[x], deep[x]
            if before >= 0:
                parts.append((before, x))
            if rest >= 0:
                colour[rest] = before
            deep[x] = below
            below, x = x, up[x]
        colour[below] = end
        return parts


def runs_of_stretch(ids: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, in no order."""
    automaton = Automaton()
    states = [automaton.append(c) for c in ids]
    ends, length = LastEnds(automaton.link), automaton.len
    n, found, reached = len(ids), [], {}
    for i, state in enumerate(states):
        for before, deepest in ends.access(state, i):
            period, common = i - before, length[deepest]
            if common < period or reached.get(period, -1) >= i:
                continue
            start, stop = before - common + 1, i + 1
            while stop < n and ids[stop] == ids[stop - period]:
                stop += 1
            reached[period] = stop - 1
            if stop - start >= least:
                found.append((start, stop - start, period))
    return found


def stretches(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches [start, stop) outside which no word is in a run of `least` words or more."""
    n = len(ids)
    if n < least:
        return []
    inside = np.zeros(n + 1, np.int64)

    def mark(starts: np.ndarray, width: int) -> None:
        np.add.at(inside, starts, 1)
        np.add.at(inside, starts + width, -1)

    narrow, wide = min(NARROW, least // 2), min(WIDE, least)
    hashes, width = {}, 1
    h = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    one = h ^ (h >> np.uint64(29))
    hashes[1] = one
    for width in range(2, wide + 1):
        before = hashes[width - 1]
        h = before[: n - width + 1] * _MIX + one[width - 1 :]
        hashes[width] = h ^ (h >> np.uint64(32))
    h = hashes[wide]
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        mark(np.flatnonzero(np.isin(h, twice)), wide)
    h = hashes[narrow]
    for d in range(1, min(WITHIN, len(h) - 1) + 1):
        same = np.flatnonzero(h[d:] == h[:-d])
        if len(same):
            mark(same, narrow)
            mark(same + d, narrow)
    covered = np.r_[False, np.cumsum(inside)[:n] > 0, False]
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= least]


def runs_of(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text, by start, then period."""
    numbers: dict[bytes, int] = {}
    fresh = count().__next__
    ids = np.fromiter((numbers[w] if w in numbers else numbers.setdefault(w, fresh()) for w in words), np.int64, len(words))
    found = []
    if len(numbers) + min(NARROW, least // 2) <= len(words):  # a run repeats so many words
        for a, b in stretches(ids, least):
            found += [(a + s, length, q) for s, length, q in runs_of_stretch(ids[a:b].tolist(), least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stay if of each run only the first period does."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document: id_col, runs (array<struct<start,length,period>>, by start, then period) and collapsed (the
    words that stay, joined by one space)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def batch_of(ids: pa.Array, runs: list, texts: list[bytes]) -> pa.RecordBatch:
        listed = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
        return pa.RecordBatch.from_arrays([ids, pa.array(listed, kind), pa.array(texts, pa.binary()).cast(pa.string())], ["id", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, runs, texts = 0, 0, [], []
            for i in range(batch.num_rows):
                words = raw_texts(batch.column(1).slice(i, 1))[0].split()
                runs.append(runs_of(words, least))
                texts.append(b" ".join(collapsed(words, runs[-1])))
                held += len(texts[-1])
                if held >= BYTES or len(texts) == ROWS or i == batch.num_rows - 1:
                    yield batch_of(batch.column(0).slice(first, len(texts)), runs, texts)
                    first, held, runs, texts = i + 1, 0, [], []

    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = map_arrow(slim, run, f"id {docs.schema[id_col].dataType.simpleString()}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return out.withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of each document: how many runs, the longest one, and digests of all runs and of the words that stay."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    out = found.select(f"`{id_col}`", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return out.select(f"`{id_col}`", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"), F.floor(F.expr("1000 * best.length div -best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text): of one document in ten (by its id's checksum h) the words from a = g % n on become repeats of the
    p = 1 + (n - a) div (3 + g % 8) words that begin there; g is h div 10, n the number of words."""
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    checksum = F.crc32(ident.cast("string"))
    some = docs.select(ident.alias(id_col), text.alias("text"), F.when(checksum % 10 == 0, F.expr(f"crc32(CAST(`{id_col}` AS STRING)) div 10")).alias("g"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size("words"), F.col("g")

    def repeated() -> Column:
        a = F.expr("CAST(g % size(words) AS INT)")
        p = F.expr("CAST(1 + (size(words) - g % size(words)) div (3 + g % 8) AS INT)")
        unit = F.slice("words", a + 1, p)
        tail = F.slice(F.flatten(F.array_repeat(unit, F.expr("CAST((size(words) - g % size(words)) div (1 + (size(words) - g % size(words)) div (3 + g % 8)) + 1 AS INT)"))), 1, n - a)
        return F.array_join(F.concat(F.slice("words", 1, a), tail), " ")

    split = some.select(id_col, "text", "g", F.when(g.isNotNull(), words).alias("words"))
    return split.select(id_col, F.when(g.isNotNull() & (n > 0), repeated()).otherwise(F.col("text")).alias("text"))
