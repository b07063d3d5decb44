"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding by offsets.

Pre-tokenisation needs no regex. Code points are looked up in a class table (letter, number,
space, ...); a little lookahead turns classes into symbols; each symbol is a transition function
of an eight-state machine. Functions compose associatively, so the state before every character
comes from a prefix scan over the machine's transition monoid: composition is a lookup in a
small table, and the scan is done in blocks (across columns, then over the block totals), all
in numpy. A character starts a token if the machine says so for its state and symbol. The slices
between starts are the matches of the public pattern.

Slices go through a cache bounded in bytes to their ids; a miss merges the pair of lowest rank first.
Slice offsets (code points, and places in the ids) are kept; decoding looks up what slices a stretch of the
text touches and joins the bytes of their ids, stretch by stretch.

Texts are worked on in windows of WINDOW code points, cut where a slice starts, so arrays stay small
however long a text is; only one slice (a word of that length) is ever held whole.

Defined results: null and empty texts have no tokens; texts of any length are scanned in windows
that carry the machine's state; ties in rank are merged left to right; each row of the input, repeated or
with a null id, is one row of the output, in place (no shuffle); an empty table gives no rows; extra columns
are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow

#: Classes of code points.
LETTER, NUMBER, OTHER, SPACE, WHITE, END = range(6)
#: Symbols: class with lookahead. TICK1 and TICK2 may begin a contraction of one or two letters;
#: JOIN is a space before a non-space, LAST other white space before one, GAP any before white
#: space or the end.
S_LETTER, S_NUMBER, S_OTHER, S_TICK1, S_TICK2, S_JOIN, S_GAP, S_LAST, S_END = range(9)
#: States: what the current token is.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOINED, IN_GAP, FRESH, NEED1, NEED2 = range(8)
#: Code points with the Unicode property White_Space.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Letters of the contractions in the public pattern.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")
SENTINEL = 0x110000
WINDOW = 1 << 17
#: Bytes that the cache of slices may hold, each entry counted with its overhead.
CACHED, ENTRY = 24 << 20, 200
#: Slices of more bytes are merged one at a time.
LONG = 128
#: Rows of a batch that are worked on at once.
ROWS = 256


def move(state: int, symbol: int) -> tuple[int, bool]:
    """The machine: next state, and whether the character starts a token."""
    if symbol == S_END:
        return FRESH, True
    if symbol == S_JOIN:
        return JOINED, True
    if symbol == S_LAST:
        return FRESH, True
    if symbol == S_GAP:
        return IN_GAP, state != IN_GAP
    if symbol == S_LETTER and state in (NEED1, NEED2):
        return (FRESH if state == NEED1 else NEED1), False
    if symbol in (S_TICK1, S_TICK2) and state not in (IN_OTHERS, JOINED):
        return (NEED1 if symbol == S_TICK1 else NEED2), True
    run = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS}.get(symbol, IN_OTHERS)
    return run, state not in (run, JOINED)


@cache
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Element of each symbol; composition table (row first, then column); state after an
    element from FRESH and from any state; starts[state, symbol]."""
    functions = [tuple(range(8)), *(tuple(move(q, s)[0] for q in range(8)) for s in range(9))]
    number = {}
    for f in functions:
        number.setdefault(f, len(number))
    generators = [number[f] for f in functions[1:]]
    elements = list(number)
    at = 0
    while at < len(elements):
        for g in {functions[i] for i in range(1, 10)}:
            h = tuple(g[q] for q in elements[at])
            if h not in number:
                number[h] = len(number)
                elements.append(h)
        at += 1
    table = np.array([[number[tuple(g[q] for q in f)] for g in elements] for f in elements], np.uint8)
    assert len(elements) <= 256
    return np.array(generators, np.uint8), table, np.array(elements, np.uint8), np.array([[move(q, s)[1] for s in range(9)] for q in range(8)])


def newer_points(lead: str, points: list[int]) -> list[int]:
    """Those points that the installed tokenizer library keeps in one match with lead. Its Unicode
    tables may be newer than Python's; a vocabulary in which lead merges with any byte shows it."""
    import public_tokenizers
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)} | {lead.encode() + bytes([b]): 256 + b for b in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [c for c in points if len(probe.encode_ordinary(lead + chr(c))) == len(chr(c).encode())]


@cache
def class_table() -> np.ndarray:
    """Class of every code point: Python's categories; for points that Python does not know
    (planes 0 to 3, where letters are still being added), the library's."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(SENTINEL)), np.uint8, SENTINEL)
    unknown = [c for c in range(0x40000) if unicodedata.category(chr(c)) == "Cn"]
    table[newer_points("a", unknown)] = LETTER
    table[newer_points("1", unknown)] = NUMBER
    table[list(WHITE_SPACE)] = WHITE
    table[0x20] = SPACE
    return np.append(table, np.uint8(END))


def scan(elements: np.ndarray, table: np.ndarray, width: int = 64) -> np.ndarray:
    """Inclusive prefix compositions of monoid elements (0 is the identity)."""
    n, flat, k = len(elements), table.ravel(), len(table)
    if n <= width:
        out = elements.copy()
        for i in range(1, n):
            out[i] = table[out[i - 1], out[i]]
        return out
    rows = -(-n // width)
    grid = np.zeros(rows * width, np.uint8)
    grid[:n] = elements
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    for j in range(1, width):
        grid[j] = flat[grid[j - 1].astype(np.intp) * k + grid[j]]
    before = np.zeros(rows, np.uint8)
    before[1:] = scan(grid[-1], table, width)[:-1]
    return flat[before.astype(np.intp)[None, :] * k + grid].T.ravel()[:n]


def symbols(points: np.ndarray) -> np.ndarray:
    """Symbols of code points; the last two are only looked at."""
    classes = class_table()[points]
    kind, following = classes[:-2], classes[1:-1]
    out = np.array([S_LETTER, S_NUMBER, S_OTHER, S_GAP, S_GAP, S_END], np.uint8)[kind]
    ends = following <= OTHER
    out[(kind == SPACE) & ends] = S_JOIN
    out[(kind == WHITE) & ends] = S_LAST
    ticks = np.flatnonzero(points[:-2] == 0x27)
    if len(ticks):
        a, b = points[ticks + 1], points[ticks + 2]
        out[ticks[np.isin(a, [ord(c) for c in ONE_LETTER])]] = S_TICK1
        for x, y in TWO_LETTERS:
            out[ticks[(a == ord(x)) & (b == ord(y))]] = S_TICK2
    return out


def token_starts(points: np.ndarray, state: int = FRESH) -> tuple[np.ndarray, int]:
    """Positions where tokens start (or a text ends), and the machine's state after them. points: texts, each
    followed by SENTINEL, and two points more that are only looked at."""
    generators, table, elements, starts = monoid()
    symbol = symbols(points)
    if not len(symbol):
        return np.zeros(0, np.int64), state
    prefix = scan(generators[symbol], table)
    before = np.empty(len(symbol), np.uint8)
    before[0] = state
    before[1:] = elements[prefix[:-1], state]
    return np.flatnonzero(starts[before, symbol]), int(elements[prefix[-1], state])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Pairs:
    """Rank of every pair of tokens whose join is a token, as sorted keys."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        keys = np.fromiter(found, np.int64, len(found))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.fromiter(found.values(), np.int64, len(found))[order]
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def score(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The joined token's rank (which is its id), or FAR."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], FAR)


FAR = np.int64(1 << 40)


def merge_many(pieces: list[bytes], pairs: Pairs) -> list[bytes]:
    """Ids of each slice (not empty) as bytes. In each round every unfinished slice joins its pair
    of lowest rank, the leftmost of equals."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    ids = pairs.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), sizes)
    score = np.full(len(ids), FAR)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    score[inner] = pairs.score(ids[inner], ids[inner + 1])
    done_ids, done_owner = [], []
    while len(ids):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        least = np.minimum.reduceat(score, starts)
        lengths = np.diff(np.r_[starts, len(ids)])
        if (over := least == FAR).any():
            finished = np.repeat(over, lengths)
            done_ids.append(ids[finished])
            done_owner.append(owner[finished])
            going = ~finished
            ids, owner, score, least, lengths = ids[going], owner[going], score[going], least[~over], lengths[~over]
            if not len(ids):
                break
        hits = np.flatnonzero(score == np.repeat(least, lengths))
        hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]
        ids[hits] = score[hits]
        keep = np.ones(len(ids), bool)
        keep[hits + 1] = False
        at = hits - np.arange(len(hits))  # where the joined tokens come to stand
        ids, owner, score = ids[keep], owner[keep], score[keep]
        score[at] = FAR
        redo = np.concatenate([at, at[at > 0] - 1])
        redo = redo[redo + 1 < len(ids)]
        redo = redo[owner[redo] == owner[redo + 1]]
        score[redo] = pairs.score(ids[redo], ids[redo + 1])
    ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    blob = ids[order].astype("<u4").tobytes()
    ends = (np.cumsum(np.bincount(owner, minlength=len(pieces))) * 4).tolist()
    return [blob[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> bytes:
    """The same for one long slice, in n log n: a heap of pairs over a linked list."""
    n = len(piece)
    end, before, after, alive = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        end[i], alive[j], after[i] = stop, False, after[j]
        if after[j] < n:
            before[after[j]] = i
        for left in (before[i], i):
            if left >= 0 and (right := after[left]) < n and (r := ranks.get(piece[left : end[right]])) is not None:
                heapq.heappush(heap, (r, left, end[right]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return np.array(out, "<u4").tobytes()


class Merged(dict):
    """Cache: slice -> its ids as little-endian unsigned 32-bit integers. Bounded in bytes: emptied when
    it would outgrow them."""

    def __init__(self, ranks: dict[bytes, int], size: int = CACHED):
        self.ranks, self.pairs, self.size, self.held = ranks, Pairs(ranks), size, 0

    def of(self, slices: list[bytes]) -> list[bytes]:
        """slices are distinct."""
        out = list(map(self.get, slices))
        missing = [i for i, ids in enumerate(out) if ids is None]
        short = [i for i in missing if len(slices[i]) <= LONG]
        if short:
            found = merge_many([slices[i] for i in short], self.pairs)
            more = sum(len(slices[i]) + len(ids) + ENTRY for i, ids in zip(short, found, strict=True))
            if self.held + more > self.size:
                self.clear()
                self.held = 0
            keep = more <= self.size
            self.held += more * keep
            for i, ids in zip(short, found, strict=True):
                out[i] = ids
                if keep:
                    self[slices[i]] = ids
        for i in missing:
            if out[i] is None:
                out[i] = merge_long(slices[i], self.ranks)
        return out


def gather(offsets: np.ndarray, which: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows `which` of a ragged array (row i is values[offsets[i]:offsets[i+1]]), end to end;
    and where each begins, the end last."""
    sizes = (offsets[1:] - offsets[:-1])[which]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return values[np.repeat(offsets[which] - ends[:-1], sizes) + np.arange(ends[-1])], ends


#: Odd base and byte values of the hash that finds equal slices (equality is then checked).
BASE = 0x9E3779B97F4A7C15
BYTE_VALUES = np.random.default_rng(BASE).integers(1, 1 << 63, 256, np.uint64)


def distinct_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For slices of data: one index for each distinct content, and each slice's place in it."""
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(data), BASE, np.uint64)]))
    inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(data), pow(BASE, -1, 1 << 64), np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * powers[:-1])])
    _, first, place = np.unique((sums[ends] - sums[starts]) * inverse[starts], return_index=True, return_inverse=True)
    sizes = ends - starts
    other = sizes != sizes[first[place]]
    fit = np.flatnonzero(~other)
    owner = np.repeat(fit, sizes[fit])
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes[fit]) - sizes[fit], sizes[fit])
    other[owner[data[starts[owner] + inside] != data[starts[first[place]][owner] + inside]]] = True
    if other.any():  # two contents, one hash
        odd = np.flatnonzero(other)
        place[odd] = len(first) + np.arange(len(odd))
        first = np.concatenate([first, odd])
    return first, place


class ByteBpe:
    """Encoder and decoder over a file of ranks."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.merged = Merged(self.ranks)
        tokens = {i: b for b, i in self.ranks.items()}
        listed = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.token_bytes = np.frombuffer(b"".join(listed), np.uint8)
        self.token_offsets = np.concatenate([[0], np.cumsum([len(b) for b in listed])])

    def encode_batch(self, texts: list[str], window: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text: offsets of its slices in code points (the end last), its ids, and where each slice's
        ids begin (the end last)."""
        group, size = [], 0
        for text in texts:
            if len(text) >= window:
                yield from self._encode(group)
                yield self._encode_long(text, window)
                group, size = [], 0
                continue
            if size + len(text) >= window:
                yield from self._encode(group)
                group, size = [], 0
            group.append(text)
            size += len(text) + 1
        yield from self._encode(group)

    def _encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Texts of a window together."""
        if not texts:
            return
        joined = "\n".join(texts) + "\n"
        points = np.append(code_points(joined), [SENTINEL, SENTINEL]).astype(np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        points[ends] = SENTINEL
        starts = token_starts(points)[0]
        bounds = np.split(starts, np.searchsorted(starts, ends) + 1)[:-1]
        ids, at = self._merge(points[:-2], joined.encode(), np.concatenate([b[:-1] for b in bounds]), np.concatenate([b[1:] for b in bounds]))
        done = 0
        for own in bounds:
            n = len(own) - 1
            yield own - own[0], ids[at[done] : at[done + n]], at[done : done + n + 1] - at[done]
            done += n

    def _encode_long(self, text: str, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One text, a window at a time; the slice that a window cuts is finished with the next."""
        state, open_, offsets, ids, places, total = FRESH, 0, [], [], [], 0
        for at in range(0, len(text), window):
            part = text[at : at + window + 2]
            last = at + window >= len(text)
            points = np.append(code_points(part), [SENTINEL] * (max(0, min(window, len(text) - at) + 2 - len(part)))).astype(np.uint32)
            found, state = token_starts(points, state)
            found = found + at
            bounds = np.concatenate([[open_], found[found > open_], [len(text)] if last else []]).astype(np.int64)
            if len(bounds) < 2:
                continue
            own = text[open_ : bounds[-1]]
            new, begins = self._merge(code_points(own), own.encode(), bounds[:-1] - open_, bounds[1:] - open_)
            offsets.append(bounds[:-1])
            ids.append(new)
            places.append(begins[:-1] + total)
            total += len(new)
            open_ = int(bounds[-1])
        return np.concatenate([*offsets, [len(text)]]), np.concatenate(ids), np.concatenate([*places, [total]])

    def _merge(self, points: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices from starts to ends (code points of data), and where each slice's begin, the end last."""
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        widths = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + ((points >= 0x10000) & (points < SENTINEL))
        widths[points == SENTINEL] = 1
        byte_at = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
        starts, ends = byte_at[starts], byte_at[ends]
        first, place = distinct_slices(np.frombuffer(data, np.uint8), starts, ends)
        blobs = self.merged.of([data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
        offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])])
        return gather(offsets, place, np.frombuffer(b"".join(blobs), "<u4"))

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.token_offsets, ids, self.token_bytes)[0].tobytes()

    def decode_stretch(self, ids: np.ndarray, offsets: np.ndarray, places: np.ndarray, start: int, end: int) -> tuple[int, bytes]:
        """The slices that code points start to end touch: where they begin, and their bytes. Slices are whole
        characters, so this is valid UTF-8 of the text."""
        a = max(0, int(np.searchsorted(offsets, start, "right")) - 1)
        b = max(a, int(np.searchsorted(offsets[:-1], end, "left")))
        return int(offsets[a]), self.decode(ids[places[a] : places[b]])

    def decoded(self, ids: np.ndarray, offsets: np.ndarray, places: np.ndarray, window: int = WINDOW) -> Iterator[bytes]:
        """All of the text, about a window at a time."""
        at, n = 0, int(offsets[-1])
        while at < n:
            begin = int(np.searchsorted(offsets, at, "left"))
            stop = max(begin + 1, int(np.searchsorted(offsets, at + window, "right")) - 1)
            yield self.decode(ids[places[begin] : places[stop]])
            at = int(offsets[stop])


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    return ByteBpe(path)


def vocabulary_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256, n_slices; with ids=True
    also ids array<int>, offsets array<long> (starts of the slices in code points) and places array<long>
    (where each slice's ids start)."""
    types = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "n_slices": pa.int64()}
    if ids:
        types |= {"ids": pa.list_(pa.int32()), "offsets": pa.list_(pa.int64()), "places": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = []
                for offsets, own, places in bpe.encode_batch([t or "" for t in part.column(1).to_pylist()]):
                    digest = hashlib.sha256()
                    for raw in bpe.decoded(own, offsets, places):
                        digest.update(raw)
                    rows.append([len(own), hashlib.sha256(own.tobytes()).hexdigest(), digest.hexdigest(), len(offsets) - 1, own.astype(np.int32), offsets[:-1], places[:-1]][: len(types)])
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["id", *types])

    extra = ", ids array<int>, offsets array<long>, places array<long>" if ids else ""
    out = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(out, run, f"id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_slices long{extra}").withColumnRenamed("id", id_col)
