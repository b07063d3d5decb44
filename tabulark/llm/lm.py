"""Language-model scoring by Brown's class-based bigrams.

p(w | v) = p(class(w) | class(v)) * p(w | class(w)), mixed with an add-one unigram. Classes come from exchange
clustering, in two steps:

* the CORE most frequent words move, one at a time, to the class that raises the likelihood of the class bigrams
  most (in the driver: a table of CORE^2 numbers, whatever the corpus);
* every other word that is LEAST training tokens or more, at every size, then makes the same move, against the table
  of the first step: the classes of its neighbours are counted over the whole corpus, and all such words move at once.
  They are never gathered in one place: a block sends a row to each bucket of words, with its counts in columns.

Rarer words, whose neighbours say little, belong to classes by shape (ending, script, length), and unseen ones share
the mass that absolute discounting leaves in theirs (as many unseen types as seen ones are assumed in a shape). All
counts (words, neighbours, class pairs) are of the whole training corpus.

How it runs. Texts are dealt to blocks of about `block_bytes` by a hash and turned into numbers of a dictionary of
the block's own words: texts are read into words once. Blocks are rows of a table. Their dictionaries meet once by
word, which sums the counts up; what is known of a block's words (counts, classes) then meets it by block. No table
that grows with the corpus is broadcast or collected.

Defined results: null, empty and blank texts have one token, the end; texts of any length are read whole, a piece at
a time; ids may repeat or be null (each row is scored, null ids are held out); an empty training set leaves every
token unseen (N = V = 0); an empty table gives no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import collect_garbage, discard, map_arrow, materialize, part_of, ship

CORE, LEAST, CLASSES, ROUNDS = 1000, 40, 64, 6
DISCOUNT, BACKOFF, MIX = 0.75, 20.0, 0.8
BLOCK_BYTES, PARTITIONS, PIECE, ROWS, CHOSEN, BUCKET = 16 << 20, 20_000, 1 << 20, 100_000, 1 << 15, 20_000
#: Stands for the end of a text; no word can be this.
END = b"\n"
ENDINGS = {ord("."): 1, ord(","): 2}
SHAPES = 32


def shape(word: bytes) -> int:
    """Class of a rare word, 0 to SHAPES - 1."""
    last = word[-1]
    ending = ENDINGS.get(last, 0 if last >= 0x80 or chr(last).isalnum() else 3)
    return ending * 8 + (not word.isascii()) * 4 + (len(word) > 8) * 2 + (not word.strip(b".,").isalpha() and word.isascii())


def tokens(raw: bytes | None) -> list[bytes]:
    return [*(raw or b"").lower().split(), END]


def pieces(raw: bytes) -> Iterator[bytes]:
    """raw in pieces that no word crosses."""
    at = 0
    while len(raw) - at > PIECE:
        cut = max(raw.rfind(c, at, at + PIECE) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut < at:  # one word longer than a piece
            ends = [i for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (i := raw.find(c, at + PIECE)) >= 0]
            if not ends:
                break
            cut = min(ends)
        yield raw[at : cut + 1]
        at = cut + 1
    yield raw[at:]


def packed(values: np.ndarray | bytes) -> bytes:
    """Numbers, byte by byte of each (high bytes are alike), or bytes, compressed: blocks cross the network more than once."""
    if isinstance(values, np.ndarray):
        values = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(values)


def unpacked(raw: bytes, kind: type | None = None) -> np.ndarray | bytes:
    plain = zstandard.ZstdDecompressor().decompress(raw) if raw else b""
    if kind is None:
        return plain
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(size, -1).T).view(kind).ravel()


def h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def gains(table: np.ndarray, out: np.ndarray, into: np.ndarray, self_: float, classes: int) -> np.ndarray:
    """By how much the log likelihood of the class bigrams grows if a word joins each of the first `classes`. table:
    class bigrams without the word; out, into: its counts with the others of the class that follows, precedes; self_: with itself."""
    ahead, behind = np.flatnonzero(out), np.flatnonzero(into)  # a rare word has few neighbours, and nothing else changes
    rows, columns = table[:classes, ahead], table[behind, :classes].T
    # what changes if w joins c: row c, column c, their crossing and the two margins
    gain = (h(rows + out[ahead]) - h(rows)).sum(axis=1) + (h(columns + into[behind]) - h(columns)).sum(axis=1)
    at = np.arange(classes)
    cross = table[at, at]
    gain -= h(cross + out[:classes]) + h(cross + into[:classes]) - 2 * h(cross)
    gain += h(cross + out[:classes] + into[:classes] + self_) - h(cross)
    rows, columns = table.sum(axis=1)[:classes] + into[:classes], table.sum(axis=0)[:classes] + out[:classes]  # w's neighbours stay where they are
    return gain - (h(rows + out.sum() + self_) - h(rows) + h(columns + into.sum() + self_) - h(columns))


def without(table: np.ndarray, a: int, out: np.ndarray, into: np.ndarray, self_: float) -> np.ndarray:
    """table less a word of class a."""
    table = table.copy()
    table[a] -= out
    table[:, a] -= into
    table[a, a] -= self_
    return table


def exchange(pairs: np.ndarray, start: np.ndarray, movable: int, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Exchange clustering. pairs[v, w]: bigram counts; symbols below `movable` move among classes
    0 to classes - 1, the others stay where start has them. Deterministic; stops when nothing moves."""
    own, k = start.copy(), int(start.max()) + 1
    member = np.zeros((len(own), k))
    member[np.arange(len(own)), own] = 1
    ahead, behind = pairs @ member, pairs.T @ member  # counts with the class that follows, precedes
    table, loop = member.T @ ahead, np.diag(pairs)
    order = np.argsort(-(pairs.sum(axis=0) + pairs.sum(axis=1))[:movable], kind="stable")
    for _ in range(rounds):
        moved = 0
        for w in order.tolist():
            a, out, into, self_ = own[w], ahead[w].copy(), behind[w].copy(), loop[w]
            out[a] -= self_
            into[a] -= self_  # with the others of each class
            table = without(table, a, out, into, self_)
            gain = gains(table, out, into, self_, classes)
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += out
            table[:, b] += into
            table[b, b] += self_
            if b != a:
                ahead[:, a] -= pairs[:, w]
                ahead[:, b] += pairs[:, w]
                behind[:, a] -= pairs[w]
                behind[:, b] += pairs[w]
                own[w] = b
                moved += 1
        if not moved:
            break
    return own


@dataclass
class Core:
    """Classes of the most frequent words (END first) and of the shapes, and the bigrams of all classes."""

    symbols: dict[bytes, int]
    table: np.ndarray
    classes: int

    def class_of(self, word: bytes) -> int:
        """Class of a word that has made no move: its own if it is of the core, else its shape's."""
        found = self.symbols.get(word)
        return self.classes + 1 + shape(word) if found is None else found

    @property
    def k(self) -> int:
        return self.classes + 1 + SHAPES

    def kinds(self, words: list[bytes], shapes: np.ndarray) -> np.ndarray:
        """class_of() each of a block's words, whose shapes are known."""
        out, place = shapes.astype(np.int64) + self.classes + 1, dict(zip(words, range(len(words)), strict=True))
        for w, c in self.symbols.items():
            if (i := place.get(w)) is not None:
                out[i] = c
        return out


def cluster(frequent: list[bytes], matrix: np.ndarray, classes: int = CLASSES) -> Core:
    """frequent: words, END first; matrix[v, w]: how often symbol w follows v, shapes numbered after the words."""
    f = len(frequent)
    # words move; END and the shapes have classes of their own
    own = np.concatenate([[classes], np.arange(f - 1) % classes, classes + 1 + np.arange(SHAPES)])
    turn = np.concatenate([np.arange(1, f), [0], np.arange(f, f + SHAPES)])
    own[turn] = exchange(matrix[np.ix_(turn, turn)], own[turn], f - 1, classes)
    member = np.zeros((len(own), classes + 1 + SHAPES))
    member[np.arange(len(own)), own] = 1
    return Core({w: int(own[i]) for i, w in enumerate(frequent)}, member.T @ matrix @ member, classes)


def move(core: Core, word: bytes, counts: np.ndarray) -> int:
    """The class that a word of a shape moves to. counts: with each class that follows, then that precedes, then itself."""
    k, a, self_ = core.k, core.class_of(word), float(counts[-1])
    out, into = counts[:k].astype(float), counts[k : 2 * k].astype(float)
    out[a] -= self_
    into[a] -= self_
    table = without(core.table, a, out, into, self_)
    gain = gains(table, out, into, self_, k)
    best = int(gain[: core.classes].argmax())
    return best if gain[best] > gain[a] + 1e-9 else a


@dataclass
class Model:
    """transition[p, c] = p(c | p); classes after `classes` are the end's and the shapes'."""

    n: int
    v: int
    classes: int
    transition: np.ndarray
    class_counts: np.ndarray
    class_types: np.ndarray

    def emission(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """p(w | class(w)), from each word's class and count."""
        total, types = np.maximum(1, self.class_counts[classes]), self.class_types[classes]
        unseen = np.where(self.class_counts[classes] > 0, DISCOUNT * types / total, 1.0) / (types + 1)
        return np.where(classes > self.classes, np.where(counts > 0, (counts - DISCOUNT) / total, unseen), np.maximum(counts, 1) / total)

    def score(self, ids: np.ndarray, ends: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """n_tokens, n_known, base, score of each text. ids: words of all texts, by number; ends: where each ends."""
        base, starts = (counts + 1) / (self.n + self.v + 1), np.r_[0, ends[:-1]]
        now, before = classes[ids], np.empty(len(ids), np.int64)
        before[1:] = now[:-1]
        before[starts] = self.classes  # the end's class
        p = MIX * self.transition[before, now] * self.emission(classes, counts)[ids] + (1 - MIX) * base[ids]
        add = lambda x: np.add.reduceat(x, starts)  # noqa: E731  no text is without tokens
        return ends - starts, add((counts[ids] > 0).astype(np.int64)), add(np.log10(base)[ids]), add(np.log10(p))


def estimate(n: int, v: int, classes: int, table: np.ndarray, class_counts: np.ndarray, class_types: np.ndarray) -> Model:
    prior = (class_counts + 1) / (class_counts.sum() + len(class_counts))
    transition = (table + BACKOFF * prior) / (table.sum(axis=1, keepdims=True) + BACKOFF)
    return Model(n, v, classes, transition, class_counts, class_types)


def held_out(id_col: str, folds: int = 7, fold: int = 2):
    """Whether crc32 of the id as text falls in the fold that is not learnt from (null: it does)."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % folds == fold, F.lit(True))


#: A block row has words, shapes, ids, ends, docs, flags (1: held out, 2: no id); a row of its dictionary word, local, n.
BLOCK = "block int, word binary, local int, n long, words binary, shapes binary, ids binary, ends binary, docs binary, flags binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks and their dictionaries, from (block, id, held, raw) in order of block."""
    types = [pa.int32(), pa.binary(), pa.int32(), pa.int64(), *[pa.binary()] * 6]
    names = [f.split()[0] for f in BLOCK.split(", ")]
    block, number, arrays, docs, flags = None, None, [], [], []

    def emit() -> Iterator[pa.RecordBatch]:
        words, sizes = list(number), np.array([len(a) for a in arrays])
        learnt = [a for a, f in zip(arrays, flags, strict=True) if not f & 1]
        counts = np.bincount(np.concatenate(learnt), minlength=len(words)) if learnt else np.zeros(len(words), np.int64)
        shapes = bytes([SHAPES - 1 if w == END else shape(w) for w in words])
        row = [block, None, None, None, packed(b" ".join(words)), packed(shapes), packed(np.concatenate(arrays)), packed(np.cumsum(sizes).astype(np.int64)), packed(np.array(docs, np.int64)), packed(bytes(flags))]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)
        for at in range(0, len(words), ROWS):
            some = words[at : at + ROWS]
            head = [pa.array(np.full(len(some), block, np.int32)), pa.array(some, pa.binary()), pa.array(np.arange(at, at + len(some), dtype=np.int32)), pa.array(counts[at : at + len(some)].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(head + [pa.nulls(len(some), pa.binary())] * 6, names)

    for batch in batches:
        for b, id_, held, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
            if b != block:
                if arrays:
                    yield from emit()
                block, number, arrays, docs, flags = b, defaultdict(), [], [], []
                number.default_factory = number.__len__
            parts = []
            for piece in pieces(raw.as_py()):
                found = piece.lower().split()
                parts.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
            arrays.append(np.concatenate([*parts, np.array([number[END]], np.int32)]))
            docs.append(id_ or 0)
            flags.append(held | (id_ is None) << 1)
    if arrays:
        yield from emit()


def _block(row: dict) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, their shapes, ids, ends, flags."""
    return unpacked(row["words"]).split(b" "), unpacked(row["shapes"], np.uint8), unpacked(row["ids"], np.int32), unpacked(row["ends"], np.int64), unpacked(row["flags"], np.uint8)


def _pairs(ids: np.ndarray, ends: np.ndarray, flags: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each training token's number and the one before it (of a text's first: the end)."""
    before, starts = np.empty_like(ids), np.r_[0, ends[:-1]]
    before[1:] = ids[:-1]
    before[starts] = end
    use = np.repeat(flags & 1 == 0, np.diff(np.r_[0, ends]))
    return before[use], ids[use]


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2, block_bytes: int = BLOCK_BYTES, core_words: int = CORE, least: int = LEAST, classes: int = CLASSES) -> DataFrame:
    """One row per document: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), held_out(id_col, folds, fold).alias("held"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("raw"))
    blocks = max(1, -(-(rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0) // block_bytes))
    rows = rows.select(F.pmod(F.xxhash64("id", "raw"), F.lit(blocks)).cast("int").alias("block"), "id", "held", "raw")
    parts = min(blocks, PARTITIONS)
    dealt = rows.repartitionById(parts, F.pmod("block", F.lit(parts)).cast("int")).sortWithinPartitions("block")
    table = materialize(map_arrow(dealt, _read, BLOCK).withColumn("is_word", F.col("word").isNotNull().cast("int")), "blocks", ["is_word"])
    collect_garbage(spark)
    texts = part_of(table, "is_word", 0).withColumn("own", F.col("block") + 0).drop("block")
    words = part_of(table, "is_word", 1)
    by_word = Window.partitionBy("word")
    lead = F.row_number().over(by_word.orderBy("block")) == 1  # one row of each word
    known = materialize(words.select("block", "local", "word", F.sum("n").over(by_word).alias("c"), (F.col("n") > 0).alias("learnt"), lead.alias("lead")), "known")
    discard(words)
    collect_garbage(spark)
    counts = known.where("lead AND c > 0").select("word", "c")
    n, v, movable = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") >= least)).first()
    buckets = max(spark.sparkContext.defaultParallelism, -(-movable // BUCKET))
    frequent = [END, *(bytes(r["word"]) for r in counts.where(F.col("word") != F.lit(END)).orderBy(F.desc("c"), "word").limit(core_words).collect())]
    number, f = {w: i for i, w in enumerate(frequent)}, len(frequent)
    top = F.broadcast(spark.createDataFrame([(w, True) for w in frequent], "word binary, core boolean"))  # core_words rows

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, found = f + SHAPES, np.zeros(0, np.int64)
        sums = np.zeros(k * k, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                own, shapes, ids, ends, flags = _block(row)
                symbol = Core(number, None, f - 1).kinds(own, shapes)
                a, b = _pairs(ids, ends, flags, own.index(END))
                sums += np.bincount(symbol[a] * k + symbol[b], minlength=k * k)
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums[found])], ["pair", "c"])

    pairs = map_arrow(texts.select("words", "shapes", "ids", "ends", "flags"), count_pairs, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c")).toArrow()  # at most (f + SHAPES)^2 rows
    matrix = np.zeros((f + SHAPES) ** 2)
    matrix[pairs.column(0).to_numpy()] = pairs.column(1).to_numpy()
    core = cluster(frequent, matrix.reshape(f + SHAPES, -1), classes)
    del pairs, matrix
    k, keys = core.k, 2 * core.k + 1

    def neighbours(block: pa.Table, chosen: pa.Table) -> pa.Table:
        """For each of the chosen words: how often which class follows (key below k), precedes (k to 2 k), itself
        follows (2 k). A row for some words of a bucket: the words, how many keys each has, keys, counts."""
        out = []
        for row in block.to_pylist():
            own, shapes, ids, ends, flags = _block(row)
            order = sorted((crc32(own[i]) % buckets, own[i], i) for i in chosen.column("local").to_pylist())
            bucket, local = np.array([o[0] for o in order], np.int64), np.array([o[2] for o in order], np.int64)
            place = np.full(len(own), -1)
            place[local] = np.arange(len(local))
            kind = core.kinds(own, shapes)
            a, b = _pairs(ids, ends, flags, own.index(END))
            for low in range(0, len(local), CHOSEN):  # so many words at a time, so their table stays small
                some = bucket[low : low + CHOSEN]
                first, second = place[a] - low, place[b] - low
                hits = [(x >= 0) & (x < len(some)) for x in (first, second)]
                same = hits[0] & (a == b)
                code = [first[hits[0]] * keys + kind[b[hits[0]]], second[hits[1]] * keys + k + kind[a[hits[1]]], first[same] * keys + 2 * k]
                times = sum(np.bincount(c, minlength=len(some) * keys) for c in code)
                code = np.flatnonzero(times)
                cuts = np.searchsorted(code, np.arange(len(some) + 1) * keys)
                borders = [0, *(np.flatnonzero(np.diff(some)) + 1).tolist(), len(some)]
                for x, y in zip(borders[:-1], borders[1:], strict=True):
                    part = code[cuts[x] : cuts[y]]
                    columns = np.diff(cuts[x : y + 1]).astype(np.int32), (part % keys).astype(np.uint8), times[part]
                    out.append((int(some[x]), packed(b" ".join(o[1] for o in order[low + x : low + y])), *map(packed, columns)))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.binary()] * 4), strict=True)], names=["bucket", "words", "sizes", "keys", "times"])

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(word, class, before, c) from neighbours() in order of bucket: where it goes and comes from. Each token of it is followed once."""

        def rows() -> pa.RecordBatch:
            return _moves([(w, move(core, w, total[i]), core.class_of(w), int(total[i, :k].sum())) for w, i in place.items()])

        bucket, place, total = None, {}, np.zeros((1024, keys), np.int64)
        for batch in batches:
            for b, words, *columns in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    if place:
                        yield rows()
                    bucket, place, total = b, {}, np.zeros((1024, keys), np.int64)
                sizes, key, times = (unpacked(c, t) for c, t in zip(columns, (np.int32, np.uint8, np.int64), strict=True))
                at = np.array([place.setdefault(w, len(place)) for w in unpacked(words).split(b" ")])
                if len(place) > len(total):
                    total = np.vstack([total, np.zeros((max(len(total), len(place) - len(total)), keys), np.int64)])
                total[np.repeat(at, sizes), key] += times  # a word has a key once in a row
        if place:
            yield rows()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tokens and types of each class, before any moves."""
        found = np.zeros((k, 2), np.int64)
        for batch in batches:
            for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[core.class_of(w)] += (c, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(found[:, 0]), pa.array(found[:, 1])], ["class", "c", "t"])

    marked = known.where("c > 0").join(top, "word", "left")
    rare = (F.col("c") >= least) & F.col("core").isNull()  # of those that move
    chosen = marked.where(rare & F.col("learnt")).select("block", "local")
    near = texts.select("own", "words", "shapes", "ids", "ends", "flags").groupBy("own").cogroup(chosen.groupBy("block")).applyInArrow(neighbours, "bucket int, words binary, sizes binary, keys binary, times binary")
    parts = min(buckets, PARTITIONS)
    near = near.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")).sortWithinPartitions("bucket")
    moves = materialize(map_arrow(near, moved, "word binary, class int, before int, c long"), "moves")
    collect_garbage(spark)
    class_counts, class_types = np.zeros(k), np.zeros(k)
    every = map_arrow(counts, sums, "class int, c long, t long")
    gone = moves.select(F.col("before").alias("class"), -F.col("c"), F.lit(-1).cast("long"))
    every = every.union(gone).union(moves.select("class", "c", F.lit(1).cast("long")))
    for r in every.groupBy("class").agg(F.sum("c").alias("c"), F.sum("t").alias("t")).collect():  # a row a class
        class_counts[r["class"]], class_types[r["class"]] = r["c"], r["t"]

    def attach(block: pa.Table, known: pa.Table) -> pa.Table:
        """The block with its words' classes and counts instead of the words, and its class pairs."""
        out = []
        for row in block.to_pylist():
            own, shapes, ids, ends, flags = _block(row)
            kind, times = core.kinds(own, shapes), np.zeros(len(own), np.int64)
            local, c, goes = (known.column(c).to_numpy() for c in ("local", "c", "class"))
            times[local] = c
            kind[local[goes >= 0]] = goes[goes >= 0]
            a, b = _pairs(ids, ends, flags, own.index(END))
            sums = np.bincount(kind[a] * k + kind[b], minlength=k * k)
            out.append((row["ids"], row["ends"], row["docs"], row["flags"], packed(kind.astype(np.uint8)), packed(times), sums.tolist()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 7
        return pa.table([*(pa.array(c, pa.binary()) for c in columns[:6]), pa.array(columns[6], pa.list_(pa.int64()))], names=["ids", "ends", "docs", "flags", "kinds", "counts", "pairs"])

    # a word that moved did so in every block that has it, learnt there or not
    stays = marked.where(~rare).select("block", "local", "c", F.lit(-1).alias("class"))
    attributes = stays.union(marked.where(rare).join(moves.select("word", "class"), "word", "left").select("block", "local", "c", F.coalesce("class", F.lit(-1))))
    ready = texts.select("own", "words", "shapes", "ids", "ends", "docs", "flags").groupBy("own").cogroup(attributes.groupBy("block")).applyInArrow(attach, "ids binary, ends binary, docs binary, flags binary, kinds binary, counts binary, pairs array<long>")
    ready = materialize(ready, "ready")
    collect_garbage(spark)
    for t in (table, known, moves):
        discard(t)
    transitions = np.zeros(k * k)
    for r in ready.select(F.posexplode("pairs").alias("pair", "c")).where("c > 0").groupBy("pair").agg(F.sum("c").alias("c")).collect():  # k^2 rows
        transitions[r["pair"]] = r["c"]
    model = estimate(n, v, classes, transitions.reshape(k, k), class_counts, class_types)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends, flags = unpacked(row["ends"], np.int64), unpacked(row["flags"], np.uint8)
                size, seen, base, found = model.score(unpacked(row["ids"], np.int32), ends, unpacked(row["kinds"], np.uint8).astype(np.int64), unpacked(row["counts"], np.int64).astype(np.float64))
                ids = pa.array(unpacked(row["docs"], np.int64), mask=flags & 2 > 0)
                columns = [ids, pa.array(flags & 1 > 0), pa.array(size), pa.array(seen), pa.array(np.full(len(size), n)), pa.array(base), pa.array(found), pa.array(10.0 ** (-found / size))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    out = map_arrow(ready.drop("pairs"), score, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
    return out.withColumnRenamed("id", id_col)


def _moves(done: list[tuple[bytes, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*done, strict=True)) if done else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["word", "class", "before", "c"])
