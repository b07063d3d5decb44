"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with the word's borders) and itself, hashed to a
table of embeddings; its vector is the mean of theirs, a passage's the mean of its words'. A
linear softmax over two classes reads a passage, and a text is as toxic as its worst passage of
`WINDOW` words, so a few words count in a long text too. Misspellings that were never seen share
n-grams, hence vectors, with what was. Embeddings and softmax are trained together (Adagrad on
the passage that stands out most in each labelled text); the text score is then calibrated.

A word said again within three words counts nothing, in training as in scoring: saying it on and on makes a
passage no worse.

The model is fitted in the driver on a bounded sample of labelled rows: at most SAMPLE_TOXIC and
SAMPLE_CLEAN labels in hash order, as many rows, SAMPLE_BYTES in all. Every text is scored, whole, in place
(no shuffle). What is sent to executors is a table of 2^17 floats.

Defined results: null, empty and wordless texts score as a passage without words (the bias alone); texts of any
length are scored whole; labels that are null, or without a document, teach nothing; a doc_id labelled twice
teaches twice, different texts of one id each teach, equal ones once; repeated rows each get their row and the same
score, whatever stands next to them; if either class is missing every score is the share of toxic labels (0 without
labels); an empty table gives no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow, per_batch, raw_texts

BUCKETS, DIMENSIONS, GRAMS, WINDOW = 1 << 17, 8, (3, 4, 5), 10
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_BYTES = 1500, 3000, 12 << 20
#: Least steps in an epoch: a small sample is cut into smaller batches.
STEPS = 30
#: A feature needs so many texts; a share of the sample is kept for calibration.
MIN_TEXTS, CALIBRATION = 6, 0.25
EPOCHS, BATCH, RATE, SEED = 14, 256, 0.3, 42
CHUNK, ROWS = 1 << 18, 256
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_IS_LETTER = np.array([chr(b).isalnum() if b < 0x80 else True for b in range(256)])


def features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-cased UTF-8 bytes: where each word starts; bucket of each feature; its word."""
    letter = np.concatenate([[False], _IS_LETTER[data], [False]])
    symbol = np.where(letter, np.concatenate([[0], data, [0]]), 0).astype(np.uint64) + np.uint64(1)
    starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    word = np.cumsum(letter & ~np.concatenate([[False], letter[:-1]])) - 1
    gaps = np.concatenate([[0], np.cumsum(~letter)])
    buckets, owners = [], []
    for n in GRAMS:
        if len(symbol) < n:
            continue
        m = len(symbol) - n + 1
        code = np.zeros(m, np.uint64)
        for k in range(n):
            code = code * np.uint64(0x100000001B3) + symbol[k : k + m]
        inside = np.flatnonzero(gaps[n - 1 : n - 1 + m] == gaps[1 : 1 + m])
        buckets.append(((code[inside] + np.uint64(n)) * _MULTIPLIER) >> np.uint64(47))
        owners.append(word[inside + 1])
    if len(starts):  # words themselves: sums of position-weighted symbols
        place = np.arange(len(symbol)) - starts[np.maximum(word, 0)]
        weight = np.cumprod(np.full(256, 0x100000001B3, np.uint64))[np.clip(place, 0, 255)]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(symbol * weight)])
        buckets.append(((sums[ends] - sums[starts]) * _MULTIPLIER) >> np.uint64(47))
        owners.append(np.arange(len(starts)))
    if not buckets:
        return starts, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return starts - 1, np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def said_again(words: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Which words occur among the three before them in their text."""
    again = np.zeros(len(words), bool)
    for back in range(1, min(4, len(words))):
        again[back:] |= (words[back:] == words[:-back]) & (texts[back:] == texts[:-back])
    return again


def word_scores(data: np.ndarray, table: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its score; bounds: where each text begins, the end last."""
    starts, buckets, owners = features(data)
    n = len(starts)
    scores = np.bincount(owners, table[buckets], n) / np.maximum(1, np.bincount(owners, minlength=n))
    scores[said_again(buckets[len(buckets) - n :], np.searchsorted(bounds, starts, "right"))] = 0
    return starts, scores


def passages(scores: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """For each text (words bounds[i] to bounds[i+1]): the greatest mean of `window` words, or of
    all if fewer (0 without words); and the first word of that passage."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    best, at = np.zeros(len(bounds) - 1), bounds[:-1].copy()
    sizes = np.diff(bounds)
    few = (sizes > 0) & (sizes <= window)
    best[few] = (sums[bounds[1:][few]] - sums[bounds[:-1][few]]) / sizes[few]
    for i in np.flatnonzero(sizes > window):
        a, b = bounds[i], bounds[i + 1]
        means = (sums[a + window : b + 1] - sums[a : b + 1 - window]) / window
        k = int(means.argmax())
        best[i], at[i] = means[k], a + k
    return best, at


@dataclass
class Model:
    """score = sigmoid(slope * (worst passage) + bias); table holds each bucket's logit."""

    table: np.ndarray
    slope: float
    bias: float

    def score(self, raws: list[bytes], chunk: int = CHUNK) -> np.ndarray:
        out, group, size = [], [], 0
        for raw in raws:
            if group and size + len(raw) > chunk:
                out.append(self._score(group))
                group, size = [], 0
            if len(raw) > chunk:
                out.append(self._logistic(passages(words := self._long(raw, chunk), np.array([0, len(words)]))[0]))
                continue
            group.append(raw)
            size += len(raw) + 1
        if group:
            out.append(self._score(group))
        return np.concatenate(out) if out else np.zeros(0)

    def _long(self, raw: bytes, chunk: int) -> np.ndarray:
        """Word scores of one text, a chunk at a time: each is cut between words and led in by the three words before it."""
        found, at, lead, skip = [], 0, b"", 0
        while at < len(raw):
            cut = at + chunk
            while cut < len(raw) and _IS_LETTER[raw[cut]] and _IS_LETTER[raw[cut - 1]]:
                cut += 1
            joined, bounds = join([lead + raw[at:cut]])
            starts, scores = word_scores(joined, self.table, bounds)
            found.append(scores[skip:])
            skip = min(3, len(starts))
            lead = (lead + raw[at:cut])[starts[-skip] :] if skip else b""
            at = cut
        return np.concatenate(found)

    def _score(self, raws: list[bytes]) -> np.ndarray:
        joined, bounds = join(raws)
        starts, scores = word_scores(joined, self.table, bounds)
        return self._logistic(passages(scores, np.searchsorted(starts, bounds))[0])

    def _logistic(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.bias, -500, 500)))


def join(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts with a line end after each, and where each begins, the end last."""
    bounds = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])])
    return np.frombuffer((b"\n".join(raws) + b"\n").lower(), np.uint8), bounds


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices first[i] to first[i] + sizes[i], one run after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - first, sizes)


def index_words(raws: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Each word's number, the distinct words (lower case, as features() cuts them), each text's first word."""
    numbers: dict[bytes, int] = {}
    ids = [np.array([numbers.setdefault(w, len(numbers)) for w in WORD.findall(raw.lower())], np.int32) for raw in raws]
    return np.concatenate(ids), list(numbers), np.concatenate([[0], np.cumsum([len(i) for i in ids])])


def texts_with(ids: np.ndarray, words: np.ndarray, buckets: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many texts have each bucket; one text at a time."""
    counts = np.zeros(BUCKETS, np.int64)
    for a, b in zip(words[:-1], words[1:], strict=True):
        said = np.unique(ids[a:b])
        counts[np.unique(buckets[spread(edges[said], edges[said + 1] - edges[said])])] += 1
    return counts


def train(raws: list[bytes], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Fit on labelled texts. Deterministic."""
    truth = np.array(labels, np.int64)
    if not len(truth) or truth.min() == truth.max():
        share = float(np.clip(truth.mean() if len(truth) else 0.0, 1e-9, 1 - 1e-9))
        return Model(np.zeros(BUCKETS), 0.0, float(np.log(share / (1 - share))))
    ids, vocabulary, words = index_words(raws)
    _, buckets, owners = features(np.frombuffer(b"\n".join(vocabulary) + b"\n", np.uint8))
    order = np.argsort(owners, kind="stable")
    buckets = buckets[order].astype(np.int32)
    edges = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(vocabulary)))])
    del owners, order, vocabulary
    common = texts_with(ids, words, buckets, edges) >= MIN_TEXTS
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-0.1, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    vectors[~common] = 0  # what few texts have would only be learnt by heart
    softmax, bias = rng.uniform(-0.1, 0.1, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen, seen_s, seen_b = np.full(BUCKETS, 1e-6, np.float32), np.full((DIMENSIONS, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    sizes = np.diff(words)
    held = rng.random(len(raws)) < CALIBRATION
    usable = np.flatnonzero((sizes > 0) & ~held)
    weight = np.where(truth == 1, 0.5 / max(1, truth.sum()), 0.5 / max(1, (1 - truth).sum())) * len(truth)

    again = said_again(ids, np.repeat(np.arange(len(raws)), sizes))

    def scores_now() -> np.ndarray:
        table = vectors @ (softmax[:, 1] - softmax[:, 0])
        return np.where(again, 0, (np.add.reduceat(table[buckets], edges[:-1]) / np.diff(edges))[ids]) if len(ids) else np.zeros(0)

    for epoch in range(epochs):
        at = words[:-1][usable] + (rng.random(len(usable)) * np.maximum(1, sizes[usable] - WINDOW + 1)).astype(np.int64)
        which = usable
        if epoch >= 3:
            which = np.concatenate([usable, usable[truth[usable] == 0]])
            at = np.concatenate([passages(scores_now(), words)[1][usable], at[truth[usable] == 0]])
        else:  # any passage of a toxic text is taken for toxic at first; what is common cancels out
            for _ in range(3):
                more = words[:-1][usable] + (rng.random(len(usable)) * np.maximum(1, sizes[usable] - WINDOW + 1)).astype(np.int64)
                which, at = np.concatenate([which, usable]), np.concatenate([at, more])
        shuffled = rng.permutation(len(which))
        for some in np.array_split(shuffled, max(1, min(len(which) // 8, max(STEPS, len(which) // BATCH)))):
            docs, first = which[some], at[some]
            last = np.minimum(first + WINDOW, words[docs + 1])
            places = spread(first, last - first)
            said = ids[places]
            span = edges[said + 1] - edges[said]
            passage = np.repeat(np.repeat(np.arange(len(some)), last - first), span)
            share = (np.repeat(~again[places], span) / np.repeat(span, span) / (last - first)[passage]).astype(np.float32)
            own = buckets[spread(edges[said], span)]
            hidden = np.stack([np.bincount(passage, vectors[own, k] * share, len(some)) for k in range(DIMENSIONS)], axis=1).astype(np.float32)
            logits = hidden @ softmax + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            odds[np.arange(len(some)), truth[docs]] -= 1
            grad = odds * weight[docs][:, None].astype(np.float32)
            back = grad @ softmax.T
            g_s, g_b = hidden.T @ grad / len(some), grad.mean(axis=0)
            seen_s += g_s**2
            seen_b += g_b**2
            softmax -= RATE * g_s / np.sqrt(seen_s)
            bias -= RATE * g_b / np.sqrt(seen_b)
            touched, place = np.unique(own, return_inverse=True)
            step = np.stack([np.bincount(place, back[passage, k] * share, len(touched)) for k in range(DIMENSIONS)], axis=1).astype(np.float32)
            seen[touched] += (step**2).mean(axis=1)
            vectors[touched] -= (RATE * step / np.sqrt(seen[touched])[:, None]) * common[touched][:, None]
    table = (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64)
    best = passages(scores_now().astype(np.float64), words)[0]
    use = held if 0 < truth[held].sum() < held.sum() else np.ones(len(truth), bool)
    slope, shift = calibrate(best[use], truth[use])
    return Model(table, slope, shift)


def calibrate(x: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one input by Newton steps, lightly regularised."""
    scale = x.std() or 1.0
    z, w = np.stack([(x - x.mean()) / scale, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(2)
        w -= np.linalg.solve(hess, z.T @ (p - truth) + 0.05 * w)
    return float(w[0] / scale), float(w[1] - w[0] * x.mean() / scale)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[list[bytes], list[int]]:
    """Bounded: SAMPLE_* rows and bytes, in hash order."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    known = known.withColumn("h", F.xxhash64("id"))
    chosen = known.where("y = 1").orderBy("h", "id").limit(SAMPLE_TOXIC).unionAll(known.where("y = 0").orderBy("h", "id").limit(SAMPLE_CLEAN))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # as many rows as labels, whatever rows an id has; then their texts, within the bytes
    slim = texts.select("id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("key"))
    sizes = slim.join(F.broadcast(chosen), "id").select("h", "id", "key", "size").distinct().orderBy("h", "id", "key").limit(SAMPLE_TOXIC + SAMPLE_CLEAN).collect()
    room, wanted = SAMPLE_BYTES, []
    for r in sizes:
        if r["size"] <= room:
            room -= r["size"]
            wanted.append((r["id"], r["key"]))
    spark = docs.sparkSession
    few = F.broadcast(spark.createDataFrame(wanted, f"id {texts.schema['id'].dataType.simpleString()}, key long"))
    some = texts.withColumn("key", F.xxhash64("text")).join(few, ["id", "key"]).dropDuplicates(["id", "key"])
    rows = some.join(F.broadcast(chosen), "id").orderBy("h", "id", "key", "y").collect()
    return [r["text"].encode() for r in rows], [r["y"] for r in rows]


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score double): one row for each document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [model.score(raw_texts(batch.column(1).slice(at, ROWS))) for at in range(0, batch.num_rows, ROWS)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts))], ["id", "score"])

    out = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(out, per_batch(run), f"id {docs.schema[id_col].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str, folds: int = 5, fold: int = 0):
    """Whether crc32 of the id as text falls in the fold that is not learnt from (null: it does)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(True))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per document: id_col, held_out, score, predicted."""
    model = train(*labelled_sample(docs, labels.where(~held_out(id_col)), id_col, text_col, label_col))
    scored = score_documents(docs, model, id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
