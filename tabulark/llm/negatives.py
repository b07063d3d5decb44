"""Hard-negative mining by bounds along a spanning tree of anchors.

Components are quantised to integers, so scores are exact integer inner products. An anchor's positives are its first
`positives` other rows of the same label; for each of them the first `negatives` rows of other labels are sought whose
score lies in a window around a share of the positive's score. Higher scores come first, ties by smaller id.

Anchors are packed `PACK` at a time, near ones together, into a matrix with a least spanning tree (by distance). A task
walks the tree for each block of rows. Rows are scored against the root. A child c of the parent p bounds without
scoring: score(c, x) lies within score(p, x) -+ |c - p| |x|, or so far around the bounds that p had itself. Only rows whose
bounds overlap a window of c (for positives: reach beyond the last of its list) are scored, and have exact bounds from then
on. As lists fill, the end of the last entry narrows the windows. No row is lost, as bounds are wider than rounding.

The work: two passes over all rows for each group of packs (`GROUP` of them, at most `GROUP_BYTES`, sent to every
executor); each task gives back its lists of a group, and lists of one anchor are merged by a window that keeps the
first few of each side before the shuffle. Anchors are a stated set of queries; rows are never paired by a join.

Defined results: rows whose label or vector is null, or with a null or non-finite component, take no part; a shorter
vector counts as filled up with zeros; rows with a null id take part, come last among ties and are no anchors; repeated
rows are rows of their own (each other's positives; anchors each); an anchor without positives, or a positive without
rows in its window (so every negative score), gives no rows; products beyond 2^53 are computed exactly in whole numbers,
and written as the nearest long beyond 2^63; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import discard, map_arrow, materialize

#: Anchors of a tree; trees that are sent at once, and their bytes.
PACK, GROUP, GROUP_BYTES = 512, 32, 1 << 25
#: Rows that are bounded at once.
BLOCK = 4096
#: Vectors up to this length have products within 2^53, which doubles hold exactly.
EXACT_NORM = float(1 << 26)
#: What is added to bounds: more than all rounding of whole numbers within 2^53.
SLACK = 4.0
LAST = np.iinfo(np.int64).max


def prepare(vectors: DataFrame, quantum: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """(uid, id, label, q): rows that take part; q holds floor(quantum * x) for each component x, as doubles."""
    x, mark = F.col(f"`{vector_col}`"), label if label is not None else F.col(f"`{label_col}`")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double") * quantum) < float("inf")))
    rows = vectors.where(F.col(f"`{label_col}`").isNotNull() & x.isNotNull() & finite)
    return rows.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("long").alias("id"), mark.cast("long").alias("label"), F.transform(x, lambda v: _floor(v, quantum)).alias("q"))


def _floor(v: Column, quantum: int) -> Column:
    """The floor as a double: as a long it could be out of range. Doubles of 2^53 or more are whole already."""
    y = v.cast("double") * quantum
    return F.when(F.abs(y) < float(1 << 53), F.floor(F.when(F.abs(y) < float(1 << 53), y)).cast("double")).otherwise(y)


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    width = max(width, int(lengths.max(initial=0)))
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parents (by place, -1 for the root) and edge lengths of a least spanning tree; parents come first."""
    n = len(points)
    squares = np.einsum("ij,ij->i", points, points)
    nearest, parent, left = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    order, edge, at = [], np.zeros(n), 0
    for _ in range(n):
        order.append(at)
        left[at] = False
        gap = np.sqrt(np.maximum(0, squares + squares[at] - 2 * (points @ points[at])))
        closer = left & (gap < nearest)
        nearest[closer], parent[closer] = gap[closer], at
        if left.any():
            at = int(np.argmin(np.where(left, nearest, np.inf)))
            edge[at] = np.sqrt(np.square(points[at] - points[parent[at]]).sum())
    return np.array(order), parent, edge


def packs(anchors: DataFrame, n: int) -> DataFrame:
    """n anchors, packed with their trees; near ones (of a label, then id) come together. One row a pack."""

    def pack(ids: list, q: np.ndarray) -> dict:
        small = np.abs(q).max(axis=1, initial=0) <= EXACT_NORM  # others are scored as they are
        order, parent, edge = spanning_tree(np.where(small[:, None], q, 0))
        uid, anchor, label = (np.array([r[k] for r in ids], np.int64) for k in range(3))
        return {"pack": int(uid.min()), "uid": uid.tobytes(), "anchor": anchor.tobytes(), "label": label.tobytes(), "q": q.tobytes(), "order": order.tobytes(), "parent": parent.tobytes(), "edge": edge.tobytes()}

    schema = pa.schema([("pack", pa.int64()), *[(k, pa.binary()) for k in ("uid", "anchor", "label", "q", "order", "parent", "edge")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, vectors = [], []
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                rows.append([part.column(k)[0].as_py() for k in range(3)])
                vectors.append(np.array(part.column(3)[0].as_py() or [], np.float64))
                if len(rows) == PACK:
                    yield made(rows, vectors)
                    rows, vectors = [], []
        if rows:
            yield made(rows, vectors)

    def made(rows: list, vectors: list[np.ndarray]) -> pa.RecordBatch:
        q = np.zeros((len(rows), max(map(len, vectors))))
        for i, v in enumerate(vectors):
            q[i, : len(v)] = v
        return pa.RecordBatch.from_pylist([pack(rows, q)], schema)

    near = anchors.repartitionByRange(max(1, -(-n // (8 * PACK))), "label", "id", "uid").sortWithinPartitions("label", "id", "uid").select("uid", "id", "label", "q")
    return map_arrow(near, run, "pack long, uid binary, anchor binary, label binary, q binary, `order` binary, parent binary, edge binary")


class Pack:
    """Anchors and their tree, as a task sees them."""

    def __init__(self, row: dict) -> None:
        self.uid, self.anchor, self.label = (np.frombuffer(row[k], np.int64) for k in ("uid", "anchor", "label"))
        self.q = np.frombuffer(row["q"]).reshape(len(self.uid), -1)
        self.order, self.parent = np.frombuffer(row["order"], np.int64), np.frombuffer(row["parent"], np.int64)
        self.edge = np.frombuffer(row["edge"]) * (1 + 1e-9)
        self.exact = np.sqrt(np.square(self.q).sum(axis=1)) <= EXACT_NORM


class Rows:
    """A block of rows: vectors as wide as the anchors, their lengths, ids."""

    def __init__(self, batch: pa.RecordBatch, width: int) -> None:
        ids = batch.column(1)
        self.uid, self.label = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        self.id, self.null = ids.fill_null(LAST).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
        self.q = matrix(batch.column(3))
        self.norm = np.sqrt(np.square(self.q).sum(axis=1)) * (1 + 1e-9)
        self.big = np.flatnonzero(self.norm > EXACT_NORM)
        if self.q.shape[1] < width:
            self.q = np.pad(self.q, ((0, 0), (0, width - self.q.shape[1])))

    def scores(self, some: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
        """Exact scores of some rows; beyond what doubles hold, in whole numbers."""
        width = min(self.q.shape[1], len(anchor))
        if exact and not len(self.big):
            return (self.q[some, :width] @ anchor[:width]).astype(np.int64)
        wide = np.isin(some, self.big) if exact else np.ones(len(some), bool)
        out = np.zeros(len(some), np.int64)
        out[~wide] = self.q[some[~wide], :width] @ anchor[:width]
        whole = [int(a) for a in anchor[:width]]
        for i in np.flatnonzero(wide):
            score = sum(a * int(b) for a, b in zip(whole, self.q[some[i], :width].tolist(), strict=True))
            out[i] = min(max(score, -LAST), LAST)
        return out


def first(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, n: int) -> np.ndarray:
    """Places of the first n: higher scores first, then smaller ids, null last."""
    return np.lexsort((ids, nulls, -scores))[:n]


class Lists:
    """The first n rows so far of each window of one anchor."""

    def __init__(self, windows: list[tuple[int, int]], n: int) -> None:
        self.windows, self.n = windows, n
        empty = np.zeros(0, np.int64)
        self.lists = [(empty, empty, np.zeros(0, bool)) for _ in windows]

    def open(self) -> list[tuple[int, int]]:
        """Scores that can still enter."""
        return [(max(lo, int(s[-1])) if len(s) == self.n else lo, hi) for (lo, hi), (s, _, _) in zip(self.windows, self.lists, strict=True)]

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        for k, (lo, hi) in enumerate(self.open()):
            fit = np.flatnonzero((scores >= lo) & (scores <= hi))
            if len(fit):
                s, i, z = (np.concatenate(x) for x in zip(self.lists[k], (scores[fit], ids[fit], nulls[fit]), strict=True))
                best = first(s, i, z, self.n)
                self.lists[k] = s[best], i[best], z[best]


def walk(pack: Pack, rows: Rows, lists: list[Lists], same: bool) -> int:
    """Let the rows of a block enter the lists of each anchor. same: rows of its label, else those of others. How many
    scores were computed beside the root's."""
    n, scored = len(rows.uid), 0
    low, high = [None] * len(pack.uid), [None] * len(pack.uid)
    unbounded = np.full(n, np.inf)
    for at in pack.order.tolist():
        parent, mine = int(pack.parent[at]), lists[at]
        fits = (rows.label == pack.label[at]) & (rows.uid != pack.uid[at]) if same else rows.label != pack.label[at]
        if parent < 0 or not pack.exact[at]:  # the root, or beyond doubles: every row, and no bounds to hand on then
            score = rows.scores(np.arange(n), pack.q[at], bool(pack.exact[at]))
            some = np.flatnonzero(fits)
            mine.add(score[some], rows.id[some], rows.null[some])
            lo, hi = (score.astype(np.float64), score.astype(np.float64)) if pack.exact[at] else (-unbounded, unbounded)
        else:
            reach = pack.edge[at] * rows.norm + SLACK
            lo, hi = low[parent] - reach, high[parent] + reach
            near = np.zeros(n, bool)
            for a, b in mine.open():
                if a <= b:
                    near |= (hi >= a) & (lo <= b)
            some = np.flatnonzero(near & fits)
            if len(some):
                score = rows.scores(some, pack.q[at], True)
                scored += len(some)
                mine.add(score, rows.id[some], rows.null[some])
                lo[some] = hi[some] = score
        if len(rows.big):
            lo, hi = lo.copy(), hi.copy()
            lo[rows.big], hi[rows.big] = -np.inf, np.inf
        low[at], high[at] = lo, hi
    return scored


OUT = pa.schema([("uid", pa.int64()), ("window", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


def mined(rows: DataFrame, group: list[dict], n: int, same: bool) -> DataFrame:
    """(uid, window, score, id): each task's first n rows of each anchor's windows. group: packs, with the windows
    of their anchors (bytes of two longs each, in lists by anchor)."""
    sent = rows.sparkSession.sparkContext.broadcast(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = [(Pack(row), [Lists(w, n) for w in row["windows"]]) for row in sent.value]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                known: dict[int, Rows] = {}
                for pack, lists in plans:
                    width = pack.q.shape[1]
                    if width not in known:
                        known[width] = Rows(batch.slice(at, BLOCK), width)
                    walk(pack, known[width], lists, same)
        for pack, lists in plans:
            found = [(uid, k, s, i, z) for uid, own in zip(pack.uid.tolist(), lists, strict=True) for k, (s, i, z) in enumerate(own.lists) if len(s)]
            if found:
                sizes = [len(s) for _, _, s, _, _ in found]
                columns = np.repeat([u for u, *_ in found], sizes), np.repeat(np.array([k for _, k, *_ in found], np.int32), sizes), np.concatenate([s for _, _, s, _, _ in found])
                ids = pa.array(np.concatenate([i for *_, i, _ in found]), mask=np.concatenate([z for *_, z in found]))
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), ids], schema=OUT)

    return map_arrow(rows.select("uid", "id", "label", "q"), run, "uid long, window int, score long, id long")


def ranked(lists: DataFrame, n: int) -> DataFrame:
    """The first n of each anchor's window over all tasks, with their rank."""
    order = Window.partitionBy("uid", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def grouped(table: DataFrame, width: int) -> Iterator[list[dict]]:
    """Packs in groups that are bounded by number and bytes."""
    group: list[dict] = []
    most = max(1, min(GROUP, GROUP_BYTES // (8 * PACK * max(1, width))))
    for row in table.toLocalIterator(prefetchPartitions=False):
        group.append(row.asDict())
        if len(group) == most:
            yield group
            group = []
    if group:
        yield group


def window_of(score: int, low: int, high: int, scale: int) -> tuple[int, int]:
    """Whole scores s with low * score <= scale * s <= high * score."""
    return -(-low * score // scale), high * score // scale


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 100, **columns: object) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. anchors: which rows, a predicate over id
    (as prepare() names it). columns: what prepare() takes."""
    spark: SparkSession = vectors.sparkSession
    rows = materialize(prepare(vectors, **columns), "vectors")  # uid is kept: both passes see the same rows
    chosen = rows.where(anchors)
    n, width = chosen.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    trees = materialize(packs(chosen, n), "anchors")
    every = (-LAST, LAST)
    found, rest = [], []
    for group in grouped(trees, width):
        for row in group:
            row["windows"] = [[every]] * (len(row["uid"]) // 8)
        best = materialize(ranked(mined(rows, group, positives, True), positives).select("uid", F.col("rank").alias("window"), "id", "score"), "positives")
        rest.append(best)
        bounds: dict[int, list] = {}
        for r in best.orderBy("uid", "window").toLocalIterator():  # a group's: at most `positives` for each anchor
            bounds.setdefault(r["uid"], []).append(window_of(r["score"], low, high, scale))
        for row in group:
            row["windows"] = [bounds.get(u, []) for u in np.frombuffer(row["uid"], np.int64).tolist()]
        hits = ranked(mined(rows, group, negatives, False), negatives).withColumn("window", F.col("window") + 1)
        named = spark.createDataFrame([(u, a) for row in group for u, a in zip(np.frombuffer(row["uid"], np.int64).tolist(), np.frombuffer(row["anchor"], np.int64).tolist(), strict=True)], "uid long, anchor_id long")
        of = best.select("uid", "window", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(F.broadcast(named), "uid")
        found.append(materialize(hits.join(of, ["uid", "window"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives"))
    for table in (*rest, trees, rows):
        discard(table)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.read.schema(schema).parquet(*[t._tabulark_path for t in found]) if found else spark.createDataFrame([], schema)


def shifted(every: int = 7, labels: int = 10, id_col: str = "vec_id", label_col: str = "label") -> Column:
    """Labels with noise: (label + 1) % labels where the id is divisible by every."""
    label = F.col(f"`{label_col}`").cast("long")
    return F.when(F.col(f"`{id_col}`") % every == 0, (label + 1) % labels).otherwise(label)


def oracle() -> str:
    return """WITH v AS (SELECT row_number() OVER () AS u, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.u AS au, a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.u <> b.u WHERE a.id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY au ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.au, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS "rank", s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON s.au = p.au AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT * FROM n WHERE "rank" <= 10"""
