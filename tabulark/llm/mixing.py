"""Mixing sources to target weights: blocks of words, drawn by index.

All words of a source, in a fixed order of its documents, are packed end to end into blocks of `block`
words. A source's target is its weight's part of `share` times all words, at most `ceiling` times
its own size; what is over goes to the others by weight until none is above (closed form: order
by limit / weight, then one running sum). The mix has round(target / words per block) slots for a
source, at most ceiling times its blocks.

Each slot draws its output shard: the counts of a source over the shards are a multinomial draw, and so are,
given a shard's size, the counts of the sources in it. The counts, summed up over the shards, number a source's
slots 0, 1, .. in order of shard; slot k takes block perm(k mod blocks), perm being the source's own
pseudorandom permutation of its indices, so a block is taken floor or ceil times as often as the average, and
its copies lie in shards that have nothing to do with each other. Blocks are joined by (source, index): no key is
hot, whatever a source's size.

A permutation is an affine map (by a prime that doesn't divide the number of blocks; it can send any index
anywhere) and then swap-or-not rounds, which break its order up: in round r, x is exchanged with (K_r - x) mod n
if a hash bit of the greater of both is set. A bijection for every n, in plain arithmetic, the same on every run.

Only DataFrame and SQL functions. Running sums are in two levels: documents fall into cells by a hash of id and
size, one for every 2^16 documents and CELLS at least, so a source with a third of all rows is sorted in as many
tasks, also if ids are null or alike. Texts are left out until the end, where they are joined once, by row.

Defined results: null and blank texts have size 0 and are taken 0 times; sources of equal name are one,
null is a source and comes last; ids may repeat or be null (order: cell, id, size); equal rows are rows of their
own; an empty table gives no rows; a source of no words has target 0; texts of any length are one row each; extra
columns are not read (mix) or kept, whatever their names (mix_texts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import discard, fresh, materialize

WEIGHTS, SHARE, CEILING, BLOCK = (3, 1, 2), 1.5, 2, 64
#: Output shards: one for so many words of the sources, and so many at least.
SHARDS, SHARD_WORDS = 64, 1 << 22
CELLS, PER_CELL, CHUNK, TASKS, ROUNDS = 256, 1 << 16, 1 << 15, 100_000, 8
WORD = r"[^\x20\x09-\x0D]+"
#: A word with the white space before it.
SPACED = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
PRIME = 2147483647
#: Primes below 2^25. A number below 2^75 has at most three of them as factors.
FACTORS = (33554393, 33554383, 33554371, 33554347)


def constants(r: int) -> tuple[int, int]:
    """Multiplier and shift of round r."""
    return (48271 * (r + 11) * 69621) % PRIME, (16807 * (r + 5) * 39373) % PRIME


def factor(n: str) -> str:
    """The first of FACTORS that doesn't divide n; SQL of both engines."""
    return "CASE " + " ".join(f"WHEN {n} % {p} <> 0 THEN {p}" for p in FACTORS[:-1]) + f" ELSE {FACTORS[-1]} END"


def affine(x: str, n: str, seed: str) -> str:
    """SQL of both engines."""
    return f"(({x}) * (({factor(n)}) % {n}) + (({seed} + 1) * 16807) % {n}) % {n}"


def draw(slot: str, rank: str, shards: int | str) -> str:
    """A shard at random; SQL of Spark (DuckDB: // for div)."""
    first = f"((({slot}) % {PRIME}) * 48271 + ({rank} + 1) * 69621) % {PRIME}"
    second = f"((({first}) * ({first}) + ({slot})) % {PRIME} * 16807 + {rank}) % {PRIME}"
    return f"(({second}) * ({second}) + {first}) % {PRIME} * {shards} div {PRIME}"


def permute(df: DataFrame, x: str, n: str, seed: str, out: str, rounds: int = ROUNDS) -> DataFrame:
    """df with out = permutation (by column seed, below 2^20) of column x within 0 to n - 1."""
    keys = ", ".join("named_struct('a', {}L, 'c', {}L)".format(*constants(r)) for r in range(rounds))
    other = f"pmod(({seed} + 1) * r.a + r.c - x, {n})"
    top = f"greatest(x, {other})"
    hashed = f"((({top} % {PRIME}) * r.a + r.c) % {PRIME})"
    # a fold keeps the expression small: as nested columns its size would double with each round
    return df.withColumn(out, F.expr(f"aggregate(array({keys}), {affine(x, n, seed)}, (x, r) -> if(({hashed} * {hashed} + {top}) % {PRIME} div 1024 % 2 = 1, {other}, x))"))


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sources(rows: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, ceiling: int = CEILING, block: int = BLOCK) -> DataFrame:
    """(source, rank, source_size, target, blocks, slots), from rows of (source, size). One row a source."""
    sized = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    sized = sized.withColumn("rank", (F.row_number().over(by_name) - 1).cast("long"))
    weight = F.expr("element_at(array({}), int(rank % {}) + 1)".format(", ".join(f"{w}D" for w in weights), len(weights)))
    sized = sized.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(ceiling)))
    earlier = Window.orderBy(F.expr("most / weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    sized = sized.withColumn("level", level)
    sized = sized.withColumn("water", F.min(F.when(F.expr("level <= most / weight"), F.struct(F.expr("most / weight"), "rank", "level"))).over(everything)["level"])
    sized = sized.withColumn("target", F.coalesce(F.least("most", F.col("water") * F.col("weight")), "most"))
    sized = sized.withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    sized = sized.withColumn("slots", F.expr(f"if(source_size = 0, 0L, least({ceiling} * blocks, cast(floor(target * blocks / source_size + 0.5D) as bigint)))"))
    return sized.select("source", "rank", "source_size", "target", "blocks", "slots")


def counts_by_shard(table: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(rank, blocks, shard, begun, n): n slots of a source in each shard, drawn, and how many are in shards before."""
    chunks = table.where("slots > 0").withColumn("chunk", F.explode(F.expr(f"sequence(0L, (slots - 1) div {CHUNK})")))
    # a chunk is a few bytes until its slots are listed: a number given keeps Spark from merging chunks by size
    n = table.agg(F.sum(F.expr(f"(slots + {CHUNK - 1}) div {CHUNK}"))).first()[0]
    chunks = chunks.repartition(min(max(1, n or 0), TASKS), "rank", "chunk")
    each = chunks.withColumn("slot", F.explode(F.expr(f"sequence(chunk * {CHUNK}, least(slots, (chunk + 1) * {CHUNK}) - 1)")))
    drawn = each.groupBy("rank", "blocks", F.expr(draw("slot", "rank", shards)).alias("shard")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard
    return drawn.withColumn("begun", F.coalesce(F.sum("n").over(before), F.lit(0)))


def slots(counts: DataFrame) -> DataFrame:
    """(rank, block, copy, shard, place): every slot of the mix, from counts_by_shard(); place orders a shard."""
    chunks = counts.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n - 1) div {CHUNK})")))
    n = counts.agg(F.sum("n")).first()[0]
    chunks = chunks.repartition(min(1 + (n or 0) // CHUNK, TASKS), "rank", "shard", "chunk")
    each = chunks.withColumn("slot", F.explode(F.expr(f"sequence(begun + chunk * {CHUNK}, begun + least(n, (chunk + 1) * {CHUNK}) - 1)")))
    each = permute(each.withColumn("_index", F.expr("slot % blocks")), "_index", "blocks", "rank", "block")
    return each.select("rank", "block", F.expr("slot div blocks").alias("copy"), "shard", F.expr(draw("slot * 31 + 7", "rank", 1 << 30)).alias("place"))


def shards_for(table: DataFrame) -> int:
    return max(SHARDS, (table.agg(F.sum("source_size")).first()[0] or 0) // SHARD_WORDS)


def cell_of(id_: str, size: str) -> str:
    """A number below PRIME; SQL of both engines."""
    mixed = f"((coalesce({id_}, 0) % {PRIME} + {PRIME}) % {PRIME} * 48271 + {size} % {PRIME} * 69621 + 11) % {PRIME}"
    return f"(({mixed}) * ({mixed}) + {size}) % {PRIME}"


def placed(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows (id, source, size, ...) with rank, source_size, target, and start: words of the source before them."""
    cells = max(CELLS, rows.count() // PER_CELL)
    rows = rows.withColumn("cell", F.expr(f"{cell_of('id', 'size')} % {cells}"))
    sums = rows.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    sums = sums.select("source", "cell", F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    sums = sums.join(table.select(F.col("source").alias("name"), "rank", "source_size", "target"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    sums = sums.select(F.col("source").alias("_source"), F.col("cell").alias("_cell"), "offset", "rank", "source_size", "target")
    inner = F.coalesce(F.sum("size").over(Window.partitionBy("source", "cell").orderBy(F.col("id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("inner", inner).join(sums, F.col("source").eqNullSafe(F.col("_source")) & (F.col("cell") == F.col("_cell")))
    return rows.withColumn("start", F.col("offset") + F.col("inner")).drop("_source", "_cell", "cell", "inner", "offset")


def taken_parts(at: DataFrame, table: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """at, a row for each time that a part of a document is taken: with from, words, copy, shard, place."""
    parts = at.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    parts = parts.withColumn("from", F.expr(f"greatest(start, block * {block}) - start")).withColumn("words", F.expr(f"least(start + size, (block + 1) * {block}) - start - `from`"))
    # both sides grow with the input: estimates below an explode are too low to pick a broadcast by
    counts = materialize(counts_by_shard(table, shards), "counts")  # a row for each source and shard
    return parts.join(slots(counts).hint("merge"), ["rank", "block"])


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, shards: int | None = None) -> DataFrame:
    """One row per document: id_col, size, source_size, target, taken, n_shards (that it is taken into)."""
    rows = materialize(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{source_col}`").alias("source"), size_of(F.col(f"`{text_col}`")).alias("size")), "sizes")
    table = materialize(sources(rows, block=block), "sources")
    shards = shards or shards_for(table)
    at = materialize(placed(rows, table), "placed")
    discard(rows)
    taken = taken_parts(at.select("rank", "start", "size"), table, block, shards).groupBy("rank", "start").agg(F.sum("words").alias("taken"), F.size(F.collect_set("shard")).cast("long").alias("n_shards"))
    some = at.where("size > 0").join(taken.select(F.col("rank").alias("_r"), F.col("start").alias("_s"), "taken", "n_shards").hint("merge"), F.expr("rank = _r and start = _s"), "left")
    none = F.lit(None).cast("long")
    out = some.select("id", "size", "source_size", "target", "taken", "n_shards").unionByName(at.where("size = 0").select("id", "size", "source_size", "target", none.alias("taken"), none.alias("n_shards")))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("taken", "n_shards")])


def mix_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, shards: int | None = None) -> DataFrame:
    """The mix itself, as documents with the columns of docs, a partition for each shard: one row for each time some
    of a document is taken, its text the blocks taken that time, in order and with the white space before each
    word (the text itself where all are). A row lies in the shard, and at the place, of its first block."""
    own, text, key = docs.columns, F.col(f"`{text_col}`"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    names = {n: fresh(own, n) for n in ("_id", "_key", "_parts", "_words", "_size", "_shard", "_place", "_part")}
    rows = materialize(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{source_col}`").alias("source"), size_of(text).alias("size"), key.alias("key")), "sizes")
    table = materialize(sources(rows, block=block), "sources")
    shards = shards or shards_for(table)
    parts = taken_parts(placed(rows, table).select("rank", "start", "size", "id", "key"), table, block, shards)
    pieces = parts.groupBy("rank", "start", "id", "key", "size", "copy").agg(F.array_sort(F.collect_list(F.struct("from", "words"))).alias("parts"), F.min(F.struct("from", "shard", "place")).alias("at"), F.sum("words").alias("words"))
    pieces = pieces.select(*[F.col(c).alias(names[f"_{c}"]) for c in ("id", "key", "parts", "words", "size")], F.col("at.shard").alias(names["_shard"]), F.col("at.place").alias(names["_place"]))
    pieces = materialize(pieces, "pieces")
    again = rows.groupBy("id", "key").count().where("count > 1").limit(1).count()
    discard(rows)
    full = docs.withColumn(names["_id"], F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0))).withColumn(names["_key"], key)
    if again:
        full = full.dropDuplicates([names["_id"], names["_key"]])  # equal rows: the pieces of all of them are there
    found = full.join(pieces.withColumn(names["_id"], F.coalesce(names["_id"], F.lit(0))).hint("merge"), [names["_id"], names["_key"]])
    listed = F.regexp_extract_all(text, F.lit(SPACED), F.lit(0))
    cut = F.array_join(F.flatten(F.transform(names["_parts"], lambda p: F.slice(listed, (p["from"] + 1).cast("int"), p["words"].cast("int")))), "")
    found = found.withColumn(names["_part"], F.when(F.col(names["_words"]) == F.col(names["_size"]), text).otherwise(F.regexp_replace(cut, r"^[\x20\x09-\x0D]+", "")))
    dealt = found.select(names["_shard"], names["_place"], *[F.col(names["_part"]).alias(c) if c == text_col else F.length(names["_part"]).cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in own])
    return dealt.repartitionById(shards, F.col(names["_shard"]).cast("int")).sortWithinPartitions(names["_shard"], names["_place"]).select(*[F.col(f"`{c}`") for c in own])


def oracle(block: int = BLOCK, rounds: int = ROUNDS) -> str:
    """The same for DuckDB, over the view documents: plain windows and the same arithmetic."""
    steps, last = [], "s0"
    for r in range(rounds):
        a, c = constants(r)
        steps.append(f"o{r} AS (SELECT *, ((((rank + 1) * {a} + {c} - x) % blocks) + blocks) % blocks AS y FROM {last})")
        steps.append(f"h{r} AS (SELECT *, ((greatest(x, y) % {PRIME}) * {a} + {c}) % {PRIME} AS h FROM o{r})")
        steps.append(f"s{r + 1} AS (SELECT rank, blocks, shard, CASE WHEN ((h * h + greatest(x, y)) % {PRIME}) // 1024 % 2 = 1 THEN y ELSE x END AS x FROM h{r})")
        last = f"s{r + 1}"
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    shards = f"greatest({SHARDS}, (SELECT sum(source_size) FROM n) // {SHARD_WORDS})"
    cell = f"{cell_of('doc_id', 'size')} % greatest({CELLS}, (SELECT count(*) FROM d) // {PER_CELL})"
    return f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM documents),
g AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE rank % {len(WEIGHTS)} {weights} END AS weight FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM g)),
m AS (SELECT *, source_size * CAST({CEILING} AS DOUBLE) AS most FROM w),
l AS (SELECT *, (sum(source_size) OVER () * CAST({SHARE} AS DOUBLE) - coalesce(sum(most) OVER e, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0)) AS level
  FROM m WINDOW e AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (SELECT arg_min(level, most / weight) AS water FROM l WHERE level <= most / weight),
t AS (SELECT source, CAST(rank AS BIGINT) AS rank, source_size, coalesce(least(most, water * weight), most) AS target, (source_size + {block - 1}) // {block} AS blocks FROM l LEFT JOIN a ON true),
n AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least({CEILING} * blocks, CAST(floor(target * blocks / source_size + 0.5) AS BIGINT)) END AS slots FROM t),
v AS (SELECT rank, blocks, {draw("slot", "rank", shards).replace(" div ", " // ")} AS shard FROM (SELECT rank, blocks, unnest(range(slots)) AS slot FROM n WHERE slots > 0)),
q AS (SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY rank ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begun FROM (SELECT rank, blocks, shard, count(*) AS n FROM v GROUP BY ALL)),
s0 AS (SELECT rank, blocks, shard, {affine("slot % blocks", "blocks", "rank")} AS x FROM (SELECT rank, blocks, shard, unnest(range(begun, begun + n)) AS slot FROM q)),
{", ".join(steps)},
p AS (SELECT doc_id, size, rank, source_size, target, CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY {cell}, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source),
b AS (SELECT rank, start, unnest(range(start // {block}, (start + size - 1) // {block} + 1)) AS block, size FROM p WHERE size > 0),
k AS (SELECT b.rank, start, CAST(sum(least(start + size, (block + 1) * {block}) - greatest(start, block * {block})) AS BIGINT) AS taken, count(DISTINCT shard) AS n_shards FROM b JOIN {last} AS c ON b.rank = c.rank AND b.block = c.x GROUP BY ALL)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, coalesce(n_shards, 0) AS n_shards FROM p LEFT JOIN k ON p.rank = k.rank AND p.start = k.start AND p.size > 0
"""
