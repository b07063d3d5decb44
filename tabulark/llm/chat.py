"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio, document (any type). A visitor, one expression
over the array, flattens them in order: text is escaped, any other part becomes a placeholder
`<type:k>` (k: its number among the turn's attachments), and its reference and expanded token
count are recorded. The count is what the part says, else what its type and measures expand to: an image
the tiles of its pixels, audio its seconds, a document its pages. A turn is written

    <s>ROLE<m>CONTENT</s>\n

Marks begin with `<`; inside roles and texts the characters `\\`, `<` and `[` are written `\\0`, `\\1` and
`\\2`, so no control string survives there and unescaping is exact. The loss mask lists, for each turn of a
`learn` role, the place of its content within the turn's segment (code points).

Only DataFrame and SQL functions. A conversation is one row of the result, so it is gathered where that
row is made; turns are formatted before that, in parallel.

Defined results: null roles, texts and part lists count as empty; turns are ordered by turn (null
first), role, content before it is escaped, so repeated rows and ties have one order; null conv_id is a
conversation; a text of any length is one turn, whole; a part without measures and count expands to 0 tokens; extra
columns are not read, whatever their names; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands for the characters that marks use.
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"))
OPEN, MIDDLE, CLOSE = "<s>", "<m>", "</s>\n"
PART = "array<struct<type:string,text:string,ref:string,tokens:bigint,width:bigint,height:bigint,length:double>>"
#: Tokens of an image: a base and so many for each tile; of a second of audio; of a page.
IMAGE_BASE, TILE_TOKENS, TILE_PIXELS, SECOND_TOKENS, PAGE_TOKENS = 85, 170, 512.0, 25, 600


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def text_parts(text: Column) -> Column:
    """A plain text as its list of parts."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *[F.lit(None).alias(c) for c in ("ref", "tokens", "width", "height", "length")])).cast(PART)


def expanded(part: Column) -> Column:
    """Tokens of a part that is not text."""
    tiles = F.ceil(part["width"] / TILE_PIXELS) * F.ceil(part["height"] / TILE_PIXELS)
    rules = {"image": IMAGE_BASE + TILE_TOKENS * tiles, "audio": F.ceil(part["length"] * SECOND_TOKENS), "document": F.ceil(part["length"]) * PAGE_TOKENS}
    return F.coalesce(part["tokens"], *[F.when(part["type"].eqNullSafe(kind), rule) for kind, rule in rules.items()], F.lit(0)).cast("long")


def visited(parts: Column) -> Column:
    """struct<content, files>: parts flattened to one string, and array<struct<number,type,ref,tokens>> of what is
    not text. One fold over the parts: each adds its piece, and its number is how many files there are so far."""
    file = "array<struct<number:bigint,type:string,ref:string,tokens:bigint>>"
    start = F.struct(F.array().cast("array<string>").alias("pieces"), F.array().cast(file).alias("files"))

    def visit(seen: Column, part: Column) -> Column:
        is_text, number = part["type"].eqNullSafe("text"), F.size(seen["files"]).cast("long")
        kind = F.coalesce(part["type"], F.lit("unknown"))
        placeholder = F.concat(F.lit("<"), escape(kind), F.lit(":"), number.cast("string"), F.lit(">"))
        new = F.struct(number.alias("number"), kind.alias("type"), part["ref"].alias("ref"), expanded(part).alias("tokens"))
        piece = F.when(is_text, escape(F.coalesce(part["text"], F.lit("")))).otherwise(placeholder)
        return F.struct(F.concat(seen["pieces"], F.array(piece)).alias("pieces"), F.when(is_text, seen["files"]).otherwise(F.concat(seen["files"], F.array(new))).alias("files"))

    return F.aggregate(parts, start, visit, lambda seen: F.struct(F.array_join(seen["pieces"], "").alias("content"), seen["files"].alias("files")))


def format_chat(turns: DataFrame, parts: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn: tuple = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_col, formatted, loss_mask array<struct<turn,start,end>>, attachments
    array<struct<turn,number,type,ref,tokens>>, expanded_tokens (of attachments). parts: a column of PART;
    left out, the text column is the only part."""
    parts = text_parts(F.col(f"`{text_col}`")) if parts is None else F.coalesce(parts, F.array().cast(PART))
    plain = F.array_join(F.transform(parts, lambda p: F.coalesce(F.when(p["type"].eqNullSafe("text"), p["text"]).otherwise(p["type"]), F.lit(""))), "")
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), plain.alias("plain"), visited(parts).alias("seen"))
    rows = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "plain", F.col("seen.content").alias("content"), F.col("seen.files").alias("files")))).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE))
    rows = rows.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["content"], F.lit(CLOSE))), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t, i: F.when(t["role"].isin(*learn), F.struct(i.alias("turn"), F.length(head(t)).alias("start"), (F.length(head(t)) + F.length(t["content"])).alias("end")))), lambda m: m.isNotNull()).alias("loss_mask"),
        F.flatten(F.transform("turns", lambda t, i: F.transform(t["files"], lambda f: F.struct(i.alias("turn"), *[f[c].alias(c) for c in ("number", "type", "ref", "tokens")])))).alias("attachments"),
    )
    return rows.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted with turns array<struct<role,text>> and loss_text, parsed from formatted and loss_mask alone."""
    cut = F.split("formatted", CLOSE, -1)
    segments = F.slice(cut, 1, F.size(cut) - 1)
    out = formatted.withColumn("_segments", segments)
    role = lambda s: unescape(F.substring(F.substring_index(s, MIDDLE, 1), len(OPEN) + 1, 1 << 30))
    text = lambda s: unescape(F.substring_index(s, MIDDLE, -1))
    out = out.withColumn("turns", F.transform("_segments", lambda s: F.struct(role(s).alias("role"), text(s).alias("text"))))
    under = F.transform("loss_mask", lambda m: unescape(F.substr(F.get("_segments", m["turn"]), m["start"] + 1, m["end"] - m["start"])))
    return out.withColumn("loss_text", F.array_join(under, "")).drop("_segments")


def digest(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """conv_col, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the output."""
    back = read_back(formatted)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def oracle() -> str:
    """The digest for DuckDB, over the view conversations and conversation -1."""
    written = "length(replace(replace(replace({0}, '\\', '\\0'), '<', '\\1'), '[', '\\2'))"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
  CAST(sum(CASE WHEN r = 'assistant' THEN length(x) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, r, x) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(OPEN + MIDDLE + CLOSE)} + {written.format('r')} + {written.format('x')}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
