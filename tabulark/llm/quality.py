"""Quality rules from the fertility of public tokenizers.

A text is cut into words; a public vocabulary cuts each word into pieces. Natural text of a script spends a
typical number of characters on a piece, seldom falls back to bytes, and spreads its pieces with a
typical entropy. A text outside the band of its dominant script on any of the three is rejected, as are
texts that fail the base rules (too few words, too many words in repeated three-word windows).

    chars_per_token   code points in words / pieces
    byte_share        share of pieces that are single bytes, not characters
    token_entropy     entropy of the piece distribution in bits / log2(pieces); 0 to 1

Two vocabularies take part, as RULES says: one of 32,000 pieces with byte fallback for the scripts it has pieces
for, one of 50,000 byte-level pieces in many languages for the others, where the first would have little but
bytes. A script that neither knows (its byte share is near 1) is judged by entropy alone.

Pieces of distinct words are cached in each worker within CACHED bytes (a word's pieces don't depend on its
neighbours), so a text costs a lookup for each word. No shuffle; one row out for each row in.

Defined results: null, empty and blank texts have no words and fail the base rules; with no pieces the
ratios are 0; repeated rows and null ids each get their row; an empty table gives no rows; extra columns,
also of clashing names, are not read and stay as they are in keep(); texts of any length are read whole.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import fresh, map_arrow, raw_texts

#: Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
#: By dominant script: the vocabulary, and bands (least, most) of chars_per_token, byte_share, token_entropy.
#: Wide on purpose: clean text must stay. Sentences of 13 languages lie within them with room to spare.
RULES = {
    "latin": (PIECES, (1.55, 12.0), (0.0, 0.10), (0.30, 1.0)),
    "cyrillic": (PIECES, (1.2, 12.0), (0.0, 0.15), (0.30, 1.0)),
    "greek": (BYTES, (0.9, 12.0), (0.0, 0.15), (0.30, 1.0)),
    "semitic": (BYTES, (0.7, 10.0), (0.0, 0.25), (0.30, 1.0)),
    "indic": (BYTES, (0.3, 6.0), (0.0, 0.80), (0.20, 1.0)),
    "cjk": (BYTES, (0.4, 5.0), (0.0, 0.50), (0.25, 1.0)),
    "other": (BYTES, (0.2, 10.0), (0.0, 1.0), (0.20, 1.0)),
    "none": (PIECES, (1.55, 12.0), (0.0, 0.10), (0.30, 1.0)),
}
#: Least characters per token in long text of a language; where it is known it stands in for the
#: script's. A text of n words may fall short of any least by SLACK / sqrt(n): short texts are noisy.
#: From fit_languages() over four fifths of the clean labelled texts of sf0.1, less 0.02; measured on the last fifth.
LANGUAGES = {"en": 2.12, "de": 2.22, "es": 1.94, "fr": 1.90}
SLACK = 2.0
#: Code point ranges of the scripts (letters only).
RANGES = {
    "latin": ((0x41, 0x5B), (0x61, 0x7B), (0xC0, 0x250), (0x1E00, 0x1F00)),
    "greek": ((0x370, 0x400), (0x1F00, 0x2000)),
    "cyrillic": ((0x400, 0x530),),
    "semitic": ((0x590, 0x780), (0x8A0, 0x900), (0xFB1D, 0xFE00), (0xFE70, 0xFF00)),
    "indic": ((0x900, 0xE00),),
    "cjk": ((0x3040, 0x3100), (0x3400, 0xA000), (0xAC00, 0xD7B0), (0x20000, 0x32000)),
    "other": ((0x530, 0x590), (0x780, 0x8A0), (0xE00, 0x1E00), (0x2C00, 0x3040), (0xA000, 0xAC00)),
}
#: Bytes that the cache of a vocabulary may hold, each entry counted with its overhead; rows worked on at once.
CACHED, ENTRY, ROWS = 24 << 20, 190, 256


class Vocabulary:
    """Pieces of words by a public vocabulary, with a cache bounded in bytes."""

    def __init__(self, path: str, size: int = CACHED):
        self.cache, self.held, self.size = {}, 0, size
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
            self._encode = lambda words: model.encode(words, num_threads=1)
        else:
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.is_byte = np.zeros(max(ranks.values()) + 1, bool)
            self.is_byte[[i for b, i in ranks.items() if len(b.strip()) == 1 and b.strip()[0] >= 0x80]] = True
            self._encode = lambda words: model.encode_ordinary_batch([" " + w for w in words], num_threads=1)

    def pieces(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (all distinct), as 32-bit integers."""
        missing = [w for w in words if w not in self.cache]
        if not missing:
            return [self.cache[w] for w in words]
        found = dict(zip(missing, (np.array(p, np.int32).tobytes() for p in self._encode([w.decode() for w in missing])), strict=True))
        out = [found[w] if w in found else self.cache[w] for w in words]
        more = sum(len(w) + len(p) + ENTRY for w, p in found.items())
        if self.held + more > self.size:
            self.cache, self.held = {}, 0
        if more <= self.size:
            self.cache.update(found)
            self.held += more
        return out


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def _scripts() -> np.ndarray:
    """The script of each code point by its place in RANGES, len(RANGES) for none; beyond the table: none."""
    table = np.full(max(b for ranges in RANGES.values() for _, b in ranges) + 1, len(RANGES), np.uint8)
    for place, ranges in enumerate(RANGES.values()):
        for a, b in ranges:
            table[a:b] = place
    return table


def dominant_script(points: np.ndarray, weights: np.ndarray | None = None) -> str:
    """The script with most letters; the first listed of equals; "none" without letters."""
    table = _scripts()
    counts = np.bincount(table[np.minimum(points, len(table) - 1)], weights, len(RANGES))[: len(RANGES)]
    return list(RANGES)[int(counts.argmax())] if counts.any() else "none"


def numbered(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Each word's number, and the distinct words in order of number."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), list(numbers)


def repeated_words(words: list[bytes], window: int = 3, ids: np.ndarray | None = None) -> int:
    """Words inside windows that occur twice or more (every occurrence counts)."""
    if len(words) <= window:
        return 0
    ids = numbered(words)[0] if ids is None else ids
    base = int(ids.max()) + 1
    key = ids[: len(ids) - window + 1]
    for k in range(1, window):
        if base > 1 << 20:  # packed numbers of three words need not fit
            key = np.unique(key, return_inverse=True)[1]
        key = key * np.int64(base) + ids[k : len(ids) - window + 1 + k]
    _, place, counts = np.unique(key, return_inverse=True, return_counts=True)
    hit, covered = counts[place] > 1, np.zeros(len(words), bool)
    for k in range(window):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def repeated_lines(raw: bytes) -> int:
    seen, repeats = set(), 0
    for line in raw.split(b"\n"):
        if line.split(None, 1):
            repeats += line in seen
            seen.add(line)
    return repeats


def base_measures(raw: bytes, words: list[bytes], ids: np.ndarray | None = None) -> tuple[int, int, int, int, int]:
    """n_words, n_symbols, n_dup_lines, n_repeat_words and whether the base rules fail."""
    repeat = repeated_words(words, ids=ids)
    failed = len(words) < MIN_WORDS or 100 * repeat > MAX_REPEATED_PERCENT * len(words)
    return len(words), sum(raw.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS))), repeated_lines(raw), repeat, failed


def fertility(words: list[bytes], paths: dict[str, str], known: tuple[np.ndarray, list[bytes]] | None = None) -> tuple[int, int, float, float, float, str]:
    """word_chars, n_tokens, chars_per_token, byte_share, token_entropy, script. paths: by vocabulary; known: numbered(words).

    Everything here adds up over words, so each distinct word is looked at once, with its count."""
    ids, distinct = known or numbered(words)
    if not distinct:
        return 0, 0, 0.0, 0.0, 0.0, "none"
    times = np.bincount(ids, minlength=len(distinct))
    points = np.frombuffer(b" ".join(distinct).decode().encode("utf-32-le"), np.uint32)
    spaces = points == 32
    owner = (np.cumsum(spaces) - spaces)[~spaces]
    script = dominant_script(points[~spaces], times[owner])
    n_chars = int(times[owner].sum())
    vocabulary = _vocabulary(paths[RULES[script][0]])
    pieces = vocabulary.pieces(distinct)
    tokens = np.frombuffer(b"".join(pieces), np.int32)
    weight = np.repeat(times, np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4)
    n = int(weight.sum())
    if not n:
        return n_chars, 0, 0.0, 0.0, 0.0, script
    counts = np.bincount(tokens, weight) if len(tokens) > 4096 else np.bincount(np.unique(tokens, return_inverse=True)[1], weight)
    share = counts[counts > 0] / n
    entropy = float(-(share * np.log2(share)).sum() / np.log2(n)) if n > 1 else 0.0
    return n_chars, n, n_chars / n, float(weight[vocabulary.is_byte[tokens]].sum() / n), max(0.0, entropy), script


def in_band(script: str, lang: str | None, n_words: int, ratio: float, share: float, entropy: float, rules: dict = RULES, languages: dict = LANGUAGES) -> bool:
    _, (low, high), *others = rules[script]
    if script == "latin":
        low = languages.get(lang, low)
    return low - SLACK / max(1, n_words) ** 0.5 <= ratio <= high and all(a <= x <= b for x, (a, b) in zip((share, entropy), others, strict=True))


def vocabulary_paths() -> dict[str, str]:
    import public_tokenizers

    return {name: public_tokenizers.path(name) for name in (PIECES, BYTES)}


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, n_tokens long, chars_per_token double, byte_share double, token_entropy double, script string, kept boolean"
_FIELDS = [f.split() for f in MEASURES.split(", ")]


def _with_measures(docs: DataFrame, paths: dict[str, str], text_col: str, lang_col: str | None, rules: dict, languages: dict) -> tuple[DataFrame, str]:
    """docs with one struct column of MEASURES, and its name."""
    names = docs.columns
    name, at, lang_at = fresh(names, "_quality"), names.index(text_col), names.index(lang_col) if lang_col else None
    types = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part, rows = batch.slice(first, ROWS), []
                langs = part.column(lang_at).to_pylist() if lang_col else [None] * part.num_rows
                for raw, lang in zip(raw_texts(part.column(at)), langs, strict=True):
                    words = raw.split()
                    known = numbered(words)
                    n_words, n_symbols, dup_lines, repeat, failed = base_measures(raw, words, known[0])
                    chars, tokens, ratio, share, entropy, script = fertility(words, paths, known)
                    rows.append((n_words, chars, n_symbols, dup_lines, repeat, failed, tokens, ratio, share, entropy, script, not failed and in_band(script, lang, n_words, ratio, share, entropy, rules, languages)))
                new = [pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows, strict=True), _FIELDS, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.StructArray.from_arrays(new, [f for f, _ in _FIELDS])], [*part.schema.names, name])

    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return map_arrow(docs, run, ", ".join([*own, f"`{name}` struct<{', '.join(f'{f}: {t}' for f, t in _FIELDS)}>"])), name


def measure(docs: DataFrame, paths: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", rules: dict = RULES, languages: dict = LANGUAGES) -> DataFrame:
    """One row per document: id_col and MEASURES."""
    slim = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys((id_col, text_col, *([lang_col] if lang_col else [])))])
    out, name = _with_measures(slim, paths or vocabulary_paths(), text_col, lang_col, rules, languages)
    return out.select(F.col(f"`{id_col}`"), *[F.col(name)[f].alias(f) for f, _ in _FIELDS])


def keep(docs: DataFrame, paths: dict[str, str] | None = None, text_col: str = "text", lang_col: str | None = "lang", rules: dict = RULES, languages: dict = LANGUAGES) -> DataFrame:
    """The rows of docs that pass, with their own columns."""
    out, name = _with_measures(docs, paths or vocabulary_paths(), text_col, lang_col, rules, languages)
    return out.where(F.col(name)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def fit_languages(docs: DataFrame, labels: DataFrame, share: float = 0.001, folds: int = 5, fold: int = 0, id_col: str = "doc_id", label_col: str = "quality") -> dict[str, float]:
    """LANGUAGES from clean labelled texts (label 1) outside the fold that is held out: what a share of each
    language's falls short of. One aggregate: a number for each language."""
    clean = labels.where((F.col(label_col) == 1) & (F.crc32(F.col(id_col).cast("string")) % folds != fold)).select(id_col).distinct()
    lang = docs.select(id_col, "lang").distinct()
    rows = measure(docs.join(clean, id_col, "left_semi")).where("NOT base_failed AND script = 'latin'").join(lang, id_col)
    found = rows.groupBy("lang").agg(F.percentile_approx(F.col("chars_per_token") + SLACK / F.sqrt("n_words"), share, 10_000).alias("low")).collect()
    return {r["lang"]: round(r["low"], 2) for r in found if r["lang"] is not None}
