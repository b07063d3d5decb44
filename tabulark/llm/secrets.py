"""Secret scans through layers of encoding.

Base patterns are matched in the text as it stands. Then a worklist unwraps layers: percent, Unicode, octal
and JSON escapes, HTML character references and quoted-printable bytes are decoded in place; what runs of base64, hex or percent escapes
hold of readable text or of compressed streams (gzip, zlib, zstd, bz2, xz, raw deflate; all members or frames) becomes
layers of its own. Runs are also joined over line breaks (also those written as \\n), and decoded from each of their first four characters
(two of hex), as a path or a word may touch the encoded part: stretches of 12 or more readable characters are
kept, in UTF-8 (of which ASCII is all that the patterns need, whatever other single-byte charset surrounds it)
or UTF-16. Every new layer is scanned and unwrapped in turn until none is left; layers seen before (by place and
digest) are not entered again, so cycles end. Each character of a layer knows the interval of the original
that it came from, so what is found in any layer is reported as a span of the original text.

All of a compressed stream maps to the one run that holds it. So a stream of more than `most` bytes is read in
windows of that size, which overlap by OVERLAP: nothing in it goes unscanned, whatever its size, and memory stays
bounded; n_windowed counts such streams. Only a compressed stream within it that is itself longer than a window
is read no further than the window goes.

Defined results: null and empty texts have no spans; each row of the input, repeated or with a null id, gives one
row; spans that repeat (found in several layers) are listed once; texts of any length are scanned whole; an empty
table gives no rows; extra columns are not read (find) or kept (redact), whatever their names.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: One of these (lower case) is in every text that ASSIGN matches.
HINTS = ("passw", "secret", "token", "apikey", "api_key")
ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|%u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\[0-3][0-7]{2}|\\u\{[0-9A-Fa-f]{1,6}\})+|\\[nrt/\"']|&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
UNIT = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|%u([0-9A-Fa-f]{4})|\\([0-3][0-7]{2})")
SHORT = {"\\n": "\n", "\\r": "\r", "\\t": "\t", "\\/": "/", '\\"': '"', "\\'": "'"}
#: Quoted-printable: bytes, and line ends that it puts into a text.
PRINTABLE = re.compile(r"(?:=[0-9A-F]{2}|=\r?\n)+")
#: A line end, also as a text in JSON has it, and the slash that JSON may escape.
BREAK = r"(?:(?:\r\n?|\n|(?:\\r)?\\n|\\r)[\x20\t]*+|\\(?=/))"
BREAKS = re.compile(BREAK)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
BASE64_LINES = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:{BREAK}[A-Za-z0-9+/_-]++)++(?:{BREAK})?={{0,2}}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]{24,}")
HEX_LINES = re.compile(rf"(?<![0-9A-Fa-f])[0-9A-Fa-f]++(?:{BREAK}[0-9A-Fa-f]++)++")
#: Readable UTF-8 of 12 characters or more: no secret, and no layer that holds one, is shorter.
STRETCH = re.compile(rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){12,}")
#: The same in UTF-16, of either byte order.
STRETCH_16 = ((re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){12,}"), "utf-16-le"), (re.compile(rb"(?:\x00[\t\n\r\x20-\x7e]){12,}"), "utf-16-be"))
STREAM = re.compile(rb"\x1f\x8b|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
#: Percent escapes among the characters that need none; runs without an escape are passed over.
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2}|[!-$&-~])++")
PERCENT_UNIT = re.compile(r"%[0-9A-Fa-f]{2}|.", re.DOTALL)
MOST, OVERLAP, CHUNK, ROWS = 1 << 22, 1 << 16, 1 << 20, 256
#: Bytes of a stream that are looked at first; raw deflate, which has no mark, must give something readable within them.
PROBE, PATIENCE = 1 << 10, 1 << 13


@dataclass
class Layer:
    """A text whose character i comes from [start[i], end[i]) of the original (None: itself), or, if whole is
    given, all of which comes from that interval."""

    text: str
    start: np.ndarray | None = None
    end: np.ndarray | None = None
    whole: tuple[int, int] | None = None

    def span(self, a: int, b: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        return (a, b) if self.start is None else (int(self.start[a:b].min()), int(self.end[a:b].max()))

    def part(self, text: str, lo: np.ndarray, hi: np.ndarray) -> Layer:
        """A layer of text whose character i comes from characters lo[i] to hi[i] (inclusive) of this one."""
        if self.whole:
            return Layer(text, whole=self.whole)
        return Layer(text, lo, hi + 1) if self.start is None else Layer(text, self.start[lo], self.end[hi])

    def place(self) -> bytes:
        first, last = self.whole or ((self.start[0], self.end[-1]) if self.start is not None and len(self.start) else (0, 0))
        return b"%d:%d" % (first, last)


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, in code points."""
    found = []
    lower = text.lower() if text.isascii() else text.encode().lower().decode()
    if any(h in lower for h in HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def readable(raw: bytes) -> str | None:
    """raw as text, if it is UTF-8 with hardly any control characters."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    odd = sum(not (c.isprintable() or c in "\t\n\r") for c in text)
    return text if text and odd * 20 <= len(text) else None


def stretches(raw: bytes) -> Iterator[tuple[int, str, np.ndarray]]:
    """Readable parts of raw: where each starts, its text, and the bytes of each character."""
    for h in STRETCH.finditer(raw):
        text = h.group().decode()
        yield h.start(), text, np.ones(len(text), np.int64) if text.isascii() else np.array([len(c.encode()) for c in text])
    if b"\x00" in raw:
        for pattern, charset in STRETCH_16:
            for h in pattern.finditer(raw):
                yield h.start(), h.group().decode(charset), np.full(len(h.group()) // 2, 2)


def inflated(raw: memoryview) -> Iterator[tuple[bytes, int]]:
    """Content of the compressed stream that raw begins with, all members or frames, in chunks; and how many bytes
    of raw were read by then. What comes before an error counts: streams may be cut."""
    head = bytes(raw[:6])
    if head[:4] == b"\x28\xb5\x2f\xfd":
        try:
            with zstandard.ZstdDecompressor(max_window_size=1 << 31).stream_reader(raw, read_across_frames=True) as stream:
                while chunk := stream.read(CHUNK):
                    yield chunk, len(raw)
        except zstandard.ZstdError:
            return
        return
    opener = bz2.BZ2Decompressor if head[:3] == b"BZh" else (lambda: lzma.LZMADecompressor(lzma.FORMAT_XZ)) if head == b"\xfd7zXZ\x00" else None
    at = 0
    while at < len(raw):
        head = bytes(raw[at : at + 6])
        if opener is None and not (head[:2] == b"\x1f\x8b" or head[:1] == b"\x78" and len(head) > 2 and (head[0] << 8 | head[1]) % 31 == 0) or opener and not STREAM.match(head):
            return
        end = None
        try:
            for chunk, used, _ in fed(opener() if opener else zlib.decompressobj(47), raw[at:], None if opener else PATIENCE):
                end = at + used
                yield chunk, end
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            return
        if end is None:
            return
        at = end
        while at < len(raw) and raw[at] == 0:
            at += 1


def fed(stream: Any, raw: memoryview, patience: int | None = None) -> Iterator[tuple[bytes, int, bool]]:
    """What a decompressor makes of raw, in chunks of bounded size; bytes of raw read by then; whether it is the end. Fed in
    slices that grow, so that a stream that ends or fails soon costs little, whatever comes after it. patience: bytes within which
    something must come out (a gzip header is no longer)."""
    at, step, any_ = 0, PROBE, False
    while not stream.eof:
        if at >= len(raw) or patience is not None and not any_ and at >= patience:
            return  # cut short, or none
        piece = raw[at : at + step]
        at, step = at + len(piece), min(2 * step, CHUNK)
        left = piece
        while True:
            chunk = stream.decompress(left, CHUNK)
            if stream.eof:
                yield chunk, at - len(stream.unused_data), True
                return
            left = stream.unconsumed_tail if hasattr(stream, "unconsumed_tail") else b""
            if chunk:
                any_ = True
                yield chunk, at, False
            if not left and (hasattr(stream, "unconsumed_tail") or stream.needs_input):
                break


def may_be_deflate(raw: memoryview) -> bool:
    """Whether bytes can begin a raw deflate stream: the kind of its first block, and the numbers that it begins with."""
    kind = raw[0] >> 1 & 3
    if kind == 0:
        return len(raw) > 4 and (raw[1] | raw[2] << 8) ^ 0xFFFF == (raw[3] | raw[4] << 8)
    if kind == 2:
        return len(raw) > 2 and (raw[0] >> 3) <= 29 and (raw[1] & 31) <= 29
    return kind == 1


def deflated(raw: memoryview, failed: set[bytes]) -> Iterator[tuple[bytes, int]]:
    """The same for raw deflate, which has no mark: only streams that end well count, and that give something readable
    within their first PROBE bytes. failed: such beginnings that are known to fail, which are not tried again."""
    if not len(raw) or not may_be_deflate(raw) or (start := bytes(raw[:PROBE])) in failed:
        return
    held, size, found, beyond = [], 0, False, False
    try:
        for chunk, used, over in fed(zlib.decompressobj(-15), raw):
            beyond = used > PROBE or len(raw) <= PROBE
            held.append((chunk, used))
            size += len(chunk)
            if not found:
                found = STRETCH.search(b"".join(c for c, _ in held)) is not None
                if not found and (over or beyond or size > CHUNK):
                    failed.add(start)
                    return
            if over or size > 4 * CHUNK:  # no chance: it is a stream, and may be long
                yield from held
                held = []
    except zlib.error:
        if not beyond:
            failed.add(start)


def windows(chunks: Iterator[tuple[bytes, int]], most: int) -> Iterator[tuple[list[str], int, int]]:
    """Readable texts of a stream's content, in windows of at most about `most` bytes that overlap; how many bytes
    were read by then; and the window's number. Each is followed by what it holds in windows of the next."""
    held, used, number = b"", 0, 0
    for chunk, used in chunks:
        held += chunk
        if len(held) >= most + OVERLAP:
            yield texts_in(held), used, number
            held, number = held[-OVERLAP:], number + 1
    if held:
        yield texts_in(held), used, number


def texts_in(raw: bytes) -> list[str]:
    text = readable(raw)
    return [t for _, t, _ in stretches(raw)] if text is None else [text]


def unescape(layer: Layer) -> Layer | None:
    """The layer with its escapes decoded in place; None if there are none."""
    parts, lows, highs, done = [], [], [], 0
    for m in ESCAPES.finditer(layer.text):
        run, pieces = m.group(), []
        if run in SHORT:
            pieces = [(SHORT[run], 0, len(run))]
        elif run[0] == "%" and run[1] != "u":
            raw = bytes.fromhex(run.replace("%", ""))
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                text = raw.decode("latin-1")
                pieces = [(c, 3 * i, 3 * i + 3) for i, c in enumerate(text)]
            else:
                at = 0
                for c in text:
                    width = 3 * len(c.encode())
                    pieces.append((c, at, at + width))
                    at += width
        elif run[0] == "&":
            pieces = [(c, 0, len(run)) for c in html.unescape(run)]
            if len(pieces) > 2:  # no known name
                continue
        else:
            units, i = [(int(u[6], 8) if u[6] else int(u[u.lastindex], 16), u.start(), u.end()) for u in UNIT.finditer(run)], 0
            while i < len(units):
                code, a, b = units[i]
                i += 1
                if 0xD800 <= code < 0xDC00 and i < len(units) and 0xDC00 <= units[i][0] < 0xE000:
                    low, _, b = units[i]
                    i += 1
                    code = 0x10000 + (code - 0xD800 << 10) + (low - 0xDC00)
                if code > 0x10FFFF or 0xD800 <= code < 0xE000:
                    code = 0xFFFD
                pieces.append((chr(code), a, b))
        plain = np.arange(done, m.start())
        parts += [layer.text[done : m.start()], "".join(c for c, _, _ in pieces)]
        lows += [plain, np.array([m.start() + a for _, a, _ in pieces], np.int64)]
        highs += [plain, np.array([m.start() + b - 1 for _, _, b in pieces], np.int64)]
        done = m.end()
    if not parts:
        return None
    rest = np.arange(done, len(layer.text))
    return layer.part("".join([*parts, layer.text[done:]]), np.concatenate([*lows, rest]), np.concatenate([*highs, rest]))


def printable(layer: Layer) -> Layer | None:
    """The layer with quoted-printable bytes decoded in place; None if there are none."""
    parts, lows, highs, done = [], [], [], 0
    for m in PRINTABLE.finditer(layer.text):
        run = m.group()
        cuts = [(u.start(), u.end()) for u in re.finditer(r"=[0-9A-F]{2}", run)]
        raw = bytes(int(run[a + 1 : b], 16) for a, b in cuts)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = raw.decode("latin-1")
        sizes = [1] * len(text) if len(text) == len(raw) else [len(c.encode()) for c in text]
        ends = np.cumsum(sizes) if sizes else np.zeros(0, np.int64)
        parts += [layer.text[done : m.start()], text]
        plain = np.arange(done, m.start())
        lows += [plain, np.array([m.start() + cuts[e - n][0] for e, n in zip(ends, sizes, strict=True)], np.int64)]
        highs += [plain, np.array([m.start() + cuts[e - 1][1] - 1 for e in ends], np.int64)]
        done = m.end()
    if not parts:
        return None
    rest = np.arange(done, len(layer.text))
    return layer.part("".join([*parts, layer.text[done:]]), np.concatenate([*lows, rest]), np.concatenate([*highs, rest]))


def decoded(chars: str, step: int) -> bytes:
    """Bytes of a run of base64 (step 3) or hex (step 1); what is too short for a byte at its end is left out."""
    if step == 1:
        return bytes.fromhex(chars[: len(chars) // 2 * 2])
    body = chars.translate({45: 43, 95: 47})
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def streams(layer: Layer, raw: bytes, low: Callable[[int], int], high: Callable[[int], int], most: int, marked: bool, bare: list[int]) -> Iterator[tuple[Layer, bool]]:
    """Layers from compressed streams in raw, whose byte j comes from characters low(j) to high(j) (inclusive) of the
    layer: those with a mark, and unmarked ones that start at the bytes `bare`. Whether it is a first window more of a large stream."""
    starts = [(h.start(), inflated) for h in STREAM.finditer(raw)] if marked else []
    failed: set[bytes] = set()
    for start, reader in starts + [(j, lambda part: deflated(part, failed)) for j in bare]:
        begin = low(start)
        for texts, used, number in windows(reader(memoryview(raw)[start:]), most):
            span = layer.span(begin, high(start + max(1, used) - 1) + 1)
            for i, text in enumerate(texts):
                yield Layer(text, whole=span), number == 1 and not i


def blobs(layer: Layer, most: int) -> tuple[list[Layer], int]:
    """Layers from what runs hold of readable or compressed content; and how many streams took several windows."""
    found, windowed, text = [], 0, layer.text
    for lines, pattern, width, step in ((BASE64_LINES, BASE64, 4, 3), (HEX_LINES, HEX_RUN, 2, 1)):
        runs = [m for m in lines.finditer(text)] if "\n" in text or "\r" in text or "\\" in text else []
        for m in [*runs, *pattern.finditer(text)]:
            run = m.group().rstrip("=")
            chars = BREAKS.sub("", run)
            if len(chars) < 4 * width or not chars.strip(chars[0]):
                continue
            at = np.arange(m.start(), m.start() + len(run))
            if len(chars) < len(run):
                gone = np.zeros(len(run), bool)
                for g in BREAKS.finditer(run):
                    gone[g.start() : g.end()] = True
                at = at[~gone]
            cuts = [0, *(g.end() for g in re.finditer("[/_-](?![/_-])", chars))] if step == 3 else [0]
            for phase in range(width):
                raw = decoded(chars[phase:], step)
                low = lambda j: int(at[phase + j // step * width + j % step])  # noqa: B023, E731
                high = lambda j: m.end() - 1 if j == len(raw) - 1 else int(at[phase + j // step * width + (j % step + 1 if step == 3 else 1)])  # noqa: B023, E731
                bare = [j for c in cuts if c >= phase and (c - phase) % width == 0 and (j := (c - phase) // width * step) < len(raw)]
                for new, again in streams(layer, raw, low, high, most, True, bare):
                    found.append(new)
                    windowed += again
                whole = readable(raw) if phase == 0 else None
                for start, new, sizes in [(0, whole, np.array([len(c.encode()) for c in whole]))] if whole is not None else stretches(raw):
                    last = start + np.cumsum(sizes) - 1
                    first = last - sizes + 1
                    lo = phase + (first // step) * width + first % step
                    hi = phase + (last // step) * width + ((last % step) + 1 if step == 3 else 1)
                    found.append(layer.part(new, at[lo], at[np.minimum(hi, len(at) - 1)]))
    if "%" in text:
        for m in PERCENT.finditer(text):
            if "%" not in m.group():
                continue
            units = [u.span() for u in PERCENT_UNIT.finditer(m.group())]
            raw = b"".join(bytes([int(m.group()[a + 1 : b], 16)]) if b - a == 3 else m.group()[a:b].encode() for a, b in units)
            bare = [j for j, (a, b) in enumerate(units) if b - a == 3 and (not j or units[j - 1][1] - units[j - 1][0] == 1)]
            for new, again in streams(layer, raw, lambda j: m.start() + units[j][0], lambda j: m.start() + units[j][1] - 1, most, True, bare):  # noqa: B023
                found.append(new)
                windowed += again
            if b"\x00" in raw:
                for start, new, sizes in stretches(raw):
                    places = start + np.cumsum(sizes) - 1
                    ends = np.array(units)
                    found.append(layer.part(new, m.start() + ends[places - sizes + 1, 0], m.start() + ends[places, 1] - 1))
    return found, windowed


def spans_of(text: str, most: int = MOST) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """Base spans, all spans (both ordered by start, then kind), and how many streams were read in windows."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = sorted(scan(text), key=order)
    every, seen, work, windowed = set(base), {hashlib.sha256(text.encode()).digest()}, [Layer(text)], 0
    while work:
        layer = work.pop()
        inner, large = blobs(layer, most)
        windowed += large
        inner += [plain for plain in (unescape(layer), printable(layer)) if plain is not None]
        for new in inner:
            # the same content at another place is another layer: its spans differ
            digest = hashlib.sha256(new.place() + b"/" + new.text.encode("utf-8", "surrogatepass")).digest()
            if digest in seen:
                continue
            seen.add(digest)
            every.update((kind, *new.span(a, b)) for kind, a, b in scan(new.text))
            work.append(new)
    return base, sorted(every, key=order), windowed


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """One row per document: id_col, base_spans and spans (array<struct<kind,start,end>>), n_windowed."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = [spans_of(t or "", most) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([listed(r[0]) for r in rows], kind), pa.array([listed(r[1]) for r in rows], kind), pa.array([r[2] for r in rows], pa.int64())], ["id", "base_spans", "spans", "n_windowed"])

    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = map_arrow(rows, run, f"id {docs.schema[id_col].dataType.simpleString()}, base_spans {span}, spans {span}, n_windowed long")
    return out.withColumnRenamed("id", id_col)


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each stretch of overlapping spans becomes one mark with the kind of its first span."""
    out, done = [], 0
    for kind, a, b in spans:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text_col: str = "text", most: int = MOST) -> DataFrame:
    """docs with every span in its text replaced by a mark; null stays null."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                columns = list(part.columns)
                columns[at] = pa.array([t if t is None else redact_text(t, spans_of(t, most)[1]) for t in part.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return map_arrow(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
