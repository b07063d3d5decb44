"""WARC archives: writing pages as records, and a reader that salvages damaged archives.

Writing. The response of a payload is the page with the smallest id that has it; pages with equal payloads revisit it
and hold no payload. Payloads are compared by digest, in one aggregate; the choice then meets the pages by a broadcast, if
few payloads repeat, or by one shuffle. Every record is a gzip member of its own. Archives are files written by Spark's
text writer in the shared folder: a row is a block of members without its last byte, which is zero (the top byte of a
member's size; a larger member is followed by an empty one) and is the line separator. A file holds about
BLOCK * BLOCKS bytes, so readers take archives whole.

Reading. read() takes archives as files of any kind: a member for each record, one member for many, or plain records.
Every record is checked: version line, header block, length, the blank lines after it, block digest, and payload digest
where the block is HTTP; a member also by its checksum. At a failed check the reader goes on at the next gzip mark (in plain archives: the next version
line) from which a record passes all checks, and logs what it passed over as a quarantined gap: from and to which byte,
and why. Of a member that is damaged, records complete before the damage count.

Defined results: a null payload is the empty one; pages that repeat the id and the payload of a response are responses
too; a null id is larger than any other, and is written as none; URLs are percent-escaped where a header line can't hold
them, and a null URL is written as the record's own name; texts of any length are one record and held whole by a task; an
empty table gives no archives and no rows; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import bounded, discard, map_arrow, materialize, shared_folder

VERSION, DATE = b"WARC/1.1", "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Compressed bytes of a block, and blocks of a file.
BLOCK, BLOCKS = 1 << 22, 8
LEVEL = 1
#: A header block is no longer.
HEADER = 1 << 16
MARK = b"\x1f\x8b\x08"
VERSION_LINE = re.compile(rb"WARC/[01]\.[0-9]{1,2}\r?\n")
BLANK = re.compile(rb"\r?\n\r?\n")
#: Bytes of an archive that are decompressed at once, at first and at most. A member gives something within the first.
CHUNK, MOST = 1 << 13, 1 << 20


def digest(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def name_of(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, payload_bytes: int, payload_digest: str) -> bytes:
    """One record, uncompressed. A revisit has the HTTP head of the response, and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = head if revisit else head + payload
    target = name_of(page_id) if url is None else quote(url, safe="!#$&'()*+,/:;=?@[]%-._~")
    lines = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{name_of(page_id)}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{name_of(refers_to)}>"]
    lines.append(f"Content-Length: {len(block)}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = LEVEL) -> bytes:
    """raw as a gzip member; followed by an empty one if its last byte isn't zero."""
    out = b""
    for part in (raw, b""):
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        out += packer.compress(part) + packer.flush()
        if out[-1] == 0:
            return out
    return out


class Salvage:
    """Records and quarantined gaps of one archive. A record: (offset, headers, block)."""

    def __init__(self, raw: bytes) -> None:
        self.raw, self.gaps, self._plain = raw, [], Plain(raw)
        self._marks, self._lines = -1, -1

    def records(self) -> Iterator[tuple[int, dict[str, str], bytes]]:
        raw, at, lost, why = self.raw, 0, None, ""
        while at < len(raw):
            if raw.startswith(MARK, at):
                found, end, reason = self._member(at)
            else:
                one, end, reason = self._plain.record(at)
                found = [(at, *one)] if one else []
            if end is not None and lost is not None:
                self.gaps.append((lost, at, why))
                lost = None
            elif end is None and lost is None:
                lost, why = at, reason
            yield from found  # of a damaged member: what was complete before the damage
            at = self._next(at + 1) if end is None else end
        if lost is not None:
            self.gaps.append((lost, len(raw), why))

    def _next(self, at: int) -> int:
        """The next place where a member or a record may begin. Each kind is looked for once for all places before it."""
        if self._marks < at:
            found = self.raw.find(MARK, at)
            self._marks = len(self.raw) if found < 0 else found
        if self._lines < at:
            hit = VERSION_LINE.search(self.raw, at)
            self._lines = hit.start() if hit else len(self.raw)
        return min(self._marks, self._lines)

    def _member(self, at: int) -> tuple[list[tuple[int, dict[str, str], bytes]], int | None, str]:
        """Records of the member at a place, and where it ends; if it is damaged: None, and why."""
        stream, parts, view = zlib.decompressobj(31), [], memoryview(self.raw)
        reason, used, step, seen = "", at, CHUNK, b""
        try:
            while not stream.eof:
                if used >= len(view):
                    reason = "cut short"
                    break
                if not seen and used - at >= CHUNK:
                    return [], None, "a member's header without an end"
                fed = view[used : used + step]
                parts.append(stream.decompress(fed))
                used, step = used + len(fed), min(2 * step, MOST)
                if len(seen) < 12:
                    seen = b"".join(parts)
                    if not seen:
                        continue
                    if not VERSION_LINE.match(seen) and (len(seen) >= 12 or not any(v.startswith(seen[:7]) for v in (b"WARC/0.", b"WARC/1."))):
                        return [], None, "a member without a record"
        except zlib.error as error:
            reason = f"damaged member: {error}"
        text = b"".join(parts)
        found, inner, known = [], 0, Plain(text)
        end = None if reason else used - len(stream.unused_data)
        while inner < len(text):
            one, stop, problem = known.record(inner)
            if one:
                found.append((at, *one))
                inner = stop
                continue
            if end is not None:  # the member is whole, its content isn't
                self.gaps.append((at, end, problem))
            hit = VERSION_LINE.search(text, inner + 1)
            inner = hit.start() if hit else len(text)
        while end is not None and self.raw[end : end + 1] == b"\x00":  # padding
            end += 1
        return found, end, reason


class Plain:
    """Checked records of uncompressed bytes."""

    def __init__(self, raw: bytes) -> None:
        self.raw, self.blank = raw, (-1, -1, -1)

    def _end_of_header(self, at: int) -> tuple[int, int] | None:
        """Where the first blank line from a place begins and ends; looked for once for all places before it."""
        since, a, b = self.blank
        if not since <= at <= a or since < 0:
            hit = BLANK.search(self.raw, at)
            a, b = hit.span() if hit else (len(self.raw), len(self.raw))
            self.blank = (at, a, b)
        return (a, b) if b > a and a - at <= HEADER else None

    def record(self, at: int) -> tuple[tuple[dict[str, str], bytes] | None, int | None, str]:
        raw = self.raw
        line = VERSION_LINE.match(raw, at)
        if not line:
            return None, None, "no version line"
        span = self._end_of_header(line.end() - 1)
        if not span:
            return None, None, "no end of the header"
        headers: dict[str, str] = {}
        name = ""
        for row in raw[line.end() : span[0]].decode("utf-8", "replace").split("\n"):
            if row[:1] in (" ", "\t") and name:  # goes on
                headers[name] += " " + row.strip()
                continue
            name, colon, value = row.partition(":")
            if not colon:
                return None, None, "a header line without a colon"
            name = name.strip().lower()
            headers[name] = value.strip()
        size = headers.get("content-length", "")
        if not (size.isascii() and size.isdigit()) or "warc-type" not in headers or "warc-record-id" not in headers:
            return None, None, "a header lacks"
        stop = span[1] + int(size)
        if stop > len(raw):
            return None, None, "cut short"
        after = BLANK.match(raw, stop)
        if not after:
            return None, None, "no blank lines after the block"
        block = raw[span[1] : stop]
        said = headers.get("warc-block-digest", "")
        if said.startswith("sha1:") and said[5:].upper() != digest(block):
            return None, None, "another block digest"
        said = headers.get("warc-payload-digest", "")
        if said.startswith("sha1:") and headers["warc-type"] == "response" and headers.get("content-type", "").startswith("application/http") and said[5:].upper() != digest(payload_of(block)):
            return None, None, "another payload digest"
        return (headers, block), after.end(), ""


def payload_of(block: bytes) -> bytes:
    """What follows the head of an HTTP message."""
    head = BLANK.search(block)
    return block[head.end() :] if head else b""


KEY = ("n_bytes", "digest", "check")


def keyed(pages: DataFrame, id_col: str, payload_col: str, *more: Column) -> DataFrame:
    """id, further columns, payload and what tells payloads apart: length, SHA-1 and another hash."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    return pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), *more, payload.alias("payload")).select("*", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha1("payload").alias("digest"), F.xxhash64("payload").alias("check"))


def chosen(pages: DataFrame, least: int = 0, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """KEY and first: the smallest id of each payload of at least `least` bytes that several pages have."""
    groups = keyed(pages, id_col, payload_col).where(F.col("n_bytes") >= least).groupBy(*KEY).agg(F.min("id").alias("first"), F.count("*").alias("n"))
    return groups.where("n > 1").drop("n")


def write(pages: DataFrame, path: str, least: int = 0, id_col: str = "page_id", url_col: str | None = "url", payload_col: str = "html", level: int = LEVEL) -> None:
    """Archives of all pages in a new folder. Payloads of fewer than `least` bytes are never revisited."""
    first = materialize(chosen(pages, least, id_col, payload_col), "payloads")
    url = F.col(f"`{url_col}`").cast("string") if url_col else F.lit(None).cast("string")
    rows = keyed(pages, id_col, payload_col, url.alias("url")).join(bounded(first), list(KEY), "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    rows = rows.select("id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "n_bytes", F.unhex("digest").alias("digest"), F.when(revisit, F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            raw = b"".join(held)[:-1]
            # a string column is what the text writer takes; it writes the bytes as they are
            return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, len(raw)], np.int32)), pa.py_buffer(raw)])], ["value"])

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, n, sha, refers = (batch.column(k)[i].as_py() for k in range(6))
                revisit = payload is None
                held.append(member(record(page, url, payload or b"", refers, revisit, n, base64.b32encode(sha).decode()), level))
                size += len(held[-1])
                if size >= BLOCK:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    map_arrow(rows, run, "value string").write.option("lineSep", "\x00").option("maxRecordsPerFile", BLOCKS).text(path)
    discard(first)


RECORD = "archive string, `offset` long, type string, record_id string, target_uri string, payload_digest string, payload_bytes long, refers_to string, payload binary, gap_end long, reason string"


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record of all archives below path (RECORD), and one with a reason for each quarantined gap.
    payload_bytes of a revisit is what the head of its response says. payloads: whether to give them back."""
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary()), ("gap_end", pa.int64()), ("reason", pa.string())])

    def row(archive: str, offset: int, headers: dict[str, str], block: bytes) -> dict:
        http = headers.get("content-type", "").startswith("application/http")
        payload = payload_of(block) if http else block
        size = len(payload)
        if headers["warc-type"] == "revisit":
            said = re.search(rb"(?im)^content-length:[\x20\t]*([0-9]+)", block)
            size = int(said[1]) if said else None
        bare = lambda k: headers[k].strip("<>") if k in headers else None
        said = headers.get("warc-payload-digest", "").removeprefix("sha1:").upper()
        return {"archive": archive, "offset": offset, "type": headers["warc-type"], "record_id": bare("warc-record-id"), "target_uri": headers.get("warc-target-uri"), "payload_digest": said or digest(payload), "payload_bytes": size, "refers_to": bare("warc-refers-to"), "payload": payload if payloads else None, "gap_end": None, "reason": None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive, held, size = batch.column(0)[i].as_py(), [], 0
                reader = Salvage(batch.column(1)[i].as_py())
                for one in reader.records():
                    held.append(row(archive, *one))
                    size += len(one[2])
                    if size >= BLOCK or len(held) == 2048:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                held += [dict.fromkeys(schema.names) | {"archive": archive, "offset": a, "gap_end": b, "reason": why} for a, b, why in reader.gaps]
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("path", "content")
    return map_arrow(files, run, RECORD)


def archived(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str | None = "url", payload_col: str = "html") -> DataFrame:
    """Pages, written as archives in the shared folder and read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path, least, id_col, url_col, payload_col)
    number = lambda c: F.when(F.col(c) != "urn:page:none", F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1)).cast("long")
    found = read(spark, path, payloads=False)
    lost = F.raise_error(F.concat(F.lit("an archive of our own is damaged: "), "reason"))
    checked = lambda c: F.when(F.col("reason").isNull(), c).otherwise(lost)
    return found.select(checked(number("record_id")).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), number("refers_to").alias("refers_to"))


def oracle() -> str:
    """The same rows from SQL: base 32 takes five bits at a time, four characters for five hex digits."""
    letters = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(floor(g / {d}) AS BIGINT) % 32, 1)"
    four = " || ".join(letters.format(d=32**k) for k in (3, 2, 1, 0))
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS least FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, array_to_string(list_transform([0, 1, 2, 3, 4, 5, 6, 7], lambda i: list_transform([CAST('0x' || substr(h, 1 + 5 * i, 5) AS BIGINT)], lambda g: {four})[1]), '') AS payload_digest,
    CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> least THEN least END AS refers_to FROM d"""
