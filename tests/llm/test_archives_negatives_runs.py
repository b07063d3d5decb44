"""WARC archives, hard negatives and periodic runs against brute force and round trips; edge cases."""

import base64
import gzip
import hashlib
import random
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabulark.llm import negatives, queries, runs, warc

# runs


def brute_runs(words, least=12):
    found, n = set(), len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q) and not any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                found.add((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_by_brute_force():
    rng = random.Random(5)
    for _ in range(1200):
        k, n = rng.choice([1, 2, 2, 3, 5, 40]), rng.randrange(90)
        words = [b"%d" % rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.6 and n:
            unit = words[: rng.randrange(1, 20)]
            words = words[: rng.randrange(n)] + unit * rng.randrange(1, 6) + words[rng.randrange(n) :]
        for least in (12, 4, 2):
            assert runs.runs_of(words, least) == brute_runs(words, least)
        assert sorted(runs.runs_of_stretch(list(map(int, words)), 2)) == sorted(brute_runs(words, 2))


def test_last_ends_by_definition():
    """A part of a path that is coloured by an end holds the states whose factors ended there last."""
    rng = random.Random(6)
    text = [rng.randrange(2) for _ in range(200)]
    automaton = runs.Automaton()
    states = [automaton.append(c) for c in text]
    ends = runs.LastEnds(automaton.link)
    for i, state in enumerate(states):
        parts = ends.access(state, i)
        assert [e for e, _ in parts] == sorted({e for e, _ in parts})  # nearer ends are higher up
        for before, deepest in parts:
            common = 0
            while common <= before and text[before - common] == text[i - common]:
                common += 1
            assert automaton.len[deepest] == common


def test_runs_of_long_texts():
    rng = random.Random(7)
    unit = [b"%d" % rng.randrange(5000) for _ in range(5000)]
    for words, want in ((unit * 8, [(0, 40000, 5000)]), ([b"a"] * 40000, [(0, 40000, 1)]), ([b"%d" % i for i in range(40000)], [])):
        began = time.process_time()
        assert runs.runs_of(words) == want and time.process_time() - began < 20
    assert runs.collapsed(unit * 8, [(0, 40000, 5000)]) == unit


def test_runs_query(spark, tmp_path):
    plain = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [*map(tuple, plain), (None, "x " * 30), (500_001, None), (500_002, ""), (500_003, " \n"), (20, "a b c " * 9), (20, "a b c " * 9), (21, "one two"), (500_004, "Ünï wörd " * 40_000)]
    spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, runs int, best string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for doc, text in rows:
        words = (text or "").encode().split()
        h, n = None if doc is None else zlib.crc32(str(doc).encode()), len(words)
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute_runs(words) if n < 700 else runs.runs_of(words)
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        s, length, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        digest = lambda t: hashlib.sha256(t).hexdigest()
        want.append((doc, len(found), s, length, q, found and 1000 * length // q or None, digest("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()), digest(b" ".join(w for i, w in enumerate(words) if i not in gone))))
    got = Counter(map(tuple, queries.op13_periodic_runs(spark, str(tmp_path)).collect()))
    assert got == Counter(want) and sum(w[1] for w in want) > 15
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert runs.digest(runs.find(runs.planted(empty))).count() == 0


# archives


def archive(n=20):
    rng = random.Random(n)
    bodies = [rng.randbytes(rng.randrange(400)) for _ in range(n)]
    return bodies, [warc.record(i, f"http://h/{i}", b, None, False, len(b), warc.digest(b)) for i, b in enumerate(bodies)]


def found_in(raw):
    reader = warc.Salvage(raw)
    return [(h["warc-record-id"], warc.payload_of(b)) for _, h, b in reader.records()], reader.gaps


def names(bodies, but=()):
    return [(f"<urn:page:{i}>", b) for i, b in enumerate(bodies) if i not in but]


def test_archives_of_every_kind():
    bodies, records = archive()
    for raw in (b"".join(map(warc.member, records)), b"".join(records), gzip.compress(b"".join(records)), b"".join(gzip.compress(r) for r in records), warc.member(records[0]) + b"".join(records[1:])):
        assert found_in(raw) == (names(bodies), [])
    assert found_in(b"") == ([], []) and found_in(b"no archive") == ([], [(0, 10, "no version line")])
    large = warc.record(1, None, b"x" * (1 << 24), None, False, 1 << 24, warc.digest(b"x" * (1 << 24)))
    packed = warc.member(large)
    assert packed[-1] == 0 and len(found_in(packed + warc.member(records[3]))[0]) == 2


def test_salvage():
    bodies, records = archive()
    members = [warc.member(r) for r in records]
    starts = np.cumsum([0, *map(len, members)])
    whole = b"".join(members)
    for at in range(5, 12):  # a byte changed within one member: that one is lost, and logged from its start to the next
        broken = bytearray(whole)
        broken[starts[7] + at * (len(members[7]) - 1) // 12] ^= 0x55
        found, gaps = found_in(bytes(broken))
        assert found == names(bodies, {7}) and [(a, b) for a, b, _ in gaps] == [(starts[7], starts[8])]
    cut = whole[: starts[12] + 30] + whole[starts[13] :]
    found, gaps = found_in(cut)
    assert found == names(bodies, {12}) and gaps[0][:2] == (starts[12], starts[12] + 30)
    found, gaps = found_in(b"junk" + whole[: starts[19] + 40])
    assert found == names(bodies, {19}) and [g[:2] for g in gaps] == [(0, 4), (4 + starts[19], 4 + starts[19] + 40)]
    # plain archives, one member for many, and payloads that look like records
    begins = np.cumsum([0, *map(len, records)])
    plain = bytearray(b"".join(records))
    plain[begins[4] + len(records[4]) - 6] ^= 1
    found, gaps = found_in(bytes(plain))
    assert found == names(bodies, {4}) and gaps == [(begins[4], begins[5], "another block digest")]
    one = gzip.compress(bytes(plain))
    found, gaps = found_in(one)
    assert found == names(bodies, {4}) and gaps == [(0, len(one), "another block digest")]
    short = gzip.compress(b"".join(records))
    found, gaps = found_in(short[: len(short) * 2 // 3] + members[3])
    assert found[:8] == names(bodies)[:8] and found[-1] == names(bodies)[3] and len(gaps) == 1
    nested = warc.record(5, None, records[1] + members[2], None, False, len(records[1] + members[2]), warc.digest(records[1] + members[2]))
    assert found_in(nested + records[3])[0] == [("<urn:page:5>", records[1] + members[2]), names(bodies)[3]]
    folded = records[0].replace(b"WARC-Date:", b"WARC-X: a\r\n b\r\nWARC-Date:")
    assert found_in(folded) == (names(bodies)[:1], [])


def test_salvage_is_linear():
    spent = []
    for n in (20_000, 80_000):
        began = time.process_time()
        for junk in (b"WARC/1.1\r\n" * n, b"\x1f\x8b\x08" * n, b"WARC/1.1\r\nContent-Length: 5\r\n\r\n" * (n // 4), b"\x1f\x8b\x08\x00" * n):
            found_in(junk)
        spent.append(time.process_time() - began)
    assert spent[1] < 12 * spent[0] + 2


def test_warc_query(spark, tmp_path):
    rows = [(3, "http://a/b c\r\nX: y", "<p>é</p>"), (1, None, "same"), (9, "u", "same"), (2, "u", "same"), (None, "u", "same"), (None, None, "alone"), (4, "u", None), (5, "u", ""), (5, "u", ""), (1, "v", "same"), (8, "http://ü", "big " * 400_000), (7, "u", "WARC/1.1\r\n\r\n\x1f\x8b")]
    rows += [(100 + i, f"u{i}", f"page {i % 300} " * 30) for i in range(900)]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, digest string, n_bytes int")
    df.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = Counter(map(tuple, queries.op11_warc(spark, str(tmp_path)).collect()))
    least = {}
    for p, _, h in rows:
        least.setdefault(h or "", []).append(p)
    want = Counter()
    for p, _, h in rows:
        raw = (h or "").encode()
        first = min((x for x in least[h or ""] if x is not None), default=None)
        same = p == first
        want[(p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if same else "revisit", None if same else first)] += 1
    assert got == want
    few = warc.archived(df, least=5).where("page_id IN (9, 5) OR page_id = 500").collect()
    assert {(r["page_id"], r["record_type"]) for r in few} == {(9, "response"), (5, "response"), (500, "revisit")}
    path = f"file://{tmp_path}/archives"
    warc.write(df, path)
    told = {r["record_id"]: r for r in warc.read(spark, path).where("type = 'response'").collect()}
    assert told["urn:page:3"]["target_uri"] == "http://a/b%20c%0D%0AX:%20y" and told["urn:page:8"]["payload"].decode() == rows[10][2]
    assert {r["target_uri"] for r in warc.read(spark, path).where("record_id = 'urn:page:1'").collect()} == {"urn:page:1", "v"}
    for file in (tmp_path / "archives").glob("part-*"):
        file.chmod(0o644)
        raw = bytearray(file.read_bytes())
        raw[len(raw) // 2] ^= 0xFF
        file.write_bytes(raw)
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    damaged = warc.read(spark, path)
    assert damaged.where("reason IS NOT NULL").count() >= 1 and len(rows) - 4 <= damaged.where("reason IS NULL").count() < len(rows)
    assert warc.archived(df.limit(0)).count() == 0


# negatives


def brute_negatives(rows, positives=5, negatives_=10):
    def floor(x):
        y = x * 256
        return int(y // 1)

    kept = [(i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [floor(x) for x in v]) for i, label, v in rows if label is not None and v is not None and all(x is not None and abs(x) < float("inf") for x in v)]
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, (anchor, label, v) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        score = [(sum(x * y for x, y in zip(v, w, strict=False)), i, m) for i, m, w in kept]
        own = sorted(((s, i) for k, (s, i, m) in enumerate(score) if k != a and m == label), key=key)[:positives]
        for p, pi in own:
            others = sorted(((s, i) for s, i, m in score if m != label and 30 * p <= 100 * s <= 90 * p), key=key)[:negatives_]
            out += [(anchor, pi, rank, i, p, s) for rank, (s, i) in enumerate(others, 1)]
    return Counter(out)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, label int, embedding array<float>, uid int").repartition(3)
    return Counter(map(tuple, negatives.mine(df, F.col("id") % 100 == 0, label=negatives.shifted()).collect()))


def test_negatives_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 6))
    rows = [(i, int(i % 4), np.float32(centres[i % 4] + rng.normal(size=6) * 0.7).tolist()) for i in range(0, 900)]
    rows = [(i * 20 if i < 60 else i + 5000, m, v) for i, m, v in rows]
    odd = [(700, 1, None), (800, None, [1.0] * 6), (900, 2, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1000, 2, [float("nan")] * 6), (1100, 2, [float("inf")] * 6), (1200, 2, []), (1300, 0, [0.5, 0.25]), (None, 1, [0.5] * 6), (None, 2, [0.5] * 6), (1400, 1, [0.0] * 6), (7, 3, [-0.001] * 6), (100, 3, [3.0] * 6), (100, 3, [3.0] * 6), (9999, 9, [1.0] * 6)]
    ties = [(20_000 + i, i % 3, [1.0, 0.5, 0.5, 0.0, 0.0, 0.0]) for i in range(60)]
    monkeypatch.setattr(negatives, "BLOCK", 50)
    monkeypatch.setattr(negatives, "PACK", 7)
    monkeypatch.setattr(negatives, "GROUP", 2)
    want = brute_negatives(rows + odd + ties)
    assert mined(spark, rows + odd + ties) == want and sum(want.values()) > 500
    huge = rows[:120] + [(200, 1, [3e37] * 6), (8001, 1, [2e5] * 6), (8002, 2, [1e5] * 6), (8003, 2, [-3e37] * 6)]
    top = np.iinfo(np.int64).max
    got = {(a, n): (p, s) for a, _, _, n, p, s in mined(spark, huge)}
    want = brute_negatives(huge)
    assert {k[:4] for k in want if k[4] <= top} <= {(a, p, r, n) for a, p, r, n, *_ in mined(spark, huge)} and got
    assert mined(spark, []) == Counter()


def test_bounds_hold_and_spare_scores():
    rng = np.random.default_rng(5)
    base = rng.integers(-200, 200, (3, 32))
    points = np.concatenate([b + rng.integers(-6, 6, (60, 32)) for b in base]).astype(np.float64)
    order, parent, edge = negatives.spanning_tree(points)
    assert sorted(order) == list(range(180)) and (parent[order[1:]] >= 0).all() and all(list(order).index(parent[i]) < list(order).index(i) for i in order[1:])
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    assert np.allclose(edge[order[1:]], [gaps[i, parent[i]] for i in order[1:]])
    row = {"uid": np.arange(180).tobytes(), "anchor": np.arange(180).tobytes(), "label": np.zeros(180, np.int64).tobytes(), "q": points.tobytes(), "order": order.tobytes(), "parent": parent.tobytes(), "edge": edge.tobytes()}
    pack = negatives.Pack(row)
    others = rng.integers(-200, 200, (2000, 32)).astype(np.float64)
    scores = (points @ others.T).astype(np.int64)
    lists = [negatives.Lists([(int(np.sort(s)[-20]), int(s.max()))], 5) for s in scores]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(1000, 3000)), pa.array(np.arange(2000)), pa.array(np.ones(2000, np.int64)), pa.array(others.tolist(), pa.list_(pa.float64()))], ["uid", "id", "label", "q"])
    scored = negatives.walk(pack, negatives.Rows(batch, 32), lists, False)
    for s, found in zip(scores, lists, strict=True):
        assert found.lists[0][1].tolist() == sorted(range(2000), key=lambda i: (-s[i], i))[:5]
    assert scored < 0.5 * 179 * 2000  # most are never scored


def test_negatives_query_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    want = connection.execute(negatives.oracle())
    columns = [c[0] for c in want.description]
    got = queries.op12_hard_negatives(spark, "/root/testdata/sf0.001")
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(want.fetchall())


@pytest.mark.parametrize("name", ["op11_warc", "op12_hard_negatives", "op13_periodic_runs"])
def test_new_queries_on_empty_tables(spark, tmp_path, name):
    for table, schema in (("pages", "page_id long, url string, html string"), ("embeddings", "vec_id long, embedding array<float>, label int"), ("documents", "doc_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.queries()[name](spark, str(tmp_path)).count() == 0
