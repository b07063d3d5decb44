"""Operators for training text against brute force, round trips and held-out results; edge cases."""

import base64
import bz2
import gzip
import hashlib
import json
import lzma
import quopri
import random
import time
import zlib
from collections import Counter, defaultdict
from math import log10
from urllib.parse import quote

import corpus_pipeline
import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
import xxhash
import zstandard
from pyspark.sql import functions as F

from tabulark.llm import bpe, chat, copies, fingerprints, lm, mixing, quality, queries, secrets, sharding, simhash, toxicity

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"
ODD = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, None), (3, " \n\t", "en", "b", 3, "id"), (4, "one two", "en", "a", 7, "fp"), (5, "one two", "en", None, 7, "key"), (5, "one two", "en", None, 7, "key"), (None, "word " * 300, "de", "c", 1500, "u"), (9, "é世😀 x" * 4000, "fr", "c", 20000, "v"), (10, "Ones " * 60 + "the end", "en", "b", 307, "word")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()]


def words(text):
    return (text or "").encode().lower().split()


def test_bpe_equals_the_library(documents):
    own = bpe.ByteBpe(bpe.vocabulary_path())
    library = tiktoken.Encoding("own", pat_str=__import__("public_tokenizers").PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng, letters = random.Random(1), " '\n\t  abstremvld'''12é世!?. ßАя 😀\x1cᲉ\u3000\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)] + [d[1] for d in documents] + ["", "a" * 3000, " " * 999, "ab1" * 999, "'s" * 99, "don't  I'll\n\n x "]
    for window, some in ((bpe.WINDOW, texts), (7, texts[:1500]), (50, texts[:600] + texts[-10:]), (777, texts[2900:3100])):
        for text, (offsets, ids, places) in zip(some, own.encode_batch(some, window), strict=True):
            assert ids.tolist() == library.encode_ordinary(text)
            assert b"".join(own.decoded(ids, offsets, places, window)) == text.encode() and offsets[-1] == len(text)
            if text:
                start = rng.randrange(len(text))
                end = rng.randrange(start, len(text))
                at, raw = own.decode_stretch(ids, offsets, places, start, end)
                assert at <= start and text[at:].startswith(raw.decode()) and at + len(raw.decode()) >= end
    small = bpe.Merged(own.ranks, 5000)  # a cache that overflows all the time
    slices = [f" w{i}".encode() for i in range(400)]
    assert small.of(slices) == bpe.Merged(own.ranks).of(slices) and small.held <= 5000
    assert all(x == y for x, y in zip(small.of(slices[:20]), bpe.Merged(own.ranks).of(slices[:20]), strict=True))


def brute_components(fps, ids):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(fps)):
        if ids[i] is not None:
            least[find(i)].append(ids[i])
    return [min(least[find(i)], default=None) for i in range(len(fps))]


def brute_fingerprint(text, width=3):
    w = [x.decode() for x in words(text)]
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_by_brute_force(spark, odd, documents):
    some = [(d[0], d[1]) for d in documents[:150]] + [(1000 + i, documents[i][1] + " more") for i in range(40)]
    for rows in (some, [(r[0], r[1]) for r in ODD]):
        fps = [brute_fingerprint(t) for _, t in rows]
        want = Counter(zip([r[0] for r in rows], [f"{f:016x}" for f in fps], brute_components(fps, [r[0] for r in rows]), strict=True))
        assert Counter(map(tuple, simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == want
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_simhash_long_runs():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**64, 5, np.uint64)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 60, np.uint64)) for c in centres] + [centres]))
    a, b = simhash.run_stars(fps, simhash.distances(fps, simhash.pivots(32)[1]), 3)
    assert len(a) == len(fps) - len(set(brute_components([int(x) for x in fps], range(len(fps)))))
    i, j = np.where(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3, 1))
    keys = simhash.bucket_keys(fps)
    assert keys.shape[1] == 20 and len(np.unique(keys >> 33)) == 20
    assert len(i) and (keys[i] == keys[j]).any(axis=1).all()


def test_secret_layers():
    key = "AKIA" + "Z9" * 8
    assigned = "password=abcdefgh1234"
    for wrap in (quote, lambda s: "".join(f"\\u{ord(c):04x}" for c in s), lambda s: base64.b64encode(s.encode()).decode(), lambda s: base64.b64encode(gzip.compress(s.encode())).decode(), lambda s: zlib.compress(s.encode()).hex(), lambda s: quote(base64.b64encode(base64.b64encode(s.encode())).decode(), safe=""), lambda s: quote(quote(s, safe=""), safe="")):
        text = f"before {wrap(f'x {key} {assigned} y')} after"
        base, every, _ = secrets.spans_of(text)
        found = {k for k, a, b in every if a >= 6 and b <= len(text) - 6}
        assert {"access", "assign"} <= found, wrap
        assert key not in secrets.redact_text(text, every) and set(base) <= set(every)
    text = f"é {quote('é' + assigned, safe='')}"
    at = text.index("password")
    assert ("assign", at, len(text)) in secrets.spans_of(text)[1]
    assert secrets.spans_of("secret: token: abcdefgh12")[0] == [] and secrets.spans_of("")[1] == []
    assert secrets.spans_of("to\u212aen=abcdefgh12")[0] == []  # letters of ASCII only
    large = f"{'ab cd ' * 9000}{assigned} {'ef gh ' * 9000}"
    found = secrets.spans_of(base64.b64encode(gzip.compress(large.encode())).decode(), 1000)
    assert found[2] >= 1 and "assign" in {k for k, _, _ in found[1]}  # read in windows, all of it
    size = 20_000
    began = time.process_time()
    secrets.spans_of("\\u0061" * size)
    once = time.process_time() - began
    secrets.spans_of("\\u0061" * 8 * size)
    assert time.process_time() - began - once < 30 * once + 1  # linear


def test_secrets_in_every_layer():
    key, assigned = "AKIA" + "Z9" * 8, "password=abcdefgh1234"
    plain = f"x {key} {assigned} y"
    encoded = lambda raw: base64.b64encode(raw).decode()
    noise = random.Random(1).randbytes(90).hex()
    layers = [encoded(bz2.compress(plain.encode())), encoded(lzma.compress(plain.encode())), "".join(f"\\U{ord(c):08x}" for c in plain), "".join(f"\\{ord(c):03o}" for c in plain), "".join(f"%u{ord(c):04X}" for c in plain), "".join(f"={ord(c):02X}" for c in plain)]
    layers += [f"{key} password&colon;abcdefgh1234", json.dumps(base64.encodebytes(gzip.compress((plain + noise).encode())).decode()), encoded(gzip.compress(plain.encode())).replace("/", "\\/"), encoded(gzip.compress(encoded(bz2.compress(plain.encode())).encode()))]
    layers.append(quopri.encodestring((plain + " " + "é" * 80).encode()).decode())
    for layer in layers:
        assert {"access", "assign"} <= {k for k, _, _ in secrets.spans_of(f"before {layer} after")[1]}, layer


@pytest.mark.parametrize("make", [lambda n: "% " + "a" * n, lambda n: "a" * n + "%41", lambda n: "-" * n, lambda n: "/" * n, lambda n: ("-/_a" * n)[:n], lambda n: ("ab-" * n)[:n], lambda n: "%41" * (n // 3), lambda n: base64.b64encode(b"\x1f\x8b\x08" * n).decode()[:n], lambda n: base64.b64encode(random.Random(1).randbytes(n)).decode()[:n]])
def test_secrets_in_long_runs(make):
    """Twice as long a run takes about twice as long."""
    spent = []
    for n in (200_000, 400_000):
        began = time.process_time()
        secrets.spans_of(make(n))
        spent.append(time.process_time() - began)
    assert spent[1] <= 2.5 * spent[0] + 1 and spent[1] < 30


def test_secret_streams():
    key, assigned = "AKIA" + "Z9" * 8, "password=abcdefgh1234"
    plain = f"x {key} {assigned} y".encode()
    b64 = lambda raw: base64.b64encode(raw).decode()
    rng, z = random.Random(5), zstandard.ZstdCompressor()
    noise = bytes(rng.randrange(256) for _ in range(3000))

    def bare(raw):
        packer = zlib.compressobj(9, zlib.DEFLATED, -15)
        return packer.compress(raw) + packer.flush()

    cases = [b64(gzip.compress(b"nothing is here") + gzip.compress(plain)), b64(z.compress(b"nothing is here") + z.compress(plain)), b64(zlib.compress(b"nothing is here") + zlib.compress(plain))]
    cases += [b64(gzip.compress("é è ".encode("latin-1") * 20 + plain)), b64(gzip.compress(noise + plain + noise)), b64(gzip.compress(plain + noise))[:-400]]
    cases += [b64(plain.decode().encode(c)) for c in ("utf-16-le", "utf-16-be")] + [b64(gzip.compress(plain.decode().encode("utf-16")))]
    cases += [quote(gzip.compress(plain)), quote(bare(plain + b" and more of the same")), b64(bare(plain * 2)), bare(plain * 2).hex(), "https://h/abc/x/" + b64(bare(plain * 2)), "internationalization/" + b64(plain)]
    cases += [base64.encodebytes(gzip.compress(plain + noise)).decode(), b64(gzip.compress(b64(zlib.compress(quote(plain, safe="").encode())).encode()))]
    for text in cases:
        text = f"before {text} after"
        every = secrets.spans_of(text)[1]
        assert {"access", "assign"} <= {k for k, a, b in every if a >= 6 and b <= len(text) - 5}, text[:80]
        assert not {"access", "assign"} & {k for k, _, _ in secrets.spans_of(secrets.redact_text(text, every))[1]}, text[:80]


def brute_base(text):
    """Base spans by looking at each place in turn."""
    found, n = [], len(text)
    run = lambda at, allowed: next((i for i in range(at, n) if text[i] not in allowed), n)
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    at = 0
    while at < n:
        end = run(at + 4, upper + digits) if text.startswith("AKIA", at) else at
        if end - at >= 5:
            found += [("access", at, end)] * (end - at >= 16)
            at = end
        else:
            at += 1
    at = 0
    while at < n:
        end = run(at, digits + "abcdef")
        found += [("hex", at, end)] * (end - at >= 32)
        at = max(end, at + 1)
    at, folded = 0, "".join(c.lower() if c in upper else c for c in text)
    while at < n:
        name = next((w for w in ("password", "passwd", "secret", "token", "apikey", "api_key") if folded.startswith(w, at)), None)
        end = at
        if name:
            i = at + len(name)
            for quoted in (2, 1):  # quotes may be there or not
                j = i + (quoted == 2 and text[i : i + 1] in ("'", '"') and text[i : i + 1] != "")
                j = run(j, " ")
                if text[j : j + 1] and text[j : j + 1] in ":=":
                    j = run(j + 1, " ")
                    j += text[j : j + 1] != "" and text[j : j + 1] in "'\""
                    value = run(j, upper + upper.lower() + digits + "+/_.=-")
                    if value > j:
                        end = value
                        found += [("assign", at, end)] * (value - j >= 8)
                        break
        at = max(end, at + 1)
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0]), s[2]))


def test_secret_base_by_brute_force(documents):
    rng, letters = random.Random(8), ["password", "SECRET", "api_key", "Token", "passwd", "apikey", "=", ":", " ", '"', "'", "AKIA", "Z9Z9Z9Z9", "0123456789abcdef", "f00d", "x", "\n", "+/"]
    for text in [d[1] for d in documents] + ["".join(rng.choice(letters) for _ in range(40)) for _ in range(400)]:
        assert secrets.spans_of(text)[0] == brute_base(text), text


def test_secret_query_columns(spark, documents):
    got = {r["doc_id"]: r for r in queries.op8_secret_scans(spark, DATA).collect()}
    for i, text, _ in documents:
        base, every, _ = secrets.spans_of(text)
        assert base == brute_base(text) and got[i]["spans"] == secrets.joined(every) and got[i]["base_sha256"] == hashlib.sha256(secrets.joined(base).encode()).hexdigest()
        assert tuple(got[i][f"n_{k}"] for k in secrets.KINDS) == tuple(sum(s[0] == k for s in base) for k in secrets.KINDS)


def test_secret_runs():
    assigned, key = "password=abcdefgh1234", "AKIA" + "Z9" * 8
    b64 = lambda raw: base64.b64encode(raw).decode()
    wrap = lambda s, n, end: end.join(s[i : i + n] for i in range(0, len(s), n))
    noise = bytes(random.Random(1).randrange(32, 127) for _ in range(400))
    long = noise[:200].decode() + f" é{assigned} {key}é " + noise[200:].decode()
    cases = [f"https://host/{'c' * n}/{b64(f'{assigned} {key}'.encode())}" for n in range(1, 6)]
    cases += [f"x_{b64(f'{assigned} {key}'.encode()).rstrip('=')}-y/tail", f"deadbee{f'{assigned} {key} '.encode().hex()}"]
    for n in range(9, 77):
        cases += [wrap(b64(long.encode()), n, "\n"), "See\r\n" + wrap(b64(gzip.compress(long.encode())), n, "\r\n")]
    cases += ["See\n" + wrap(b64(zlib.compress(long.encode())), 64, "\n  "), wrap(long.encode().hex(), 60, "\n"), f"/a/{b64(zlib.compress(long.encode()))}"]
    for text in cases:
        _, every, _ = secrets.spans_of(text)
        assert {"access", "assign"} <= {k for k, _, _ in every}, text
        left = secrets.redact_text(text, every)
        assert not {"access", "assign"} & {k for k, _, _ in secrets.spans_of(left)[1]}, left
    plain = "First line of words\nSecond line of words\nand/or a path/of/lower-case_names 0123456789\n"
    assert secrets.spans_of(plain) == ([], [], 0)
    text = f"https://host/cb/{b64(assigned.encode())}"
    ((_, a, b),) = set(secrets.spans_of(text)[1])
    assert a == text.index("/cb/") + 4 and b <= len(text)


def test_secrets_query(spark, odd):
    assert secrets.find(odd).count() == len(ODD) and secrets.redact(odd).columns == odd.columns
    assert secrets.redact(odd).where("text IS NULL").count() == 1


def test_fingerprints_of_neighbours(spark, documents):
    rows = [(d[0], d[1]) for d in documents[:60]] + [(None, "last one"), (70000, None)]
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    got = {r["doc_id"]: r for r in fingerprints.compare_neighbours(spark.createDataFrame(rows, "doc_id long, text string"), range_bytes=20_000).collect()}
    assert len(got) == len(rows)
    errors = []
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, following = text or "", following or ""
        new = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest() and got[i]["n_chars"] == len(text)
        for name, other in (("near_edited", new), ("near_next", following)):
            x, y = (set(fingerprints.shingle_hashes(t.encode()).tolist()) for t in (text, other))
            j = len(x & y) / len(x | y)
            errors.append((got[i][name] - j, (j * (1 - j) + 1 / 16) / fingerprints.BINS, min(len(x), len(y))))
    # three standard errors of as many independent bins; texts of few shingles fill few bins, which then repeat
    wide = [abs(e) > 3 * v**0.5 for e, v, n in errors if n >= 300]
    assert len(wide) > 20 and sum(wide) <= 0.05 * len(wide) and abs(np.mean([e for e, _, n in errors if n >= 300])) < 0.01
    few = fingerprints.shingle_hashes(b"a b c d e f g")
    least = fingerprints.signature(few)
    assert len(few) == 3 and len(set(least.tolist())) == 3  # every bin copies a filled one ..
    assert min(Counter(least.tolist()).values()) > 40  # .. by hash: none is preferred
    assert fingerprints.compare_neighbours(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert fingerprints.compare_neighbours(spark.createDataFrame([(7, "alone here")], "doc_id long, text string")).first()["near_next"] == 1.0


def test_quality_base_rules(spark, odd, documents):
    for _, text, _ in [*documents[:80], *[r[:3] for r in ODD]]:
        raw = (text or "").encode()
        w = raw.split()
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
        lines, dup = set(), 0
        for line in raw.split(b"\n"):
            if line.split():
                dup += line in lines
                lines.add(line)
        n, symbols, dups, repeat, failed = quality.base_measures(raw, w)
        assert (n, dups, repeat) == (len(w), dup, len(covered)) and symbols == sum(raw.count(c.encode()) for c in "#*$%&|<>")
        assert failed == (n < 50 or 100 * repeat > 50 * n)
    clash = odd.selectExpr("*", "1 AS kept", "'x' AS script", "2 AS n_words", "3 AS _quality")
    out = quality.measure(clash)
    assert out.count() == len(ODD) and out.where("kept AND base_failed").count() == 0 and out.columns[:2] == ["doc_id", "n_words"]
    assert quality.keep(clash).columns == clash.columns and quality.keep(clash).where("kept = 1 AND script = 'x'").count() == out.where("kept").count()
    assert quality.measure(odd.limit(0)).count() == 0
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality").collect()}
    clean = [d for d in documents if labels.get(d[0]) == 1]
    measured = quality.measure(spark.createDataFrame(clean, "doc_id long, text string, lang string")).where("NOT base_failed")
    assert measured.where("NOT kept").count() <= 0.02 * measured.count()


def test_fertility_by_hand():
    """Word by word with the libraries themselves."""
    import public_tokenizers

    paths = quality.vocabulary_paths()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(paths[quality.BYTES], "rb"))}
    multi = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    piece = sentencepiece.SentencePieceProcessor(model_file=paths[quality.PIECES])
    for text, script in (("The man was walking, walking down the street café \U0001f600", "latin"), ("Человек шёл по улице по улице", "cyrillic"), ("Ο άντρας περπατούσε στο δρόμο", "greek"), ("кот 12 ქართული ენა ქართული", "other"), ("그 남자가 거리를 걷고 있을 때", "cjk"), ("वह आदमी सड़क पर", "indic"), ("كان الرجل يمشي", "semitic"), ("12 34", "none")):
        w = text.split()
        if quality.RULES[script][0] == quality.PIECES:
            tokens = [i for x in w for i in piece.encode(x)]
            single = sum(piece.is_byte(i) for i in tokens)
        else:
            tokens = [i for x in w for i in multi.encode_ordinary(" " + x)]
            single = sum(len(b := multi.decode_single_token_bytes(i).strip()) == 1 and b[0] >= 0x80 for i in tokens)
        counts = np.array(list(Counter(tokens).values())) / len(tokens)
        want = (sum(map(len, w)), len(tokens), sum(map(len, w)) / len(tokens), single / len(tokens), -(counts * np.log2(counts)).sum() / np.log2(len(tokens)), script)
        got = quality.fertility([x.encode() for x in w], paths)
        assert got[5] == script and np.allclose(got[:5], want[:5]), (got, want)
    own = quality.Vocabulary(paths[quality.PIECES], 3000)  # a cache that overflows
    listed = [f"wort{i}".encode() for i in range(50)]
    assert own.pieces(listed) == quality.Vocabulary(paths[quality.PIECES]).pieces(listed) and own.held <= 3000


def brute_lm(learnt, core, least):
    """Counts, classes and probabilities of the class model, one token at a time; classes of the core are given."""
    counts = Counter(w for t in learnt for w in [*words(t), b"\n"])
    near = defaultdict(lambda: np.zeros(2 * core.k + 1, np.int64))
    for text in learnt:
        before = b"\n"
        for w in [*words(text), b"\n"]:
            near[before][core.class_of(w)] += 1
            near[w][core.k + core.class_of(before)] += 1
            near[w][2 * core.k] += before == w
            before = w
    classes = {w: core.symbols.get(w) if w in core.symbols else lm.move(core, w, near[w]) if c >= least else core.class_of(w) for w, c in counts.items()}
    table, totals, types = np.zeros((core.k, core.k)), np.zeros(core.k), np.zeros(core.k)
    for w, c in counts.items():
        totals[classes[w]] += c
        types[classes[w]] += 1
    for text in learnt:
        before = b"\n"
        for w in [*words(text), b"\n"]:
            table[classes[before], classes[w]] += 1
            before = w
    return counts, classes, lm.estimate(sum(counts.values()), len(counts), core.classes, table, totals, types)


def test_lm(spark, documents):
    rows = [(d[0], d[1]) for d in documents] + [(None, None), (100000, "unheard-of words"), (5, "the same id"), (None, "no id"), (None, "no id")]
    got = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=100_000, core_words=60, least=8, classes=6).collect()
    learnt = [t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in learnt for w in [*words(t), b"\n"])
    frequent = [b"\n", *sorted((w for w in counts if w != b"\n"), key=lambda w: (-counts[w], w))[:60]]
    number = {w: i for i, w in enumerate(frequent)}
    matrix = np.zeros((61 + lm.SHAPES,) * 2)
    symbol = lambda w: number.get(w, 61 + lm.shape(w))
    for t in learnt:
        own = [b"\n", *words(t), b"\n"]
        np.add.at(matrix, ([symbol(w) for w in own[:-1]], [symbol(w) for w in own[1:]]), 1)
    core = lm.cluster(frequent, matrix, 6)
    counts, classes, model = brute_lm(learnt, core, 8)
    moved = [w for w, c in counts.items() if c >= 8 and w not in core.symbols and classes[w] < 6]
    assert len(moved) > 100  # words beyond the core take part
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        own = [*words(t), b"\n"]
        base = sum(log10((counts[w] + 1) / (n + v + 1)) for w in own)
        kinds = np.array([classes.get(w, core.class_of(w)) for w in [b"\n", *own]])
        emission = model.emission(kinds[1:], np.array([counts[w] for w in own], float))
        score = np.log10(lm.MIX * model.transition[kinds[:-1], kinds[1:]] * emission + (1 - lm.MIX) * np.array([(counts[w] + 1) / (n + v + 1) for w in own])).sum()
        held = i is None or zlib.crc32(str(i).encode()) % 7 == 2
        want[i, held, len(own), sum(counts[w] > 0 for w in own), n, round(base, 5), round(float(score), 5), round(10 ** (-score / len(own)), 2)] += 1
    assert Counter((*tuple(r)[:5], round(r[5], 5), round(r[6], 5), round(r[7], 2)) for r in got) == want
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    # what a class gives its words, and a word its followers, sums up to one
    assert np.allclose(model.transition.sum(axis=1), 1)
    for k in range(core.k):
        own = [w for w in counts if classes[w] == k]
        seen = model.emission(np.full(len(own), k), np.array([counts[w] for w in own], float)).sum() if own else 0
        unseen = (model.class_types[k] + 1) * model.emission(np.array([k]), np.zeros(1))[0] if k > core.classes else 0
        assert abs(seen + unseen - 1) < 1e-9 or not own
    assert [r["n_tokens"] for r in lm.score_documents(spark.createDataFrame([(5, "")], "doc_id long, text string")).collect()] == [1]
    assert lm.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    clash = spark.createDataFrame([(5, "a b", 1, 2), (9, "a b", 1, 2)], "doc_id long, text string, block int, word int")
    assert lm.score_documents(clash).count() == 2


def test_lm_pieces():
    rng = random.Random(3)
    for text in ("a" * 3_000_000, "ab " * 900_000, "".join(rng.choice("a \n\té") for _ in range(1_500_000)), ""):
        raw = text.encode()
        assert b"".join(lm.pieces(raw)) == raw and [w for p in lm.pieces(raw) for w in p.split()] == raw.split()


def likelihood(pairs, own):
    """Log likelihood of class bigrams, from nothing but the classes."""
    k = own.max() + 1
    table = np.zeros((k, k))
    np.add.at(table, (own[:, None], own[None, :]), pairs)
    return sum(lm.h(table.ravel())) - sum(lm.h(table.sum(axis=0))) - sum(lm.h(table.sum(axis=1)))


def test_exchange_gains():
    """A move's gain is the difference of the likelihoods before and after it."""
    rng = np.random.default_rng(4)
    pairs, own = rng.integers(0, 9, (14, 14)).astype(float), np.concatenate([np.arange(11) % 4, [4, 5, 5]])
    member = np.eye(6)[own]
    for w in range(11):
        out, into, self_ = pairs[w] @ member, pairs[:, w] @ member, pairs[w, w]
        out[own[w]] -= self_
        into[own[w]] -= self_
        gain = lm.gains(lm.without(member.T @ pairs @ member, own[w], out, into, self_), out, into, self_, 4)
        for b in range(4):
            other = own.copy()
            other[w] = b
            assert abs((gain[b] - gain[own[w]]) - (likelihood(pairs, other) - likelihood(pairs, own))) < 1e-6
    found = lm.exchange(pairs, own, 11, 4)
    assert likelihood(pairs, found) >= likelihood(pairs, own) and (found[11:] == own[11:]).all()


def test_exchange_finds_classes():
    rng = np.random.default_rng(0)
    pairs = np.zeros((20, 20))
    for a, b in zip(rng.integers(0, 10, 4000), rng.integers(10, 20, 4000), strict=True):  # two classes that alternate
        pairs[a, b] += 1
        pairs[b, rng.integers(0, 10)] += 1
    own = lm.exchange(pairs, np.arange(20) % 2, 20, 2)
    assert len(set(own[:10])) == 1 and len(set(own[10:])) == 1 and own[0] != own[10]


def test_toxicity():
    rng = random.Random(0)
    mild, bad = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}er" for i in range(300)], ["horridious", "vilenasty", "grotesquer"]
    text = lambda toxic: " ".join(rng.choice(mild) for _ in range(60)) + (" " + rng.choice(bad) + " " + " ".join(rng.choice(mild) for _ in range(60)) if toxic else "")
    labels = [i % 4 == 0 for i in range(400)]
    model = toxicity.train([text(y).encode() for y in labels], [int(y) for y in labels])
    fresh = [i % 2 == 0 for i in range(100)]
    scores = model.score([text(y).encode() for y in fresh])
    assert ((scores >= 0.5) == np.array(fresh)).mean() > 0.95
    plain, misspelt = model.score([b"waaer wbaer", b"waaer horidious wbaer"])
    assert misspelt > plain and 0 <= model.score([b""])[0] <= 1
    assert toxicity.train([], []).score([b"x"])[0] < 1e-6 and toxicity.train([b"a"], [1]).score([b"x"])[0] > 0.99


def test_toxicity_by_hand(documents):
    """A text's score from words and n-grams taken one at a time, alone and among others."""
    rng = np.random.default_rng(5)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS), 3.0, -1.0)

    def bucket(symbols, n):
        code = 0
        for c in symbols:
            code = (code * 0x100000001B3 + c) % 2**64
        return ((code + n) * 0x9E3779B97F4A7C15 % 2**64) >> 47

    def scored(text):
        found, seen = [], []
        for w in toxicity.WORD.findall(text.encode().lower()):
            symbols = [1, *(b + 1 for b in w), 1]
            grams = [bucket(symbols[i : i + n], n) for n in toxicity.GRAMS for i in range(len(symbols) - n + 1)]
            whole = sum((b + 1) * pow(0x100000001B3, min(i, 255) + 1, 2**64) for i, b in enumerate(w)) % 2**64
            grams.append((whole * 0x9E3779B97F4A7C15 % 2**64) >> 47)
            found.append(0 if w in seen[-3:] else model.table[grams].mean())
            seen.append(w)
        k = toxicity.WINDOW
        best = max((np.mean(found[i : i + k]) for i in range(max(1, len(found) - k + 1))), default=0) if found else 0
        return 1 / (1 + np.exp(-(model.slope * best + model.bias)))

    texts = [d[1][:600] for d in documents[:60]] + ["", "  ", "again again again no again", "again", "a", "é Ünï " * 30]
    assert np.allclose(model.score([t.encode() for t in texts]), [scored(t) for t in texts], atol=1e-6)
    for chunk in (50, 333):
        assert np.allclose(model.score([t.encode() for t in texts], chunk), [scored(t) for t in texts], atol=1e-6)
    assert np.allclose(model.score([t.encode() for t in texts[::-1]])[::-1], model.score([t.encode() for t in texts]))


def test_toxicity_query(spark, odd):
    got = queries.op1_toxicity(spark, DATA).collect()
    assert len(got) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 1), (9, 0), (None, 1), (7, None), (777, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 5}) == 1 and toxicity.toxicity(odd.limit(0), labels).count() == 0
    many = spark.range(6000).selectExpr("5L AS doc_id", "concat('text ', id) AS text")
    assert len(toxicity.labelled_sample(many, labels, "doc_id", "text", "toxic")[0]) <= 2 * (toxicity.SAMPLE_TOXIC + toxicity.SAMPLE_CLEAN)


def one_by_one(sizes, capacity):
    """(size, bin) of each, largest first: into the bin with the least room that takes it, of several the first."""
    room, out = [], []
    for size in sorted(sizes, reverse=True):
        fit = min(((r, i) for i, r in enumerate(room) if r >= size), default=(None, len(room)))[1]
        if fit == len(room):
            room.append(capacity)
        room[fit] -= size
        out.append((size, fit))
    return out


def test_sharding_by_brute_force(spark):
    rng = random.Random(4)
    for n in range(30):  # many of one size, too
        sizes = [rng.randrange(1, 40 if n % 2 else 6) for _ in range(200)]
        runs = sharding.best_fit_decreasing(list(Counter(sizes).items()), 50)
        assert Counter((s, b) for s, b, k in runs for _ in range(k)) == Counter(one_by_one(sizes, 50))
    texts = [f"{i % 97} " * (i % 41 + 1) for i in range(2000)]  # repeated, so groups have several rows; no group needs to be cut
    got = sharding.shard(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 8).collect()
    groups = Counter(texts)
    sizes = {t: (len(t) + 1) * n for t, n in groups.items()}
    assert max(sizes.values()) <= sum(sizes.values()) // 8
    homes = {texts[r["doc_id"]]: r["shard"] for r in got}
    assert len({(texts[r["doc_id"]], r["shard"]) for r in got}) == len(homes)  # a group is in one shard
    low = max(-(-sum(sizes.values()) // 8), max(sizes.values()))
    capacity = next(c for c in range(low, 2 * low) if max(b for _, b in one_by_one(sizes.values(), c)) < 8)
    assert Counter((sizes[t], b) for t, b in homes.items()) == Counter(one_by_one(sizes.values(), capacity))


def test_bpe_query_equals_the_library(spark, documents):
    library = tiktoken.Encoding("own", pat_str=__import__("public_tokenizers").PATTERN, mergeable_ranks=bpe.ByteBpe(bpe.vocabulary_path()).ranks, special_tokens={})
    want = {}
    for i, text, *_ in documents:
        ids = library.encode_ordinary(text or "")
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.queries()["op10_byte_bpe"](spark, DATA).collect()}
    assert got == want


def test_sharding(spark, documents, odd):
    assert sharding.best_fit_decreasing([(6, 1), (5, 2), (4, 1)], 10) == [(6, 0, 1), (5, 1, 2), (4, 0, 1)]
    assert sharding.best_fit_decreasing([(11, 1)], 10) is None
    rng = random.Random(1)
    for _ in range(20):  # as packing one by one
        sizes = sorted((rng.randrange(1, 40) for _ in range(60)), reverse=True)
        room = []
        for s in sizes:
            fit = min((r, i) for i, r in enumerate(room) if r >= s) if any(r >= s for r in room) else None
            room.append(50 - s) if fit is None else room.__setitem__(fit[1], fit[0] - s)
        assert len({b for _, b, _ in sharding.best_fit_decreasing(list(Counter(sizes).items()), 50)}) == len(room)
    hot = [(10_000 + i, "copy " * 50, "en", "s", 250, None) for i in range(300)]
    df = spark.createDataFrame([(*d, "s", len(d[1]), None) for d in documents] + hot, SCHEMA)
    got = sharding.shard(df, 8).collect()
    assert len(got) == len(documents) + 300
    loads, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[r["text_crc32"], r["size"]].add(r["shard"])
    assert sum(len(h) > 1 for h in homes.values()) == 1 and len(homes[max(homes, key=lambda k: len(homes[k]))]) > 1  # only the hot group is cut
    assert all(len(homes[zlib.crc32(d[1].encode()), len(d[1].encode()) + 1]) == 1 for d in documents)
    assert max(loads.values()) - min(loads.values()) <= 0.02 * sum(loads.values()) / 8 and set(loads) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(odd).count() == len(ODD) and sharding.shard(odd.limit(0)).count() == 0


def view(name, sql_rows):
    connection = duckdb.connect()
    connection.register("rows", sql_rows)
    connection.execute(f"CREATE VIEW {name} AS SELECT * FROM rows")
    return connection


def test_mixing(spark, odd):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for df in (docs, odd):
        got = mixing.mix(df).collect()
        want = view("documents", df.toArrow()).execute(mixing.oracle()).fetchall()
        assert Counter(tuple(r) for r in got) == Counter(want)
        assert all(r["taken"] <= 2 * r["size"] for r in got)
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r["source_size"], r["target"]] += r["taken"]  # targets alone are shared by sources
    assert all(abs(t - n) <= mixing.BLOCK + 0.02 * t for (_, t), n in taken.items())
    texts = mixing.mix_texts(docs)
    per_doc = Counter()
    for r in texts.collect():
        per_doc[r["doc_id"]] += len(r["text"].encode().split())
    assert texts.columns == docs.columns and per_doc == Counter({r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect() if r["taken"]})
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.mix_texts(odd.limit(0)).count() == 0
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    cut = [r for r in texts.collect() if r["text"] != whole[r["doc_id"]]]
    assert len(cut) > 20 and any("\n" in r["text"] for r in cut) and sum(r["text"] in whole[r["doc_id"]] for r in cut) > len(cut) // 5
    assert Counter((r["doc_id"], r["extra"]) for r in mixing.mix_texts(odd).collect()) == Counter((r["doc_id"], r["extra"]) for r in mixing.mix_texts(odd.withColumnRenamed("extra", "_shard")).withColumnRenamed("_shard", "extra").collect())
    counts = mixing.counts_by_shard(spark.createDataFrame([(0, 1000, 1700), (1, 5000, 9000)], "rank long, blocks long, slots long"))
    drawn = mixing.slots(counts).collect()
    assert Counter(Counter(r["block"] for r in drawn if r["rank"] == 0).values()) == Counter({2: 700, 1: 300})
    shares = Counter(r["shard"] for r in drawn if r["rank"] == 1)  # a multinomial draw: chi-squared with 63 degrees of freedom
    assert 25 < sum((shares[i] - 9000 / 64) ** 2 / (9000 / 64) for i in range(64)) < 115
    both = {(r["rank"], r["block"], r["copy"]): r["shard"] for r in drawn}
    twice = [(both[1, b, 0], both[1, b, 1]) for b in range(5000) if (1, b, 1) in both]
    assert sum(x == y for x, y in twice) < 0.05 * len(twice)
    places = [r["block"] for r in mixing.permute(spark.range(5000).selectExpr("id AS x", "5000L AS n", "1L AS seed"), "x", "n", "seed", "block").orderBy("x").collect()]
    assert sorted(places) == list(range(5000)) and len({p * 16 // 5000 for p in places[:100]}) == 16


def test_chat(spark):
    rows = [(1, 1, "assistant", "a <s>\\0[INST]"), (1, 0, "user", None), (2, 0, None, "x"), (2, 0, None, "x"), (3, None, "as<m>", "\\1"), (None, 0, "assistant", "y"), *[(4, 0, "assistant", c + "x") for c in "A<[\\a"]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    probe = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    got = chat.digest(chat.format_chat(df.unionByName(probe))).collect()
    want = view("conversations", df.toArrow()).execute(chat.oracle()).fetchall()
    assert Counter(map(tuple, got)) == Counter(want)
    assert chat.format_chat(df.limit(0)).count() == 0
    given = [{"type": "text", "text": "see <"}, {"type": "image", "ref": "u1", "width": 1024, "height": 600}, {"type": "audio", "ref": "u2", "tokens": 64, "length": 9.0}, {"type": "document", "ref": "u3", "length": 2.5}, {"type": "audio", "ref": "u4", "length": 1.01}, {"type": None, "ref": "u5"}, {"type": "text", "text": "end"}]
    rows = [(1, 0, "user", "", json.dumps(given)), (1, 1, "assistant", "", None), (2, 0, "assistant", "", json.dumps(given[:1] + [{"type": "image"}] * 300))]
    typed = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, parts string")
    first, second = chat.format_chat(typed, F.from_json("parts", chat.PART)).orderBy("conv_id").collect()
    assert first["formatted"] == "<s>user<m>see \\1<image:0><audio:1><document:2><audio:3><unknown:4>end</s>\n<s>assistant<m></s>\n"
    tokens = [85 + 170 * 2 * 2, 64, 3 * 600, 26, 0]
    assert [(a["number"], a["type"], a["ref"], a["tokens"]) for a in first["attachments"]] == list(zip(range(5), ["image", "audio", "document", "audio", "unknown"], ["u1", "u2", "u3", "u4", "u5"], tokens, strict=True)) and first["expanded_tokens"] == sum(tokens)
    assert second["formatted"].count("<image:") == 300 and "<image:299>" in second["formatted"]


def test_pipeline(spark, documents):
    docs, seen = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(out.toArrow())
        seen[name] = docs
    texts = {d[0]: d[1] for d in documents}
    kept = [r["doc_id"] for r in seen["quality rules"].collect()]
    assert all(len(words(texts[i])) >= 50 for i in kept)
    unique = [r["doc_id"] for r in seen["SimHash near-dedup"].collect()]
    assert set(unique) <= set(kept) and len(unique) == len(set(unique))
    sets = {i: five_words(texts[i]) for i in kept}
    assert not any(alike(sets[i], sets[j]) for i in unique for j in unique if i < j)
    fps = {i: brute_fingerprint(texts[i], 5) for i in kept}
    for i in set(kept) - set(unique):  # what goes is like something else
        assert any(j != i and (alike(sets[i], sets[j]) or (fps[i] ^ fps[j]).bit_count() <= 3) for j in kept)
    for r in seen["secret scans"].collect():
        assert r["text"] == secrets.redact_text(texts[r["doc_id"]], secrets.spans_of(texts[r["doc_id"]])[1]) and r["n_chars"] == len(r["text"])
    own = bpe.ByteBpe(bpe.vocabulary_path())
    mixed = [r["text"] for r in seen["mixing sources to target weights"].collect()]
    assert Counter(hashlib.sha256(i.tobytes()).hexdigest() for _, i, _ in own.encode_batch(mixed)) == Counter(r["ids_sha256"] for r in docs.collect())


def five_words(text):
    w = words(text)
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def test_near_copies(spark, documents):
    rng, rows = random.Random(3), []
    for i, d in enumerate(documents[:60]):
        w = (d[1] or "").split()
        if not 50 <= len(w) <= 2000:
            continue
        rows.append((i, d[1]))
        for k in range(3 if i % 10 else 40):  # some words changed: on both sides of the bound; long runs too
            changed = list(w)
            for at in rng.sample(range(len(w)), max(1, len(w) * (k % 3 + 1) // 60)):
                changed[at] = f"w{rng.random()}"
            rows.append((1000 * (k + 1) + i, " ".join(changed)))
    rows += [(None, "only a null id"), (None, rows[0][1]), (7, "a second text of id seven"), (8, None), (9, " "), (8, None)]
    rows += [(11, "unlike " * 3 + "one of two texts of id eleven here"), (11, "quite " * 3 + "another text that has the same id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stay = [tuple(r) for r in copies.drop(df).collect()]
    kept = [five_words(t) for _, t in stay]
    assert not any(alike(kept[i], kept[j]) for i in range(len(kept)) for j in range(i))
    assert len({tuple(sorted(k)) for k in kept}) == len(kept) < len(rows) - 40
    linked = lambda a, b: alike(five_words(a), five_words(b)) or (brute_fingerprint(a, 5) ^ brute_fingerprint(b, 5)).bit_count() <= 3
    for i, text in rows:  # what goes, goes for something like it
        assert (i, text) in stay or any(linked(text, t) for j, t in rows if (j, t) != (i, text)) or sum(r == (i, text) for r in rows) > 1
    assert {(11, rows[-1][1]), (11, rows[-2][1]), (None, "only a null id"), (7, "a second text of id seven")} <= set(stay)
    assert sum(not five_words(t) for _, t in stay) == 1 and copies.drop(df.limit(0)).count() == 0
    extra = copies.drop(df.selectExpr("*", "1 AS digest", "2 AS _at", "3 AS id"))
    assert extra.columns == ["doc_id", "text", "digest", "_at", "id"] and extra.count() == len(stay)


def test_near_copies_behind_a_hub(spark):
    """What is alike in a bucket whose first rows are alike to none is found in later rounds, by the jobs themselves."""
    texts = {n: " ".join(f"w{n}x{i}" for i in range(60)) for n in range(8)}
    texts |= {8: texts[7] + " more", 9: "other " + texts[7]}
    nodes = [(n, [5, 100 + n], bytes([min(n, 7)] * copies.SKETCH)) for n in texts]
    got = copies.near_copies(spark.createDataFrame(nodes, "digest long, keys array<long>, sketch binary"), spark.createDataFrame(list(texts.items()), "digest long, text string"))
    assert sorted(r["digest"] for r in got.collect()) == [8, 9]


def test_near_copies_travel_once_a_block(spark, monkeypatch):
    """Texts of one bucket that are alike below 0.8 only, and two that are alike: all are compared, far fewer texts travel than pairs."""
    n = 200
    texts = {k: " ".join([f"c{i}" for i in range(70)] + [f"w{k}x{i}" for i in range(30)]) for k in range(n)}
    texts[n] = texts[n - 1] + " more"
    moved, plain = [], copies.map_arrow
    monkeypatch.setattr(copies, "map_arrow", lambda df, fn, schema: (moved.append(df.count()) if fn is copies._check else None, plain(df, fn, schema))[1])
    nodes = spark.createDataFrame([(k, [5], bytes(copies.SKETCH)) for k in texts], "digest long, keys array<long>, sketch binary")
    got = copies.near_copies(nodes, spark.createDataFrame(list(texts.items()), "digest long, text string"))
    assert [r["digest"] for r in got.collect()] == [n]
    assert sum(moved) < n * n / 2 / 8


def test_texts_with_a_common_part_make_no_pairs(spark, monkeypatch):
    """A bucket of texts alike at 0.55 to 0.75, and some that are alike beyond 0.8: candidates stay few, all that is alike is found."""
    rng = random.Random(5)
    texts = {k: " ".join([f"c{i}" for i in range(100)] + [f"w{k}x{i}" for i in range(rng.randrange(15, 40))]) for k in range(300)}
    for k in range(300, 330):  # alike to one of those, and some to each other
        of = rng.randrange(140, 160)
        texts[k] = " ".join([texts[of], *(f"v{k}x{i}" for i in range(rng.randrange(1, 12)))])
    made, plain = [], copies.materialize
    monkeypatch.setattr(copies, "materialize", lambda df, name, parts=None: (out := plain(df, name, parts), made.append(out.count()) if name == "candidates" else None)[0])
    nodes = spark.createDataFrame([(k, [5], bytes(copies.SKETCH)) for k in texts], "digest long, keys array<long>, sketch binary")
    gone = {r["digest"] for r in copies.near_copies(nodes, spark.createDataFrame(list(texts.items()), "digest long, text string")).collect()}
    sets = {k: five_words(t) for k, t in texts.items()}
    pairs = [(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])]
    assert not any({a, b}.isdisjoint(gone) for a, b in pairs) and gone <= {b for _, b in pairs} and len(gone) >= 20
    assert sum(made) < 6000  # pairs: over 50,000


def test_rarest_shingles_lose_no_pair(spark):
    """Sets of every size and likeness, their rarest shingles streamed in batches: each alike pair is a candidate, whatever the rounds."""
    rng = random.Random(8)
    pool = [f"p{i}" for i in range(400)]
    texts = {}
    for k in range(150):
        w = texts[rng.randrange(k)].split() if k > 5 and rng.random() < 0.8 else rng.choices(pool, k=rng.randrange(5, 120))
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(pool)
        texts[k] = " ".join(w + rng.choices(pool, k=rng.randrange(0, 4)))
    sets = {k: five_words(t) for k, t in texts.items()}
    want = {(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])}
    left = copies.materialize(spark.createDataFrame([(k, bytes(copies.SKETCH)) for k in texts], "digest long, sketch binary"), "left")
    rows = [tuple(r) for r in copies.rarest(left, spark.createDataFrame(list(texts.items()), "digest long, text string")).collect()]
    found, hubs, names = set(), 1, ["key", "late", "digest", "sketch", "size", "at"]
    kinds = pa.schema([("key", pa.int64()), ("late", pa.bool_()), ("digest", pa.int64()), ("sketch", pa.binary()), ("size", pa.int64()), ("at", pa.int64())])
    while rows:
        rows.sort(key=lambda r: r[:3])
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(7))
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[a:b]], kinds) for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        out = pa.Table.from_batches(list(copies.compare_rarest(hubs)(iter(batches)))).to_pylist()
        found |= {tuple(sorted((r["digest"], r["hub"]))) for r in out if r["hub"] is not None}
        rows = [tuple(r[n] for n in names) for r in out if r["hub"] is None]
        hubs *= 4
    assert want <= found and len(want) > 50


def test_hubs_beyond_memory_are_read_from_a_file():
    held = copies.Held(100)
    sets = {k: np.arange(k, k + 10, dtype=np.uint64) for k in range(5)}
    for k, s in sets.items():
        held.add(k, s)
    assert isinstance(held.sets[4], np.memmap) and all((held.sets[k] == s).all() for k, s in sets.items()) and copies.alike(held.sets[4], sets[4])


def test_near_copies_in_rounds():
    """Buckets of what is alike in pairs only, streamed in batches: all pairs that share one are compared."""
    rng = np.random.default_rng(2)
    n = 90
    sketches = rng.integers(0, 256, (n, copies.SKETCH), np.uint8)
    sketches[:, :30] = 7
    sketches[rng.permutation(n)[:60], 30:40] = 9
    keys, digests = np.sort(rng.integers(0, 3, n)), np.arange(n)
    want = {(int(b), int(a)) for a in range(n) for b in range(a + 1, n) if keys[a] == keys[b] and (sketches[a] == sketches[b]).sum() >= copies.ALIKE}
    found, hubs = set(), 1
    while len(keys):
        cuts = np.sort(rng.integers(0, len(keys) + 1, 5))
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[a:b]), pa.array(digests[a:b]), pa.array([s.tobytes() for s in sketches[digests[a:b]]], pa.binary())], ["key", "digest", "sketch"]) for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True)]
        out = pa.Table.from_batches(list(copies.compare_hubs(hubs)(iter(batches)))).to_pylist()
        found |= {(r["digest"], r["hub"]) for r in out if r["hub"] is not None}
        rest = [(r["key"], r["digest"]) for r in out if r["hub"] is None]
        keys, digests = np.array([k for k, _ in rest], np.int64), np.array([d for _, d in rest], np.int64)
        hubs *= 4
    assert found == want and len(want) > 100


@pytest.mark.parametrize("rows", [ODD, []])
def test_pipeline_on_odd_rows(spark, documents, tmp_path, rows):
    plain = [(None, d[1], d[2], "a", 1, None) for d in documents if len(d[1].split()) > 60][: 5 * len(rows)]
    spark.createDataFrame([*rows, *plain, *plain], SCHEMA).withColumnRenamed("extra", "kept").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
    assert (corpus_pipeline.run(spark, str(tmp_path)).count() > 0) == bool(rows)


LONG = "Ünïque words repeat " * 300_000 + "and here is password=abcdefgh1234 " + "x" * 400_000 + " end."


@pytest.fixture(scope="module", params=["odd", "empty"])
def folder(request, spark, documents, tmp_path_factory):
    """Tables of nulls, empty and very long texts, ties, repeats and columns of clashing names; and empty ones."""
    path, some = str(tmp_path_factory.mktemp(request.param)), request.param == "odd"
    plain = [(*d, "a" if d[0] % 2 else "b", len(d[1]), "y") for d in documents[:25]]
    rows = [*ODD, *plain, (8_000, LONG, "en", "c", len(LONG), "z"), (8_000, "the id of the long one", "en", "c", 1, None)] if some else []
    clash = ["size", "block", "word", "kept", "shard", "digest", "fp", "rank"]
    df = spark.createDataFrame(rows, SCHEMA)
    df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)]).coalesce(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d[0], 1, d[0] % 3 == 0) for d in documents[:25]] if some else [], "doc_id long, quality int, toxic boolean").withColumn("toxic", F.col("toxic").cast("int")).write.parquet(f"{path}/labels.parquet")
    turns = [(1, 0, "user", None, 1), (1, 1, "assistant", "</s><s>[INST]\\", 1), (1, 1, "assistant", "</s><s>[INST]\\", 1), (None, None, None, None, 2), (3, 0, "assistant", LONG, 3)]
    spark.createDataFrame(turns if some else [], "conv_id long, turn long, role string, text string, content int").write.parquet(f"{path}/conversations.parquet")
    return path, [tuple(r) for r in rows]


def test_every_query_on_odd_tables(spark, folder):
    """Those over documents and conversations; op11 and op12 read other tables and have tests of their own."""
    path, rows = folder
    run = lambda f: [r.asDict() for r in f(spark, path).collect()]
    ids = Counter(r[0] for r in rows)
    raws = sorted((r[1] or "").encode() for r in rows)
    for name, f in queries.queries().items():
        if name.startswith("op") and name not in ("op4_chat_formatting", "op11_warc", "op12_hard_negatives"):
            got = run(f)
            assert Counter(r["doc_id"] for r in got) == ids, name
            if name == "op1_toxicity":
                assert all(0 <= r["score"] <= 1 for r in got)
            elif name == "op2_lm_scoring":
                assert sorted(r["n_tokens"] for r in got) == sorted(len(b.split()) + 1 for b in raws) and all(r["score"] < 0 for r in got)
            elif name == "op3_quality_rules":
                assert sorted(r["n_words"] for r in got) == sorted(len(b.split()) for b in raws) and sorted(r["word_chars"] for r in got) == sorted(len("".join(b.decode().split(" ")).replace("\n", "").replace("\t", "")) for b in raws)
            elif name == "op5_mixing":
                assert all(r["taken"] <= 2 * r["size"] for r in got) and Counter(map(str, got)) == Counter(map(str, run(f)))
                taken = Counter()
                for r in got:
                    taken[r["source_size"], r["target"]] += r["taken"]
                assert all(abs(n - t) <= mixing.BLOCK + 0.02 * t for (_, t), n in taken.items())
            elif name == "op6_fingerprints":
                assert sorted(r["n_chars"] for r in got) == sorted(len(b.decode()) for b in raws) and all(0 <= r["near_next"] <= 1 for r in got)
            elif name == "op7_sharding":
                assert sorted(r["size"] for r in got) == sorted(len(b) + 1 for b in raws)
                for s in {r["shard"] for r in got}:
                    assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
            elif name == "op8_secret_scans":
                assert not rows or sum(r["n_assign"] for r in got if r["doc_id"] == 8000) == 1
            elif name == "op9_simhash":
                fps = [brute_fingerprint(r[1]) for r in rows]
                assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == Counter(zip([r[0] for r in rows], [f"{x:016x}" for x in fps], brute_components(fps, [r[0] for r in rows]), strict=True))
            elif name == "op10_byte_bpe":
                assert sorted(r["decoded_sha256"] for r in got) == sorted(hashlib.sha256(b).hexdigest() for b in raws)
    got = run(queries.op4_chat_formatting)
    connection = view("conversations", spark.read.parquet(f"{path}/conversations.parquet").toArrow())
    want = connection.execute(chat.oracle())
    names = [c[0] for c in want.description]
    assert Counter(tuple(r[c] for c in names) for r in got) == Counter(want.fetchall())
