"""Archives, manifest proofs and hard negatives against plain versions, with odd rows and hot groups."""

import base64
import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pytest
import zstandard

from panelwright.llm import hard_negatives, merkle, warc

PAGES = [(5, "http://a/1", "<p>same</p>"), (3, "http://a/2", "<p>same</p>"), (9, "http://a/3", "<p>same</p>"), (3, "http://a/2", "<p>same</p>"),
         (1, None, None), (2, "", ""), (4, "http://é x\r\nWARC-Type: bad", "é\r\n\r\nWARC/1.1\r\n"), (None, "u", "only null id"), (None, "u", "<p>same</p>"),
         (7, "u", "long " * 300_000), (8, "u", "long " * 300_000), (-6, "u", "minus")]


def plain_round_trip(rows):
    first, out = {}, []
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        body = (html or "").encode()
        again = body in first
        out.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first.get(body)))
        first.setdefault(body, page)
    return out


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    filler = [(100 + i, f"http://b/{i}", f"<p>page {i % 40} of some pages</p>" * 20) for i in range(200)]
    df = spark.createDataFrame([(*p, "clash", 1) for p in PAGES + filler], "page_id long, url string, html string, payload_digest string, content int").repartition(3)
    rows = warc.round_trip(df).collect()
    assert rows[0].asDict().keys() == {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"}
    assert sorted(map(tuple, rows), key=str) == sorted(plain_round_trip(PAGES + filler), key=str)
    assert warc.round_trip(df.limit(0)).collect() == []


def test_archive_files_are_of_the_format(spark, tmp_path):
    texts = {i: f"<html><body><h1>Title {i}</h1>" + "".join(f"<p>{random.Random(i * k).random()} words of page {i}</p>" for k in range(60)) for i in range(400)}
    df = spark.createDataFrame([(i, f"http://site/{i}", t) for i, t in texts.items()], "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(df)
    warc.save_files(archives, str(tmp_path / "out"))
    raw = next((tmp_path / "out").glob("*.warc.zst")).read_bytes()
    magic, size = struct.unpack_from("<II", raw)
    assert magic == 0x184D2A5D
    made = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompressobj().decompress(raw[8:8 + size]))
    # any reader with the dictionary gets the records one after the other
    whole = zstandard.ZstdDecompressor(dict_data=made).stream_reader(raw[8 + size:], read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 401 and whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    records = warc.read_archives(warc.load_files(spark, str(tmp_path / "out")), strict=True).where("record_type = 'response'").collect()
    assert {r.record_id: bytes(r.payload).decode() for r in records} == {f"<urn:x-page:{i}:{i}>": t for i, t in texts.items()} or \
        sorted(bytes(r.payload).decode() for r in records) == sorted(texts.values())
    assert [r.offset for r in records] == sorted({r.offset for r in records})


def test_damage_is_told(spark):
    good = warc.response(1, 1, "u", b"hello", "2024-01-01T00:00:00Z")
    assert warc.parse(good).problem is None
    bad = {"version": good.replace(b"WARC/1.1", b"WARC/9.9"), "length": good.replace(b"hello", b"hello!"), "digest": good.replace(b"hello", b"hallo"),
           "no warc-date": good.replace(b"WARC-Date", b"X-Date"), "header has no end": b"WARC/1.1\r\nWARC-Type: response", "bad field": good.replace(b"WARC-Date:", b"WARC-Date"),
           "Content-Length": good[:-2], "refers": warc.record_bytes([("WARC-Type", "revisit"), ("WARC-Record-ID", "x"), ("WARC-Date", "d")], b"")}
    for what, data in bad.items():
        problem = warc.parse(data).problem
        assert problem and (what in problem or what in ("length", "digest", "refers")), (what, problem)
    folded = good.replace(b"WARC-Target-URI: u", b"warc-target-uri:\r\n u")
    assert warc.parse(folded).problem is None and warc.parse(folded).fields["warc-target-uri"].strip() == "u"
    other = warc.parse(warc.record_bytes([("WARC-Type", "resource"), ("WARC-Record-ID", "x"), ("WARC-Date", "d")], b"body"))
    assert other.problem is None and other.payload == b"body"
    packed = warc.archive_bytes([good, good])
    cases = [("whole", packed), ("cut", packed[:-3]), ("torn", packed[:20] + b"\0\0\0\0" + packed[24:]), ("none", None), ("empty", b""),
             ("skips", struct.pack("<II", 0x184D2A53, 3) + b"abc" + packed + struct.pack("<II", 0x184D2A53, 1) + b"x"), ("bad skip", struct.pack("<II", 0x184D2A5D, 99) + b"abc")]
    df = spark.createDataFrame(cases, "archive string, content binary")
    got = {}
    for r in warc.read_archives(df, payloads=False).collect():
        got.setdefault(r.archive, []).append(r.problem is None)
    assert got == {"whole": [True, True], "cut": [True, False], "torn": [False], "skips": [True, True], "bad skip": [False]}
    with pytest.raises(Exception, match="frame is cut"):
        warc.read_archives(df, strict=True).collect()


def joined(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    def put(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(hashes):
        out = [hashes]
        while len(out[-1]) > 1:
            out.append([joined(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(tree, p):
        out = []
        for level in tree[:-1]:
            out.append((p % 2, level[p ^ 1] if p ^ 1 < len(level) else ""))
            p //= 2
        return out
    leaves = {}
    for r in rows:
        leaves.setdefault(r[2], []).append((r[0], joined(*map(put, r)), r))
    langs = sorted(leaves, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        leaves[x].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    trees = {x: levels([t[1] for t in leaves[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for p, (i, leaf, r) in enumerate(leaves[x]):
            siblings, held = path(trees[x], p) + path(top, k), leaf
            if i is not None and zlib.crc32(str(i).encode()) % 7 == 0:
                held = joined(*map(put, (*r[:3], None if r[3] is None else r[3] + 1, r[4])))
            for right, h in siblings:
                held = joined(h, held) if right else joined(held, h)
            out.append((i, leaf, trees[x][-1][0], top[-1][0], joined(*[h for _, h in siblings]), held, held == top[-1][0]))
    return out


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_manifest(spark, monkeypatch, bits):
    monkeypatch.setattr(merkle, "BITS", bits)
    rng = random.Random(bits)
    rows = [(i, f"s{i % 5}", rng.choice(["en", "en", "en", "de", None, "é", "zz"]), rng.choice([None, i, 5]), f"text {i} é\n") for i in range(150)]
    rows += [(7, None, "en", 1, None), (7, None, "en", 1, None), (7, None, "en", 2, ""), (None, None, None, None, None), (None, "x", "en", None, "y"),
             (14, "s", "lone", (1 << 63) - 1, "long " * 100_000), (-3, "s", "", 0, "t")] + [(500, "s", "en", 3, "copy")] * 40
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos int").repartition(4)
    got = merkle.verified(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_manifest(rows), key=str)
    assert merkle.verified(df.limit(0)).collect() == []
    one = spark.createDataFrame([(1, "s", "en", 3, "abc")], "doc_id long, source string, lang string, n_chars long, text string")
    assert list(map(tuple, merkle.verified(one).collect())) == plain_manifest([(1, "s", "en", 3, "abc")])


def test_proofs_of_some_leaves_fetch_few_nodes(spark):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(300)]
    made = merkle.build(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    some = made.leaves.where("doc_id IN (3, 4, 250)")
    got = merkle.prove(made, some)
    assert got.count() == 3 and {r.ok for r in got.select((merkle.fold(got["leaf"], got["proof"]) == made.root).alias("ok")).collect()} == {True}
    for n in (1, 2, 5, 64, 300):
        for places in ([0], [n - 1], list(range(n)), sorted({0, n // 2, n - 1})):
            union = merkle.missing(places, n)
            assert len(union) == len(set(union)) <= len(places) * max(1, math.ceil(math.log2(n)) if n > 1 else 0)
        assert merkle.missing(list(range(n)), n) == []


def plain_negatives(rows, every=100):
    good = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(x)) if abs(x) < 2 ** 44 else int(x) * 256 for x in v])
            for i, v, label in rows if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, label, v) in enumerate(good):
        if i % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), j, other) for b, (j, other, w) in enumerate(good) if b != a and len(w) == len(v)), key=lambda t: t[:2])
        for s, p, _ in [t for t in scored if t[2] == label][:5]:
            fit = [t for t in scored if t[2] != label and 30 * -s <= 100 * -t[0] <= 90 * -s][:10]
            out += [(i, p, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(fit)]
    return out


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(hard_negatives, "FIRST_READ", 2)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((700, 12)).astype(np.float32).astype(float)
    base[200:320] = base[100]           # a hot vector, and a label with a third of the rows
    labels = np.where(rng.random(700) < 0.4, 3, rng.integers(0, 40, 700))
    rows = [(int(i), v.tolist(), int(n)) for i, (v, n) in enumerate(zip(base, labels))]
    rows += [(None, [1.0] * 12, 3), (800, None, 3), (900, [1.0] * 12, None), (1000, [float("nan")] + [1.0] * 11, 3), (1001, [None] + [1.0] * 11, 3),
             (1002, [float("inf")] + [1.0] * 11, 3), (1100, [0.0] * 12, 3), (100, base[5].tolist(), 3), (100, base[100].tolist(), 3), (1200, [], 1), (1201, [], 1), (1203, [], 2),
             (1300, [2.0, 1.0], 4), (1301, [1.0, 1.0], 4), (1302, [1.0, 0.5], 5), (1303, [-1.0, 0.0], 5)]
    df = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], "vec_id long, embedding array<double>, label int, anchor_id string, score double").repartition(5)
    got = hard_negatives.mine(df).collect()
    assert got[0].asDict().keys() == {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"}
    assert sorted(map(tuple, got)) == sorted(plain_negatives(rows))
    assert hard_negatives.mine(df.limit(0)).collect() == [] and hard_negatives.mine(df.where("vec_id % 100 <> 0")).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2 ** 45 + 3 * i), 1e5, -0.5 * i], i % 3) for i in range(1, 120)] + [(200, [3e18, 1.0, 2.0], 1), (300, [3e18, 1.0, 2.0], 0), (400, [1e300, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    def near(x):
        return max(-(1 << 63), min((1 << 63) - 1, x))
    got = {(r.anchor_id, r.positive_score) for r in hard_negatives.mine(df).collect() if r.anchor_id == 100}
    want = {(a, near(p)) for a, _, _, _, p, _ in plain_negatives(rows) if a == 100}
    assert got == want


def test_threshold_stops_early_and_keeps_ties():
    rng = np.random.default_rng(4)
    v = np.floor(256 * np.abs(rng.standard_normal((4000, 6)) ** 5)).astype(np.int64)
    v[1000:1040] = v[np.argmax(v.sum(1))]
    order = np.argsort(v, axis=0, kind="stable").T.astype("<u4")
    data, kind = hard_negatives.stored(v)
    ids = rng.permutation(4000)
    lists = hard_negatives.Lists(np.arange(4000).astype("<i8").tobytes(), ids.astype("<i8").tobytes(), np.zeros(4000, "<i8").tobytes(), data, kind, order.tobytes())
    anchor = np.array([3, -1, 0, 2, 5, -2])
    scores = v @ anchor
    top = int(scores.max())
    for windows in ([(-np.inf, np.inf)], [(top * 3 // 10, top * 9 // 10), (top // 2, top)]):
        places, _, met = hard_negatives.search(lists, anchor, np.ones(4000, bool), windows, 10)
        for (low, high), got in zip(windows, places):
            inside = [p for p in np.lexsort((ids, -scores)) if low <= scores[p] <= high][:10]
            assert got.tolist() == inside
        assert met < 4000
