"""Operators on documents against plain versions, and with odd rows: NULLs, empty and long texts, repeats, clashing columns."""

import collections
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest

from panelwright.llm import (deleted_interpolation, jaccard_regions, line_spread, mixing, page_text, pii, quality, seed_extend,
                             string_tiling, text)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, label string, `set` string, n string"


def docs_of(spark, rows):
    """From ``(id, text, source)``, with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y", "z", "n") for i, t, s in rows], SCHEMA).repartition(3)


ODD = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (None, "no id here at all, none", "b"), (4, "word", "b"), (4, "word", "b"),
       (5, " x   y\x85z", "c"), (6, "Long " * 30_000, "c"), (7, "tie tie tie tie tie tie tie tie tie tie tie tie tie tie", "c")]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(v)}" for v in np.minimum(rng.zipf(1.3, n), vocabulary))


@pytest.fixture(scope="module")
def corpus():
    """Documents with exact and near copies, shared passages and a hot line."""
    rng = np.random.default_rng(3)
    rows = [(i, prose(rng, int(rng.integers(1, 120))), f"s{i % 7}") for i in range(160)]
    passage = " ".join(f"p{k}" for k in range(40))
    for i in range(160, 200):
        words = words_of(rows[i % 9 + 20][1])
        for k in range(0, len(words), 37):
            words[k] = f"edit{i}"
        rows.append((i, " ".join(words), f"s{i % 5}"))
    rows += [(i, rows[40][1], "s1") for i in range(200, 212)]
    rows += [(i, f"{prose(rng, 20)} {passage[i % 3:]} {prose(rng, 9)}", "s0") for i in range(212, 240)]
    return [*rows, *ODD]


def collected(df, key="doc_id"):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r[key]].append(r)
    return out


def test_components(spark, corpus, monkeypatch):
    def sets(text):
        w = [x.lower() if x.isascii() else x for x in words_of(text)]
        return frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    s = [(i, sets(t)) for i, t, _ in corpus]
    parent = list(range(len(s)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for a, b in itertools.combinations(range(len(s)), 2):
        x, y = s[a][1], s[b][1]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            parent[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(s):
        if i is not None:
            least[find(k)].append(i)
    want = sorted((str(i), len(x), str(min(least[find(k)], default=None) if x else i)) for k, (i, x) in enumerate(s))
    for block in (512, 2):
        monkeypatch.setattr(jaccard_regions, "BLOCK", block)
        got = jaccard_regions.near_duplicates(docs_of(spark, corpus)).collect()
        assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == want
    kept = jaccard_regions.keep_first(docs_of(spark, corpus))
    assert len(kept.columns) == 9
    gone = {i for i, _, c in want if c != i and i != "None"}
    assert sorted(str(r[0]) for r in kept.select("doc_id").collect()) == sorted(str(i) for i, _, _ in corpus if str(i) not in gone)


def test_chain_of_unlike_sets_that_share_a_hot_passage(spark, monkeypatch):
    """Texts that are mostly one passage: regions with many components, whose members meet in groups."""
    hot = [f"h{k}" for k in range(30)]
    rows = [(i, " ".join(hot[i % 4:] + [f"x{i}_{k}" for k in range(9 + i % 3)]), "s") for i in range(60)]
    rows += [(100 + i, rows[i][1] + " tail", "s") for i in range(0, 60, 7)]
    monkeypatch.setattr(jaccard_regions, "BLOCK", 5)
    got = {r[0]: r[2] for r in jaccard_regions.near_duplicates(docs_of(spark, rows)).collect()}
    sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t, _ in rows)}
    want = {i: min([j for j in sets if 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])]) for i in sets}
    assert got == want


def test_frames_stay_small_where_regions_are_large(spark, monkeypatch, tmp_path):
    """Members of large regions are replicated to many groups; no call gets many more rows than a bucket should have."""
    rows = [(i, " ".join([f"h{k}" for k in range(36)] + [f"x{i}_{k}" for k in range(8)]), "s") for i in range(150)]
    join, folder = jaccard_regions._join_groups, str(tmp_path)

    def spied(frame, texts):
        with open(f"{folder}/{frame['bucket'].iloc[0]}", "w") as f:
            f.write(str(len(frame)))
        return join(frame, texts)
    monkeypatch.setattr(jaccard_regions, "BLOCK", 5)
    monkeypatch.setattr(jaccard_regions, "BUCKET_ROWS", 300)
    monkeypatch.setattr(jaccard_regions, "_join_groups", spied)
    got = {r[0]: r[2] for r in jaccard_regions.near_duplicates(docs_of(spark, rows)).collect()}
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert sum(sizes) > 5000 and max(sizes) < 2 * 300
    assert got == {i: i for i in range(150)}


def test_repeats(spark, corpus):
    first = {}
    for i, t, _ in corpus:
        w = words_of(t)
        for j in range(len(w) - 12):
            key = tuple(w[j:j + 13])
            first[key] = min(first.get(key, 1 << 70), 1 << 60 if i is None else i)
    want = []
    for i, t, _ in corpus:
        w = words_of(t)
        gone = set()
        for j in range(len(w) - 12):
            if first[tuple(w[j:j + 13])] < (1 << 60 if i is None else i):
                gone.update(range(j, j + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    got = seed_extend.remove_repeats(docs_of(spark, corpus), texts=True).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    assert sum(w[2] for w in want) > 1000


def test_language_model(spark, corpus):
    tokens = {k: [x.lower() if x.isascii() else x for x in words_of(t)] + [""] for k, (_, t, _) in enumerate(corpus)}
    held = {k: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for k, (i, _, _) in enumerate(corpus)}
    counts = collections.Counter(x for k, w in tokens.items() if not held[k] for x in w)
    n, v = sum(counts.values()), len(counts)
    rows = deleted_interpolation.score_texts(docs_of(spark, corpus)).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)
    want = sorted((str(corpus[k][0]), held[k], len(w), sum(counts[x] > 0 for x in w), n,
                   round(sum(np.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 5)) for k, w in tokens.items())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], atol=1e-3)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    # the same scores from plain counts, order by order
    part = {k: 0 if i is None else zlib.crc32(str(i).encode()) % 5 for k, (i, _, _) in enumerate(corpus)}
    padded = {k: ["<", "<", *w] for k, w in tokens.items()}

    def grams_of(docs, length):
        return collections.Counter(tuple(w[j - length + 1:j + 1]) for k in docs for w in [padded[k]] for j in range(2, len(w)))

    def contexts_of(docs, length):
        return collections.Counter(tuple(w[j - length + 1:j]) for k in docs for w in [padded[k]] for j in range(2, len(w)))

    def model(docs):
        one = grams_of(docs, 1)
        return sum(one.values()), len(one), one, {m: (grams_of(docs, m), contexts_of(docs, m)) for m in (2, 3)}

    def chance(w, j, known, weights):
        total, different, one, more = known
        p = (one[(w[j],)] + 0.5) / (total + 0.5 * (different + 1))
        for m, weight in zip((2, 3), weights):
            both, context = more[m][0][tuple(w[j - m + 1:j + 1])], more[m][1][tuple(w[j - m + 1:j])]
            if context:
                share = weight[min(deleted_interpolation.BUCKETS - 1, context.bit_length() - 1)]
                p = share * both / context + (1 - share) * p
        return p
    for order in (2, 3):
        less, weights = model([k for k in tokens if part[k] not in (1, 2)]), []
        for m in range(2, order + 1):
            seen = collections.Counter()
            for k in (k for k in tokens if part[k] == 2):
                for j in range(2, len(padded[k])):
                    w = padded[k]
                    both, context = less[3][m][0][tuple(w[j - m + 1:j + 1])], less[3][m][1][tuple(w[j - m + 1:j])]
                    if context:
                        step = np.log(both / context / chance(w, j, less, weights)) if both else None
                        place = -1 if step is None else int(np.clip((step - deleted_interpolation.LOWEST) / deleted_interpolation.BIN, 0, deleted_interpolation.BINS - 1))
                        seen[context.bit_length() - 1, place] += 1
            weights.append(deleted_interpolation.learn_weights(sorted((a, b, c) for (a, b), c in seen.items())))
        whole = model([k for k in tokens if part[k] != 1])
        want = sorted((str(corpus[k][0]), len(w) - 2, sum(np.log10(chance(w, j, whole, weights)) for j in range(2, len(w)))) for k, w in padded.items())
        rows = deleted_interpolation.score_texts(docs_of(spark, corpus), order).collect()
        got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in rows)
        assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-4, atol=1e-2)
    # a distribution: what follows one context sums to less than 1
    weights = deleted_interpolation.learn_weights([(0, -1, 10), (3, 200, 50), (3, -1, 50)])
    assert 0 < weights[0] < 0.2 and 0.3 < weights[3] < 0.6


def test_base_spans(spark):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def fits(kind, s):
        digits = re.sub("[^0-9]", "", s)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
                "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
    rng = random.Random(5)
    texts = ["".join(rng.choice("aé1234 .-@+()_4111") for _ in range(rng.randrange(120))) for _ in range(3000)]
    texts += ["a@b.c_d@e.f", "a@b@c.d", "x 4111 1111 1111 1111 y", "4111111111111111", "+1 (555) 010-9999 63.51.224.77", "1.2.3.4.5.6.7.8", "0256.1.1.1",
              "mail joe (at) site (dot) com", "a" * 100_000 + "@b.cc", "1" * 50_000, None, ""]
    rows = pii.find_private(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if len(texts[r.doc_id] or "") > 10_000:  # too long for the plain patterns
            continue
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p in patterns.items() for m in re.finditer(p, texts[r.doc_id] or "") if fits(k, m[0])]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(",")) | {""}
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(spans)
    by_id = {r.doc_id: r.spans for r in rows}
    n = len(texts)
    assert by_id[n - 4] == "email:0:100005"
    assert by_id[n - 3] == ""


def test_added_spans(spark):
    texts = [f"call +1 (555) 010-{1000 + i} or write a{i}@mail{i % 9}.com from 10.2.{i % 9}.{i}" for i in range(120)]
    texts += ["or +1 (555) 010-9999 63.51.224.77 it", "write joe (at) site (dot) com", "version 300.2.1.4 of", "they meet at noon. It is"]
    got = {r.doc_id: (r.spans, r.n_added) for r in pii.find_private(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert all(got[i][1] == 0 and got[i][0].count(":") == 6 for i in range(120))
    assert got[120] == ("ip:21:33,phone:3:20", 1)  # the base pattern for phones runs on into the address
    assert got[121] == ("email:6:29", 1) and got[122] == got[123] == ("", 0)


def test_spelt_addresses_are_proposed_whatever_stands_elsewhere():
    for a, z in ("[]", "()", "{}"):
        assert pii.candidates(f"write john {a}at{z} example.com")[0] == ("email", 6, 27, False)
    assert pii.candidates("write john at example dot com")[0][0] == "email"


def test_addresses_with_very_many_zeros():
    zeros = "0" * 5000
    assert ("ip", 0, 5007, True) in pii.candidates(f"{zeros}1.2.3.4")
    assert ("ip", 0, 5006, True) in pii.candidates(f"{zeros}.2.3.4")
    assert not any(x[3] for x in pii.candidates(f"{zeros}256.2.3.4"))


def test_reliabilities_tell_good_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.5
    said = np.stack([np.where(rng.random(4000) < p, truth, ~truth) * 2 - 1 for p in (0.95, 0.9, 0.6, 0.55, 0.8, 0.7)], axis=1)
    right, post = pii.reliabilities(np.zeros(4000, int), said, np.ones(4000))
    assert right[0] > right[4] > right[3] and ((post > 0.5) == truth).mean() > 0.93


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), ["a", "b", "c", "d", None][min(4, rng.randrange(8))]) for i in range(1500)]
    rows += [(7000, "same row twice", "a")] * 2 + [(None if i is None else i + 8000, t, s) for i, t, s in ODD]
    size, n = collections.Counter(), {}
    for i, t, s in rows:
        size[s] += len(words_of(t))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(size.values()), list(names), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= 2 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
            open_.remove(s)
    target |= {s: level * weight[s] for s in open_}
    docs = docs_of(spark, rows)
    got = mixing.allotments(docs).collect()
    assert sorted(r.size for r in got) == sorted(len(words_of(t)) for _, t, _ in rows)
    taken = collections.Counter()
    source = {(i, len(words_of(t))): s for i, t, s in rows}
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == size[s] and abs(r.target - target[s]) < 1e-6 and r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        n[s] = max(n.get(s, 0), r.size)
    for s in names:
        assert abs(taken[s] - target[s]) <= max(60, 2 * n[s])
    assert sum(taken.values()) <= 1.5 * sum(size.values())
    again = mixing.allotments(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    # the queue itself: every source in the order of its keys, twice, and all copies by finish time up to the budget
    keyed = mixing._keyed(docs, 7).select("doc_id", "text", "source", "_size", "_row", "_uid").collect()
    copies = []
    for s in names:
        reached = 0
        for r in sorted((r for r in keyed if r.source == s and r._size), key=lambda r: (r._row, r._uid)):
            reached += r._size
            copies += [((reached + k * size[s]) / target[s], s is not None, s or "", k, r._row, r._uid, r) for k in (0, 1) if reached + k * size[s] - r._size < target[s]]
    total, plain = 0, collections.Counter()
    for c in sorted(copies, key=lambda c: c[:6]):
        total += c[-1]._size
        if total <= 1.5 * sum(size.values()):
            plain[c[-1].doc_id, c[-1].text, c[-1].source, c[3]] += 1
    mixed = mixing.mix(docs)
    rows_of = mixed.collect()
    assert collections.Counter((r.doc_id, r.text, r.source, r["round"]) for r in rows_of) == plain
    of_doc = collections.Counter()
    for (i, t, _, _), k in plain.items():
        of_doc[i, len(words_of(t))] += k * len(words_of(t))
    held = collections.Counter()
    for r in got:
        held[r.doc_id, r.size] += r.taken
    assert +held == +of_doc
    for s in names:     # finish times follow the queue
        own = sorted((r["round"], r.virtual_finish) for r in rows_of if r.source == s)
        assert all(0 <= f <= 2 * size[s] / target[s] + 1e-9 for _, f in own) and max([f for k, f in own if k == 0], default=0) <= min([f for k, f in own if k], default=9e9)
    assert mixed.columns[:2] == ["doc_id", "text"] and mixed.columns.count("size") == 1
    assert sum(len(words_of(r.text)) for r in mixed.collect()) == sum(taken.values())


def test_mix_takes_some_of_equal_rows(spark):
    rows = [(5, "equal words in every row", "hot")] * 90 + [(i + 10, f"word {i} " * 3, "a") for i in range(30)]
    docs = docs_of(spark, rows).repartition(6)
    total = sum(len(words_of(t)) for _, t, _ in rows)
    mixed = mixing.mix(docs, share=0.4, most=2.0).collect()
    taken = mixing.allotments(docs, share=0.4, most=2.0).collect()
    assert 0 < sum(r.source == "hot" for r in mixed) < 90
    assert sum(r.size for r in mixed) == sum(r.taken for r in taken) <= 0.4 * total


def test_lines(spark):
    hot, rows = "  Subscribe to our newsletter ", []
    for i in range(60):
        rows.append((i, f"own line {i}\n{hot if i % 2 else hot.strip()}\n\nlocal {i % 3}", f"site{i % 9}" if i % 9 else None))
    rows += [(i + 100, f"two sites\nown {i}", f"site{i % 2}") for i in range(30)] + [(None if i is None else i + 1000, t, s) for i, t, s in ODD]
    got = collected(line_spread.remove_boilerplate(docs_of(spark, rows)).select("doc_id", "text", "n_lines", "n_removed", "n_chars"))
    assert got[0][0].text == rows[0][1]
    for i in range(1, 60):
        # the local lines stand on three sites only
        kept = [x for x in rows[i][1].split("\n") if "Subscribe" not in x]
        assert got[i][0].text == "\n".join(kept) and (got[i][0].n_lines, got[i][0].n_removed) == (4, 1)
    assert all(got[i][0].n_removed == 0 for i in range(100, 130))
    assert got[1001][0].text is None and got[1001][0].n_lines == 0 and got[1002][0].text == ""
    assert len(got[1004]) == 2 and len(line_spread.remove_boilerplate(docs_of(spark, rows)).columns) == 11


def tiled(doc, item, tile):
    """Greedy string tiling, plainly."""
    d, p = [False] * len(doc), [False] * len(item)
    out = 0
    while True:
        best = (tile - 1, 0, 0)
        for a in range(len(item)):
            for b in range(len(doc)):
                k = 0
                while a + k < len(item) and b + k < len(doc) and item[a + k] == doc[b + k] and not p[a + k] and not d[b + k]:
                    k += 1
                if k > best[0]:
                    best = (k, a, b)
        if best[0] < tile:
            return out
        k, a, b = best
        p[a:a + k], d[b:b + k] = [True] * k, [True] * k
        out += k


def test_tiling(spark, monkeypatch):
    rng = np.random.default_rng(8)
    items = [(k, " ".join(f"t{int(v)}" for v in rng.integers(0, 12, int(rng.integers(6, 26))))) for k in range(8)]
    items += [(8, "two words"), (9, ""), (10, None), (11, items[0][1])]
    rows = [(i, " ".join(f"T{int(v)}" for v in rng.integers(0, 12, int(rng.integers(1, 60)))), "s") for i in range(40)]
    w = items[3][1].split()
    rows += [(50, "before " + " ".join(w[8:]) + " between " + " ".join(w[:8]) + " after", "s"), (51, "has two words inside", "s"), *ODD]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t, _ in rows:
        d = [x.lower() if x.isascii() else x for x in words_of(t)] if len(t or "") < 10_000 else ["long"]
        best = (0.0, None)
        for k, x in items:
            p = words_of(x)
            if p:
                c = tiled(d, p, min(3, len(p))) / len(p)
                if c > best[0]:
                    best = (c, k)
        want[i, t] = best
    for chunk in (1 << 25, 200):
        monkeypatch.setattr(string_tiling, "CHUNK_BYTES", chunk)
        got = string_tiling.coverage(docs_of(spark, rows), bench, tile=3).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (round(r.coverage, 9), r.item_id) == (round(want[r.doc_id, r.text][0], 9), want[r.doc_id, r.text][1])
    kept = string_tiling.keep_clean(docs_of(spark, rows), bench)
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert 50 not in ids and 51 not in ids and len(kept.columns) == 9
    none = string_tiling.coverage(docs_of(spark, rows), bench.limit(0)).collect()
    assert len(none) == len(rows) and all(r.coverage == 0 and r.item_id is None for r in none)


def plain_tiles(doc, item, tile):
    """Mark the longest agreeing run of unmarked words, the first in the item, then in the document, again and again."""
    free_d, free_i, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = (tile - 1, 0, 0)
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n] and free_i[a + n] and free_d[b + n]:
                    n += 1
                best = max(best, (n, -a, -b)) if n > best[0] else best
        n, a, b = best[0], -best[1], -best[2]
        if n < tile:
            return out
        out.append((a, b, n))
        free_i[a:a + n], free_d[b:b + n] = [False] * n, [False] * n


def test_tiles_of_repetitive_texts():
    rng = np.random.default_rng(12)
    for k in range(60):
        doc, item = (rng.integers(0, int(rng.integers(1, 4)), int(rng.integers(3, 40))) for _ in range(2))
        doc, item = text.mix(doc.astype(np.uint64)), text.mix(item.astype(np.uint64))
        tile = int(rng.integers(2, 5))
        want = plain_tiles(doc.tolist(), item.tolist(), tile)
        assert string_tiling.tiles_by_length(doc, item, tile) == want
        pairs = [(b, a) for a in range(len(item) - tile + 1) for b in range(len(doc) - tile + 1) if (item[a:a + tile] == doc[b:b + tile]).all()]
        if pairs:
            assert string_tiling.tiles(np.array([b for b, _ in pairs]), np.array([a for _, a in pairs]), tile) == want


def test_repeated_words_on_both_sides_take_moderate_time():
    rng = np.random.default_rng(13)
    two = " ".join(rng.choice(["no", "yes"], 20_000))
    texts = [b"same " * 20_000, b"a b c " * 7_000, two.encode(), b"same " * 300 + b"other"]
    seeds = string_tiling.Seeds([1, 2, 3], [b"same " * 20_000, b"same " * 400, two[30:].encode()], 5)
    compute = string_tiling._tiler(seeds, 0.5)
    started = time.time()
    share, item, covered, laid, items, *_ = compute(texts[:1])
    assert time.time() - started < 1
    assert (share, item, covered, laid, items) == ([1.0], [1], [20_000], [[0, 0, 20_000]], [[1, 2]])
    share, item, *_ = compute(texts[1:])
    assert item == [None, 3, 2] and share[1] == 1.0 and share[2] == 0.75 and time.time() - started < 20


def test_bytes_that_are_no_text(spark):
    df = spark.createDataFrame([(1, bytearray(b"mail a.b@c.de \xff\xfe end +1 555 123 4567")), (2, bytearray(b"\x80")), (3, None)], "doc_id long, raw binary")
    docs = df.select("doc_id", df["raw"].cast("string").alias("text"))
    rows = {r.doc_id: r for r in pii.find_private(docs).collect()}
    assert (rows[1].n_email, rows[1].n_phone, rows[2].n_email, rows[3].n_email) == (1, 1, 0, 0)
    pages = df.select(df["doc_id"].alias("page_id"), df["doc_id"].cast("string").alias("url"), df["raw"].cast("string").alias("html"))
    assert {r.page_id: len(r.text) == r.n_chars for r in page_text.extract(pages).collect()} == {1: True, 2: True, 3: True}


def test_every_item_of_a_page_is_listed(spark, monkeypatch):
    items = [(k, " ".join(f"q{k}_{j}" for j in range(12))) for k in range(6)]
    items += [(6, items[2][1]), (7, items[2][1]), (7, items[2][1]), (8, "Short one"), (9, f"{items[0][1]} and {items[1][1]}")]
    half = " ".join(items[3][1].split()[:6])
    rows = [(1, f"page {items[2][1]} x {items[5][1]} y {half} z short ONE", "s"), (2, items[4][1], "s"), (3, items[0][1], "s"),
            (4, " ".join(items[1][1].split()[:5]), "s"), *ODD]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {1: [2, 3, 5, 6, 7, 8], 2: [4], 3: [0], 4: []}
    for chunk in (1 << 25, 150):
        monkeypatch.setattr(string_tiling, "CHUNK_BYTES", chunk)
        got = string_tiling.coverage(docs_of(spark, rows), bench).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.text in {t for _, t, _ in rows[:4]}:
                assert r["items"] == want[r.doc_id]
            else:
                assert r["items"] == []
            assert len(r["items"]) == len(r.item_coverage) == len(r.item_tiles) and all(c >= 0.5 for c in r.item_coverage)
            assert bool(r["items"]) == (r.coverage >= 0.5) and (not r["items"] or r.item_tiles[r["items"].index(r.item_id)] == r.tiles)
        page = next(r for r in got if r.doc_id == 1 and r.text)
        assert page.item_id == 2 and page.item_coverage == [1.0, 0.5, 1.0, 1.0, 1.0, 1.0] and page.item_tiles[1] == [0, 27, 6]


def test_quality(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        text = " ".join(f"{w.upper()}!!" if bad else w for w in prose(rng, 120).split())
        rows.append((i, text, "s"))
        labels.append((i, 0 if bad else 1, 0))
    docs = docs_of(spark, rows + [(None if i is None else i + 10_000, t, s) for i, t, s in ODD])
    marks = spark.createDataFrame([*labels, *labels[:5], (None, 1, 0), (99_999, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(docs, marks).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 80 and all(r.predicted == (r.doc_id % 4 != 0) for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    kept = quality.keep_good(docs, marks)
    assert sorted(map(str, (r[0] for r in kept.select("doc_id").collect()))) == sorted(str(r.doc_id) for r in got if r.predicted)
    assert kept.columns == docs.columns
    assert {r.score for r in quality.quality_scores(docs, marks.where("quality = 1")).collect()} == {1.0}
    assert {r.score for r in quality.quality_scores(docs, marks.limit(0)).collect()} == {0.5}


def test_empty_tables(spark):
    docs = docs_of(spark, ODD).limit(0)
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for out in (pii.find_private(docs), mixing.allotments(docs), mixing.mix(docs), quality.quality_scores(docs, marks), deleted_interpolation.score_texts(docs),
                seed_extend.remove_repeats(docs), line_spread.remove_boilerplate(docs), string_tiling.coverage(docs, bench),
                jaccard_regions.near_duplicates(docs), jaccard_regions.keep_first(docs), quality.keep_good(docs, marks)):
        assert out.collect() == []
