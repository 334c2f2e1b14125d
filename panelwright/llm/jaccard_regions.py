"""Exact components of documents whose sets of word shingles have a Jaccard similarity of at least 3/4.

1 - Jaccard is a metric. Distances between texts are mostly near 1, where no pivot can tell them apart, so regions
are first opened only around shingles that similar documents must share: of each set, the rarest
quarter of its shingles, by exact counts. In every region a pivot is compared with all members. Members within the threshold of it are
one component and need no more comparisons among each other. The others meet the members in the rings of pivot distance that the
triangle inequality leaves, in groups of bounded size; those near a border are replicated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm import blocks
from panelwright.llm.text import grams, mix, pieces, words
from panelwright.scale import at_most, attach, written

SHINGLE = 5
# Similarity of linked documents in hundredths, and the distance that belongs to it.
LEAST = 75
RADIUS = 1 - LEAST / 100
# Members of a region that meet in one task, on either side.
BLOCK = 512
# Rows of groups, members replicated, for each call that joins them.
BUCKET_ROWS = 4000
# Members that one text of a pivot is compared with, and texts that a task compares.
GROUP_MEMBERS, TASK_TEXTS = 256, 4000
# Ids (8 bytes each) up to which they are broadcast.
BROADCAST_IDS = 1_000_000

_DESCRIBED = ["doc_id", "n", "set", "region", "place"]
_SALT = np.uint64(0xA0761D6478BD642F)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For every text its distinct shingles, ordered; fewer words than ``size`` are one shingle, no words none."""
    for _, some in pieces(texts):
        hashes, begins = words(some, lower=True)
        every = grams(hashes, size)
        for s, e in zip(begins[:-1], begins[1:], strict=True):
            yield np.unique(every[s:e - size + 1]) if e - s >= size else grams(hashes[s:e], e - s) if e > s else hashes[:0]


def _set_id(shingles: np.ndarray) -> int:
    """One number for a set, whatever the order of its members."""
    return int(np.sum(mix(shingles ^ _SALT), dtype=np.uint64).astype(np.int64)) if len(shingles) else 0


def describe(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, set`` of every document, and ``region, set, n, place``: the shingles among the rarest quarter of a set that
    other sets may have as well, with their place in the order of rarity; both written.

    Blocks of documents ask slots how many sets have each of their shingles (a repeated set counts once in a block, so copies can only
    make a shingle look more frequent). Linked sets of sizes x <= y have o = 3(x + y)/7 shingles in common. So in any order common to all sets they share one
    that is among the first x - o + 1 of the one and the first y - o + 1 of the other; as x is at least 3y/4, the rarest quarter of a set holds all that can
    matter. What a single set has opens no region, and most rare shingles are of that kind.
    """
    packed = blocks.pack(docs, F.lit(0))
    n_slots = blocks.slots(packed)

    def distinct(block: blocks.Block) -> tuple[np.ndarray, np.ndarray]:
        seen, new = set(), []
        for shingles in shingle_sets(block.texts):
            one = _set_id(shingles)
            if len(shingles) and one not in seen:
                seen.add(one)
                new.append(shingles)
        return np.unique(np.concatenate(new), return_counts=True) if new else (np.empty(0, np.uint64), np.empty(0, np.int64))

    def question(block: blocks.Block) -> tuple[np.ndarray, np.ndarray]:
        hashes, counts = distinct(block)
        order = blocks.asked_order(hashes, n_slots)
        return hashes[order], np.minimum(counts[order], 255).astype(np.uint8)

    def answer(hashes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, list[float]]:
        order = np.argsort(hashes, kind="stable")
        first = blocks.first_of_runs(hashes[order])
        totals = np.add.reduceat(numbers[order].astype(np.int64), first) if len(first) else np.empty(0, np.int64)
        steps = np.minimum(255, np.round(8 * np.log2(totals))).astype(np.uint8)     # 0: one set
        out = np.empty(len(hashes), np.uint8)
        out[order] = np.repeat(steps, np.diff(np.append(first, len(hashes))))
        return out, []

    def post(block: blocks.Block) -> Iterator[pa.RecordBatch]:
        hashes, _ = distinct(block)
        steps = np.empty(len(hashes), np.uint8)
        if len(hashes):
            steps[blocks.asked_order(hashes, n_slots)] = block.answers["sets"]
        ids, many, sets, seen = [], [], [], set()
        region, of, size, place = [], [], [], []
        for i, shingles in zip(block.ids, shingle_sets(block.texts), strict=True):
            one, n = _set_id(shingles), len(shingles)
            ids.append(i)
            many.append(n)
            sets.append(one)
            if n and one not in seen:
                seen.add(one)
                own = steps[np.searchsorted(hashes, shingles)]
                order = np.argsort(own, kind="stable")[:n - (LEAST * n + 99) // 100 + 1]
                shared = np.flatnonzero(own[order])
                region.append(shingles[order[shared]].astype(np.int64))
                of += [one] * len(shared)
                size += [n] * len(shared)
                place.append(shared)
        none = pa.nulls(len(ids), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(many, pa.int64()), pa.array(sets, pa.int64()), none, none], names=_DESCRIBED)
        if of:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(of), pa.int64()), pa.array(size, pa.int64()), pa.array(of, pa.int64()),
                                              pa.array(np.concatenate(region)), pa.array(np.concatenate(place))], names=_DESCRIBED)
    # five bytes of a hash: two that agree in them count together, which only moves them in the order, in all sets alike
    answers = blocks.ask(packed, "sets", n_slots, question, answer, width=5)
    rows = written(blocks.each(blocks.with_answers(packed, answers), post, ", ".join(f"{c} long" for c in _DESCRIBED)))
    return rows.where("place IS NULL").select("doc_id", "n", "set"), rows.where("place IS NOT NULL").select("region", "set", "n", "place")


def regions(posted: DataFrame) -> DataFrame:
    """``region, set, n``: sets that have a region's shingle among their rarest quarter, where there are two or more.

    ``low`` is the size of a region's smallest set that could be the smaller of two; members whose shingle stands too late for any
    partner of that size or more go. Regions with the same members are kept once. All is counted before it is shuffled, so no
    task holds a region.
    """
    once = written(posted.groupBy("region", "set").agg(F.first("n").alias("n"), F.first("place").alias("place")))
    n, place = F.col("n"), F.col("place")
    low = once.groupBy("region").agg(F.min(F.when(place <= n - _overlap(n, n), n)).alias("_low"), F.count(F.lit(1)).alias("_many")).where("_many > 1")
    least = F.greatest("_low", F.ceil(n * LEAST / 100))
    near = written(attach(once, written(low), ["region"]).where(F.col("_many").isNotNull()).where(
        (place <= n - _overlap(n, n)) | (place <= n - _overlap(least, n))).select("region", "set", "n"))
    several = near.groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("set")).alias("a"),
                                         F.bit_xor(F.xxhash64(F.lit(1), F.col("set"))).alias("b")).where("members > 1")
    kept = written(several.groupBy("members", "a", "b").agg(F.min("region").alias("region")).select("region", F.lit(True).alias("_kept")))
    return written(attach(near, kept, ["region"]).where("_kept").drop("_kept"))


def _overlap(x: Column, y: Column) -> Column:
    """Shingles that linked sets of sizes ``x`` and ``y`` have in common at least."""
    return F.ceil((x + y) * LEAST / (100 + LEAST) - 1e-9)


def bodies(docs: DataFrame, described: DataFrame, members: DataFrame) -> DataFrame:
    """``set, body``: a compressed text for every set in a region, written. Rows that repeat an id can give a set several times, once in a task."""
    wanted = described.join(members.select("set").distinct(), "set").groupBy("set").agg(F.min("doc_id").alias("doc_id"))
    wanted = written(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, seen = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            sets, bodies = [], []
            for wanted_set, own, text in zip(batch.column(0).to_pylist(), shingle_sets(texts), texts, strict=True):
                # rows that share an id can have other texts
                if wanted_set not in seen and _set_id(own) == wanted_set:
                    seen.add(wanted_set)
                    sets.append(wanted_set)
                    bodies.append(packer.compress(text))
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.int64()), pa.array(bodies, pa.binary())], names=["set", "body"])
    few = at_most(wanted, BROADCAST_IDS)
    slim = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("binary").alias("text"))
    found = slim.join(F.broadcast(wanted) if few else wanted, F.col("_id").eqNullSafe(F.col("doc_id"))).select("set", "text")
    return written(found.mapInArrow(run, "set long, body binary"))


def distances(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b, inter, whole`` for distinct pairs ``a, b`` with the ``pivot`` among them, written: sizes of intersection and union.

    Members are dealt to groups of a pivot and a salt; the pivot's text comes once to each of its groups, a member's once for each pivot.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        group, pivot, seen = None, np.empty(0, np.uint64), None
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for key, salt, one, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ((key, salt), one) == (group, seen):
                    continue    # a set that several tasks have found
                own = next(shingle_sets([unpack.decompress(body)]))
                seen = one
                if (key, salt) != group:        # the pivot is the first of its group
                    group, pivot = (key, salt), own
                    continue
                both = np.concatenate([pivot, own])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                out.append((min(key, one), max(key, one), inter, len(both) - inter))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)], names=["a", "b", "inter", "whole"])
    many = pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("many"))
    dealt = pairs.join(many, "pivot").select("pivot", F.pmod(F.xxhash64("a", "b"), F.ceil(F.col("many") / GROUP_MEMBERS)).alias("salt"),
                                             F.when(F.col("a") == F.col("pivot"), F.col("b")).otherwise(F.col("a")).alias("set"))
    dealt = written(dealt)
    asked = dealt.unionByName(dealt.select("pivot", "salt", F.col("pivot").alias("set")).distinct())
    n = max(1, -(-asked.count() // TASK_TEXTS))
    ready = (asked.join(texts.hint("shuffle_merge"), "set").repartition(n, "pivot", "salt")
             .sortWithinPartitions("pivot", "salt", (F.col("set") != F.col("pivot")), "set").select("pivot", "salt", "set", "body"))
    return written(ready.mapInArrow(run, "a long, b long, inter long, whole long"))


def linked() -> Column:
    return F.col("inter") * 100 >= F.col("whole") * LEAST


def components(edges: DataFrame) -> DataFrame:
    """``set, label`` for every set on a link, written: labels are equal within a component.

    The least label goes over links and then over labels of labels, until nothing changes.
    """
    both = written(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("set"), F.least("a", "near").alias("label")))
    while True:
        near = (both.join(labels.withColumnRenamed("set", "b"), "b").groupBy("a").agg(F.min("label").alias("near")))
        stepped = labels.join(near.withColumnRenamed("a", "set"), "set").select("set", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        up = stepped.select(F.col("set").alias("label"), F.col("label").alias("over"))
        following = written(stepped.join(up, "label", "left").select("set", F.least("label", F.coalesce("over", "label")).alias("label"), "old"))
        if following.where(F.col("label") != F.col("old")).limit(1).count() == 0:
            return following.select("set", "label")
        labels = following.select("set", "label")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component, of regions that hold more than one, and whether they are ``outside`` the region's largest."""
    own = members.join(labels, "set", "left").withColumn("label", F.coalesce("label", "set"))
    sizes = own.groupBy("region", "label").agg(F.count(F.lit(1)).alias("size"))
    state = sizes.groupBy("region").agg(F.count(F.lit(1)).alias("labels"), F.sum("size").alias("members"), F.max(F.struct("size", "label")).alias("top"))
    state = state.where("labels > 1").select("region", "members", (F.col("members") - F.col("top.size")).alias("others"), F.col("top.label").alias("top"))
    return own.join(state, "region").withColumn("outside", F.col("label") != F.col("top")).drop("top")


def _parts(members: str) -> Column:
    return F.ceil(F.col(members) / BLOCK).cast("int")


def _ring_rows(rows: DataFrame) -> int:
    """Rows that ``_rings`` makes of these, or a few more."""
    many = _parts("others").cast("long") + F.when(F.col("outside"), 3 * _parts("members").cast("long")).otherwise(0)
    return rows.agg(F.sum(many)).first()[0] or 0


def _rings(rows: DataFrame) -> DataFrame:
    """Members in groups ``region, ring, part, with_part`` of bounded size, such that every member outside the largest component
    meets all that can be linked to it. ``alone``: the whole region fits a bucket.

    A ring holds the members whose distance from the pivot lies within one window. By the triangle inequality a link reaches no
    farther than the next ring, so a member outside is replicated to its own ring and the two beside it.
    """
    ring = F.floor(F.col("d") / (RADIUS + 1e-9)).cast("int")
    parts, with_parts = _parts("members"), _parts("others")
    part, with_part = (F.pmod(F.xxhash64("set"), n).cast("int") for n in (parts, with_parts))
    alone = F.col("members") * with_parts + 3 * F.col("others") * parts <= BUCKET_ROWS
    met = rows.select("region", ring.alias("ring"), part.alias("part"), F.explode(F.sequence(F.lit(0), with_parts - 1)).alias("with_part"),
                      "set", "label", F.lit(False).alias("asks"), alone.alias("alone"))
    asks = rows.where("outside").select("region", F.explode(F.sequence(ring - 1, ring + 1)).alias("ring"), parts.alias("_parts"), with_part.alias("with_part"),
                                        "set", "label", F.lit(True).alias("asks"), alone.alias("alone"))
    asks = asks.where("ring >= 0").select("region", "ring", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"), "with_part", "set", "label", "asks", "alone")
    return met.unionByName(asks)


_GROUP = ["region", "ring", "part", "with_part"]


def _join_groups(rows: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
    """Links between the members that ask and those they meet, group by group; of links that join the same two components, the first."""
    rows = rows.sort_values([*_GROUP, "asks", "set"])
    unpack = zstandard.ZstdDecompressor()
    once = texts.drop_duplicates("set")
    own = dict(zip(once["set"], shingle_sets([unpack.decompress(b) for b in once["body"]]), strict=True))
    group = rows[_GROUP].to_numpy()
    cuts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)]))
    asks, keys, labels = rows["asks"].to_numpy(), rows["set"].to_numpy(), rows["label"].to_numpy()
    out: list[tuple[int, int]] = []
    for s, e in zip(cuts, [*cuts[1:], len(rows)], strict=True):
        n = int((~asks[s:e]).sum())
        if 0 < n < e - s:
            out += _join_group(keys[s:e], labels[s:e], [own[k] for k in keys[s:e]], n)
    return pd.DataFrame(sorted(set(out)), columns=["a", "b"], dtype=np.int64)


def _join_group(keys: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], n: int) -> list[tuple[int, int]]:
    """The first ``n`` members are met by the others."""
    out = []
    sizes = np.array([len(x) for x in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    mark, joined = np.zeros(flat.max() + 1, np.int64), {}

    def find(x: int) -> int:
        while joined.get(x, x) != x:
            x = joined[x]
        return x
    for k in range(n, len(keys)):
        mine = flat[starts[k]:starts[k + 1]]
        mark[mine] = 1
        inter = np.add.reduceat(mark[flat[:starts[n]]], starts[:n])
        mark[mine] = 0
        for j in np.flatnonzero((inter * 100 >= (sizes[:n] + sizes[k] - inter) * LEAST) & (labels[:n] != labels[k])):
            p, q = find(int(labels[j])), find(int(labels[k]))
            if p != q:
                joined[p] = q
                out.append((min(int(keys[j]), int(keys[k])), max(int(keys[j]), int(keys[k]))))
    return out


def links(docs: DataFrame, described: DataFrame, posted: DataFrame) -> DataFrame:
    """Enough links ``a, b`` between sets to connect every component, written."""
    members = regions(posted)
    texts = bodies(docs, described, members)
    # one pivot for each region, the member that shares most shingles: an original rather than one of its edited copies.
    # Pairs that many regions have are compared once
    weights = members.groupBy("set").agg(F.count(F.lit(1)).alias("w"))
    pivots = members.join(weights, "set").groupBy("region").agg(F.max(F.struct("w", F.xxhash64("set").alias("h"), "set")).alias("p"))
    starred = members.join(pivots, "region").where(F.col("set") != F.col("p.set")).select("region", "set", F.col("p.set").alias("pivot"))
    starred = written(starred.withColumns({"a": F.least("set", "pivot"), "b": F.greatest("set", "pivot")}))
    known = distances(starred.groupBy("a", "b").agg(F.min("pivot").alias("pivot")), texts)
    d = known.select("a", "b", (1 - F.col("inter") / F.col("whole")).alias("d"))
    labels = components(known.where(linked()))
    rows = written(_open(starred.join(d, ["a", "b"]).select("region", "set", "d"), labels))
    # small groups share a task's call; a bucket has some thousand rows, counted as replicated, and a task about one bucket
    buckets = max(1, -(-_ring_rows(rows) // BUCKET_ROWS))
    met = written(_rings(rows).withColumn("bucket", F.pmod(F.when(F.col("alone"), F.xxhash64("region")).otherwise(F.xxhash64(*_GROUP)), F.lit(buckets))).drop("alone"))
    # a text comes once to each bucket that has its set
    asked = met.select(F.col("bucket").alias("at"), F.col("set").alias("one")).distinct()
    bodies_of = asked.join(texts.hint("shuffle_merge"), F.col("one") == F.col("set")).select("at", "set", "body")
    found = met.groupBy("bucket").cogroup(bodies_of.groupBy("at")).applyInPandas(_join_groups, "a long, b long")
    return written(known.where(linked()).select("a", "b").unionAll(found))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the smallest id reachable over links, its own included).

    Two documents are linked when their sets of distinct ``SHINGLE``-word shingles, A-Z in lower case, have a similarity of
    at least ``LEAST`` hundredths. NULL, empty and blank texts have no shingles and no links. Rows with the same set are
    linked, also if they repeat an id; a missing id is passed over where another is reachable. Further columns
    don't matter; an empty table gives no rows.
    """
    described, posted = describe(docs)
    found = links(docs, described, posted)
    labels = components(found)
    sets = described.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("first")).join(labels, "set", "left")
    sets = written(sets.withColumn("label", F.coalesce("label", "set")))
    least = sets.groupBy("label").agg(F.min("first").alias("component"))
    named = sets.join(least, "label").select("set", "component")
    return described.join(named, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without those that are linked, directly or not, to a document with a smaller id. Rows with one id stay or go together."""
    gone = written(near_duplicates(docs).where("component_id < doc_id").select("doc_id").distinct())
    return docs.join(F.broadcast(gone) if at_most(gone, BROADCAST_IDS) else gone, "doc_id", "left_anti").select(*docs.columns)
