"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a seed, a run of ``MIN_TILE`` words found by a rolling
hash, are tiled: the longest common run whose words are all unmarked is marked, again and
again. The share of an item's words under tiles is its coverage, in whatever order they stand.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.passes import add_columns
from panelwright.llm.text import _tables, grams, pieces, words

MIN_TILE = 5
COVERAGE = 0.5
# Bytes of benchmark text that one pass over the documents holds; a larger benchmark takes more passes.
CHUNK_BYTES = 32 << 20
# Entries of seeds that are listed for one text; one with more, as repeated words make them, is tiled length by length. The result is the same.
LISTED = 1 << 18


class Seeds:
    """The seeds of some benchmark items, ordered by hash. An item shorter than a tile is one seed of its own length."""

    def __init__(self, ids: list, texts: list[bytes], tile: int):
        self.ids, self.tile = ids, tile
        hashes, begins = words(texts, lower=True) if texts else (np.empty(0, np.uint64), np.zeros(1, int))
        self.items = [hashes[begins[i]:begins[i + 1]] for i in range(len(ids))]
        self.short = sorted({len(t) for t in self.items if 0 < len(t) < tile})
        self.by_length = {}
        for n in [*self.short, tile]:
            own = [(i, t) for i, t in enumerate(self.items) if (len(t) >= tile if n == tile else len(t) == n)]
            keys = [grams(t, n) for _, t in own]
            if not own:
                continue
            key = np.concatenate(keys)
            item = np.repeat([i for i, _ in own], [len(k) for k in keys])
            pos = np.concatenate([np.arange(len(k)) for k in keys])
            order = np.lexsort((pos, item, key))
            maybe = np.zeros(1 << 20, dtype=bool)
            maybe[key & np.uint64((1 << 20) - 1)] = True
            self.by_length[n] = key[order], item[order], pos[order], maybe

    def shared(self, hashes: np.ndarray):
        """Places in a run of words that begin a seed: ``(length, places, first entry of the seed, number of its entries)``."""
        for n, (key, _, _, maybe) in self.by_length.items():
            g = grams(hashes, n)
            at = np.flatnonzero(maybe[g & np.uint64((1 << 20) - 1)])
            low, high = np.searchsorted(key, g[at]), np.searchsorted(key, g[at], side="right")
            hit = high > low
            if hit.any():
                yield n, at[hit], low[hit], (high - low)[hit]

    def entries(self, n: int, at: np.ndarray, low: np.ndarray, many: np.ndarray):
        """``(place in the run, item, place in the item)`` for each entry of the seeds at ``at``."""
        _, item, pos, _ = self.by_length[n]
        index = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.repeat(at, many), item[index], pos[index]

    def items_of(self, n: int, low: np.ndarray, many: np.ndarray) -> np.ndarray:
        """The items that have any of the seeds, each seed looked at once."""
        first, which = np.unique(low, return_index=True)
        item = self.by_length[n][1]
        return np.unique(np.concatenate([np.unique(item[f:f + m]) for f, m in zip(first.tolist(), many[which].tolist(), strict=True)]))


def tiles(in_doc: np.ndarray, in_item: np.ndarray, tile: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from the places of shared seeds: ``(place in item, place in document, words)``, longest first.

    Seeds next to each other on one diagonal join to maximal matches. Of equally long ones the first in the
    item, then in the document, is taken. A match that has lost words to a tile goes on with the rest of it.
    """
    order = np.lexsort((in_item, in_doc - in_item))
    d, i = in_doc[order], in_item[order]
    fresh = np.flatnonzero(np.concatenate([[True], (np.diff(d) != 1) | (np.diff(i) != 1)]))
    lengths = np.diff(np.concatenate([fresh, [len(d)]])) + tile - 1
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(lengths, i[fresh], d[fresh], strict=True)]
    heapq.heapify(heap)
    item_marked, doc_marked, out = set(), set(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        free = [a + k not in item_marked and b + k not in doc_marked for k in range(-n)]
        if all(free):
            out.append((a, b, -n))
            item_marked.update(range(a, a - n))
            doc_marked.update(range(b, b - n))
            continue
        start = None
        for k, ok in enumerate([*free, False]):
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= tile:
                    heapq.heappush(heap, (start - k, a + start, b + start))
                start = None
    return out


class _Runs:
    """Hashes of all runs of any length in a text, from one running sum."""

    def __init__(self, hashes: np.ndarray):
        self.n = len(hashes)
        up, self.down = _tables(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(hashes * up[:self.n], out=self.sums[1:])
        self.free = np.ones(self.n, bool)

    def unmarked(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the runs of ``n`` unmarked words, and their hashes."""
        if n > self.n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        held = np.concatenate([[0], np.cumsum(self.free)])
        at = np.flatnonzero(held[n:] - held[:-n] == n)
        return at, (self.sums[at + n] - self.sums[at]) * self.down[at]


def tiles_by_length(doc: np.ndarray, item: np.ndarray, tile: int) -> list[tuple[int, int, int]]:
    """What ``tiles`` gives, for texts that share so many seeds that their matches can't be listed.

    The longest length at which unmarked runs agree is found by bisection over hashes of all runs of a length, then all tiles of it are
    laid in order. Lengths that lay a tile use up the item's words, so there are at most about the square root of twice its words of them.
    """
    d, i, out, longest = _Runs(doc), _Runs(item), [], min(len(doc), len(item))

    def agree(n: int) -> bool:
        return bool(np.isin(i.unmarked(n)[1], d.unmarked(n)[1]).any())
    while longest >= tile and agree(tile):
        low, high = tile, longest
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if agree(middle) else (low, middle - 1)
        n = low
        at, hashes = i.unmarked(n)
        places, keys = d.unmarked(n)
        order = np.lexsort((places, keys))
        places, keys = places[order], keys[order]
        first, last = np.searchsorted(keys, hashes), np.searchsorted(keys, hashes, side="right")
        next_of: dict[int, int] = {}
        end = 0
        for k in np.flatnonzero(last > first).tolist():
            a = int(at[k])
            if a < end:
                continue
            f = int(first[k])
            p = next_of.get(f, f)
            # tiles laid meanwhile have the same length, so one that meets a run covers one of its ends
            while p < last[k] and not (d.free[places[p]] and d.free[places[p] + n - 1]):
                p += 1
            next_of[f] = p
            if p < last[k]:
                b = int(places[p])
                out.append((a, b, n))
                i.free[a:a + n] = d.free[b:b + n] = False
                end = a + n
        longest = n - 1
    return out


def _covering(pos: np.ndarray, n: int) -> int:
    """Words under runs of ``n`` words that begin at ``pos``."""
    return len(np.unique((np.unique(pos)[:, None] + np.arange(n)).ravel()))


def _tiler(seeds: Seeds, least: float):
    """For each text the item it covers most (coverage, id, words covered, tiles as flat triples), and ids, coverages and
    tiles of all items that it covers by ``least`` or more."""
    def compute(texts: list[bytes]) -> list[list]:
        best = [(0.0, None, 0, [])] * len(texts)
        which = [len(seeds.ids)] * len(texts)
        listed: list[list] = [[] for _ in texts]

        def settle(k: int, item: int, covering: int, lay) -> None:
            """Tile one text with one item, unless its seeds alone cover too little to be listed or to beat what is known."""
            size = len(seeds.items[item])
            if covering / size < least and (covering / size, -item) <= (best[k][0], -which[k]):
                return
            laid = lay()
            covered = sum(t[2] for t in laid)
            flat = [x for t in laid for x in t]
            if covered / size >= least:
                listed[k].append((seeds.ids[item], covered / size, flat))
            if (covered / size, -item) > (best[k][0], -which[k]):
                best[k], which[k] = (covered / size, seeds.ids[item], covered, flat), item

        for first, some in pieces(texts):
            hashes, begins = words(some, lower=True)
            for n, at, low, many in seeds.shared(hashes):
                of = np.searchsorted(begins, at, side="right") - 1
                inside = at + n <= begins[of + 1]
                of, at, low, many = of[inside], at[inside], low[inside], many[inside]
                weight = np.bincount(of, many, len(some))
                for doc in np.flatnonzero(weight > LISTED).tolist():
                    # the seeds of this text have too many entries to list them all
                    text = hashes[begins[doc]:begins[doc + 1]]
                    own = np.unique(grams(text, n))
                    for item in seeds.items_of(n, low[of == doc], many[of == doc]).tolist():
                        pos = np.flatnonzero(np.isin(grams(seeds.items[item], n), own))
                        settle(first + doc, item, _covering(pos, n), lambda: tiles_by_length(text, seeds.items[item], n))
                weight[weight > LISTED] = 0
                batch = (np.cumsum(weight) // LISTED).astype(np.int64)[of]
                light = weight[of] > 0
                for k in np.unique(batch[light]):
                    use = light & (batch == k)
                    place, item, pos = seeds.entries(n, at[use], low[use], many[use])
                    doc = np.searchsorted(begins, place, side="right") - 1
                    place = place - begins[doc]
                    order = np.lexsort((item, doc))
                    doc, place, item, pos = doc[order], place[order], item[order], pos[order]
                    cut = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0)]))
                    for s, e in zip(cut, [*cut[1:], len(doc)], strict=True):
                        settle(first + int(doc[s]), int(item[s]), _covering(pos[s:e], n), lambda: tiles(place[s:e], pos[s:e], n))
        every = [sorted(x) for x in listed]
        return [*([b[k] for b in best] for k in range(4)), *([[x[k] for x in some] for some in every] for k in range(3))]
    return compute


_BEST = ["coverage", "item_id", "n_covered", "tiles"]
_LISTED = ["items", "item_coverage", "item_tiles"]


def coverage(docs: DataFrame, benchmark: DataFrame, tile: int = MIN_TILE, drop: tuple[str, ...] = (), least: float = COVERAGE) -> DataFrame:
    """``docs`` with the benchmark item it covers most, ``coverage, item_id, n_covered, tiles``, and with all items that it
    covers by ``least`` or more, ``items, item_coverage, item_tiles``: arrays of one length, in order of the ids.

    Tiles are given as place in the item, place in the document and words of each, one after the other.
    Words are compared with A-Z in lower case. An item below ``tile`` words must occur as a whole; items
    without words are left out. Of equal coverage the item with the smaller id counts as the best. NULL and empty texts, and all
    texts where the benchmark is empty, have coverage 0 and no item. Rows of ``docs`` that repeat are each tiled, equal rows of
    the benchmark are one item; columns of the same names
    are replaced. The benchmark is held in chunks of ``CHUNK_BYTES``, each in its own pass over the documents.
    """
    items = benchmark.where(F.length("text") > 0).select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = -(-size // CHUNK_BYTES)
    known = [*_BEST, *_LISTED]
    out = docs.select(*[c for c in docs.columns if c not in known]).withColumns({
        "coverage": F.lit(0.0), "item_id": F.lit(None).cast("long"), "n_covered": F.lit(0).cast("long"),
        "tiles": F.array().cast("array<bigint>"), "items": F.array().cast("array<bigint>"),
        "item_coverage": F.array().cast("array<double>"), "item_tiles": F.array().cast("array<array<bigint>>")})
    for k in range(chunks):
        held = sorted({(r[0] if r[0] is not None else -1, bytes(r[1]))
                       for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == k).distinct().collect()})
        if chunks == 1:
            return _one(docs.select(*[c for c in docs.columns if c not in known]), held, tile, least, drop)
        new = _one(out, held, tile, least, (), "_")
        better = (F.col("_coverage") > F.col("coverage")) | ((F.col("_coverage") == F.col("coverage")) & (F.col("_item_id") < F.col("item_id")))
        out = new.withColumns({c: F.when(better, F.col(f"_{c}")).otherwise(F.col(c)) for c in _BEST}
                              | {c: F.concat(c, f"_{c}") for c in _LISTED}).drop(*[f"_{c}" for c in known])
    every = F.array_sort(F.arrays_zip(*_LISTED))  # by id over all chunks
    return out.withColumns({c: every[c] for c in _LISTED}).drop(*drop)


def _one(docs: DataFrame, held: list[tuple[int, bytes]], tile: int, least: float, drop: tuple[str, ...], prefix: str = "") -> DataFrame:
    ids, texts = [r[0] for r in held], [r[1] for r in held]
    kinds = ["double", "long", "long", "array<bigint>", "array<bigint>", "array<double>", "array<array<bigint>>"]
    added = ", ".join(f"{prefix}{c} {k}" for c, k in zip([*_BEST, *_LISTED], kinds, strict=True))
    return add_columns(docs, "text", added, lambda: _tiler(Seeds(ids, texts, tile), least), drop)


def keep_clean(docs: DataFrame, benchmark: DataFrame, least: float = COVERAGE, tile: int = MIN_TILE) -> DataFrame:
    """``docs`` without those that cover at least ``least`` of an item; one pass over the texts, which lists no further items."""
    return coverage(docs, benchmark, tile, least=math.inf).where(F.col("coverage") < least).select(*docs.columns)
