"""Removal of passages that repeat across documents, by seed and extend.

Winnowed anchors, runs of ``ANCHOR`` words chosen so that every window of ``LENGTH`` words holds one, are the seeds: an
anchor that only one document has ends there. Around a shared anchor the match is extended to both sides by
windows of ``LENGTH`` words. Documents that agree on a window form a class, in which only the smallest id matters, so
that no pairs are made; adjoining windows make the maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import blocks as corpus
from panelwright.llm.text import grams, pieces, words

LENGTH = 13
ANCHOR = 5
_LAST = np.iinfo(np.int64).max


def _places(texts: list[bytes], length: int, anchor: int):
    """Over runs of texts: index of the first text, its word starts, and for every window of ``length`` words
    its start, text, hash and the hash of its anchor, the least of its seeds."""
    for first, some in pieces(texts):
        hashes, begins = words(some)
        n = len(hashes) - length + 1
        if n <= 0:
            yield first, begins, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
            continue
        seeds = grams(hashes, anchor)
        least = seeds[:n].copy()
        for j in range(1, length - anchor + 1):
            np.minimum(least, seeds[j:n + j], out=least)
        counts = np.diff(begins)
        text = np.repeat(np.arange(len(some)), counts)[:n]
        start = np.flatnonzero(np.arange(n) + length <= begins[text + 1])
        yield first, begins, start, text[start] + first, grams(hashes, length)[start], least[start]


def _ids(block: corpus.Block) -> np.ndarray:
    """Ids as numbers; a missing id comes after all others."""
    return np.array([_LAST if i is None else i for i in block.ids], dtype=np.int64)


def _least(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes in order, and the smallest and largest id of each."""
    order = np.lexsort((ids, hashes))
    h, d = hashes[order], ids[order]
    at = corpus.first_of_runs(h)
    return h[at], d[at], d[np.append(at[1:], len(d)) - 1] if len(d) else d


def _anchors(block: corpus.Block, length: int, anchor: int, n_slots: int):
    """Distinct anchors in asked order, and whether documents of this block already share one."""
    ids, found = _ids(block), []
    for _, _, _, text, _, least in _places(block.texts, length, anchor):
        if len(text):
            # one anchor serves a run of windows
            at = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])]))
            found.append((least[at], ids[text[at]]))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    hashes, low, high = _least(*(np.concatenate(x) for x in zip(*found, strict=True)))
    order = corpus.asked_order(hashes, n_slots)
    return hashes[order], (low != high)[order].astype(np.uint8)


def _shared(hashes: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, list[float]]:
    """Whether two documents have the anchor."""
    _, back, many = np.unique(hashes, return_inverse=True, return_counts=True)
    several = many > 1
    several |= np.bincount(back, weights=flags, minlength=len(many)) > 0
    return several[back].astype(np.uint8), []


def _windows(block: corpus.Block, length: int, anchor: int, n_slots: int):
    """For every run of texts its places, and all windows around a shared anchor: index of run, place, hash, id."""
    asked, _ = _anchors(block, length, anchor, n_slots)
    shared = np.sort(asked[block.answers["anchors"] > 0]) if len(asked) else asked
    ids, runs = _ids(block), []
    for first, begins, start, text, hashes, least in _places(block.texts, length, anchor):
        at = np.searchsorted(shared, least)
        hit = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == least) if len(shared) else np.empty(0, np.int64)
        runs.append((first, begins, start[hit], hashes[hit], ids[text[hit]]))
    hashes = np.concatenate([r[3] for r in runs]) if runs else np.empty(0, np.uint64)
    return runs, hashes, np.concatenate([r[4] for r in runs]) if runs else np.empty(0, np.int64)


def _ask_windows(block: corpus.Block, length: int, anchor: int, n_slots: int):
    _, hashes, ids = _windows(block, length, anchor, n_slots)
    h, low, _ = _least(hashes, ids)
    order = corpus.asked_order(h, n_slots)
    return h[order], low[order]


def _earlier(hashes: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, list[float]]:
    """Whether some block has the hash in a document with a smaller id."""
    order = np.lexsort((low, hashes))
    at = corpus.first_of_runs(hashes[order])
    least = np.repeat(low[order][at], np.diff(np.append(at, len(order))))
    out = np.empty(len(hashes), np.uint8)
    out[order] = low[order] > least
    return out, []


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, texts: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``, and ``kept`` (the words left) if ``texts``.

    Removes each word under a window of ``length`` words that also starts in a document with a smaller id, judged on
    the input. Words are compared as they are, by 64-bit hashes. NULL and empty texts have no words; a missing id
    comes after all others; rows with one id don't remove each other's words; further columns don't matter.
    """
    packed = corpus.pack(docs, F.lit(0))
    n_slots = corpus.slots(packed)
    anchors = corpus.ask(packed, "anchors", n_slots, lambda b: _anchors(b, length, anchor, n_slots), _shared)
    windows = corpus.ask(corpus.with_answers(packed, anchors), "windows", n_slots,
                         lambda b: _ask_windows(b, length, anchor, n_slots), _earlier)

    def strip(block: corpus.Block) -> Iterator[pa.RecordBatch]:
        runs, hashes, ids = _windows(block, length, anchor, n_slots)
        asked, low, _ = _least(hashes, ids)
        order = corpus.asked_order(asked, n_slots)
        earlier = np.zeros(len(asked), bool)
        earlier[order] = block.answers["windows"] > 0 if len(asked) else False
        at = np.searchsorted(asked, hashes)
        goes = earlier[at] | (low[at] < ids) if len(asked) else np.empty(0, bool)
        n_words, n_removed, digests, kept = [], [], [], []
        done = 0
        for k, (first, begins, start, own, _) in enumerate(runs):
            gone = start[goes[done:done + len(own)]]
            done += len(own)
            cover = np.zeros(begins[-1] + 1, np.int64)
            np.add.at(cover, gone, 1)
            np.add.at(cover, np.minimum(gone + length, begins[-1]), -1)
            stay = np.cumsum(cover)[:-1] == 0
            until = runs[k + 1][0] if k + 1 < len(runs) else len(block.texts)
            for i in range(first, until):
                s, e = begins[i - first], begins[i - first + 1]
                own_words = block.texts[i].split()
                left = stay[s:e]
                removed = int((e - s) - left.sum())
                text = b" ".join(own_words if not removed else [own_words[j] for j in np.flatnonzero(left)])
                n_words.append(len(own_words))
                n_removed.append(removed)
                digests.append(hashlib.sha256(text).hexdigest())
                if texts:
                    kept.append(text.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()),
             *([pa.array(kept, pa.string())] if texts else [])],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if texts else [])])
    return corpus.each(corpus.with_answers(packed, anchors, windows), strip,
                       "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)
