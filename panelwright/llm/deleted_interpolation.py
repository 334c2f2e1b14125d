"""Scores of texts by a language model with deleted interpolation.

Maximum-likelihood estimates from n-grams of every order are mixed, each with the mixture of the orders below it and
the lowest with smoothed unigram estimates. How far an n-gram is trusted depends on how frequent its context is: contexts fall
into buckets by the logarithm of their count, and each bucket of an order has a weight, learned by expectation
maximisation on documents that were left out of the counts for it, order by order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import blocks as corpus
from panelwright.llm.text import mix, pieces, words

# Parts of the corpus, by crc32 of the id modulo 5: counted, counted but held out of the weights' model, only scored.
COUNTED, HELD, SCORED = 0, 1, 2
BUCKETS = 48
# Words of the longest n-gram.
ORDER = 3
# Bins of the logarithm of an n-gram's estimate over what the lower orders say, by which held-out tokens are counted.
BIN, LOWEST, BINS = 0.1, -15.0, 500
# Bytes of an n-gram's hash kept inside its slot; two of a million there share them once in a million.
NGRAM_BYTES = 5

_END, _START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_STEP = np.uint64(0x2545F4914F6CDD1D)


def _stream(block: corpus.Block, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the n-grams of 1 to ``order`` tokens that end at each token of a block, the places where texts start, and the tokens' texts.
    Each text ends in one token, and before it stand as many starts as an n-gram needs."""
    tokens, starts, texts = [], [], []
    at = 0
    for first, some in pieces(block.texts):
        hashes, begins = words(some, lower=True)
        tokens.append(np.insert(hashes, begins[1:], _END))
        starts.append(at + begins[:-1] + np.arange(len(some)))
        texts.append(np.repeat(np.arange(first, first + len(some)), np.diff(begins) + 1))
        at += len(tokens[-1])
    if not tokens:
        return [np.empty(0, np.uint64)] * order, np.empty(0, np.int64), np.empty(0, np.int64)
    grams, start = [np.concatenate(tokens)], np.concatenate(starts)
    for _ in range(order - 1):
        before = np.empty_like(grams[-1])
        before[1:] = grams[-1][:-1]
        before[start] = _START
        # the n-gram of one token less that ends a place before, and the token
        grams.append(mix(before * _STEP + grams[0]))
    return grams, start, np.concatenate(texts)


def _question(block: corpus.Block, n: int, n_slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams with their counts: positive if counted, negative if held, 0 if only scored."""
    hashes, many = np.unique(_stream(block, n)[0][-1], return_counts=True)
    order = corpus.asked_order(hashes, n_slots)
    return hashes[order], many[order].astype(np.int64) * {COUNTED: 1, HELD: -1, SCORED: 0}[block.kind]


def _totals(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[float]]:
    """Count in all training texts and, for held blocks, without the held ones; distinct and all tokens, for both."""
    kinds, back = np.unique(hashes, return_inverse=True)
    both = np.zeros((len(kinds), 2), np.int64)
    np.add.at(both[:, 0], back, np.abs(n))
    np.add.at(both[:, 1], back, np.maximum(n, 0))
    found = both[back]
    found[n >= 0, 1] = 0
    return found, [float((both[:, 0] > 0).sum()), float(both[:, 0].sum()), float((both[:, 1] > 0).sum()), float(both[:, 1].sum())]


def _counts(block: corpus.Block, order: int, n_slots: int, column: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Texts of the tokens, and for each token the counts of the n-grams that end there and of their contexts, from two words on."""
    grams, start, texts = _stream(block, order)
    found = []
    for n, hashes in enumerate(grams, 1):
        kinds, back = np.unique(hashes, return_inverse=True)
        many = np.empty(len(kinds), np.int64)
        if len(kinds):
            many[corpus.asked_order(kinds, n_slots)] = block.answers[str(n)][:, column]
        found.append(many[back])
    contexts = []
    for n in range(1, order):
        context = np.empty(len(texts), np.int64)
        context[1:] = found[n - 1][:-1]
        # a text starts as often as one ends
        context[start] = found[0][grams[0] == _END][:1]
        contexts.append(context)
    return texts, found, contexts


def _mixed(floor: np.ndarray, found: list[np.ndarray], contexts: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    """Probability of each token by the orders whose weights are known; a context that was never counted leaves it to the lower ones."""
    for many, context, of in zip(found[1:], contexts, weights):
        w = np.where(context > 0, of[_bucket(context)], 0.0)
        floor = w * many / np.maximum(1, context) + (1 - w) * floor
    return floor


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.log2(np.maximum(1, context)).astype(np.int64))


def learn_weights(held: list[tuple[int, int, int]], rounds: int = 100) -> np.ndarray:
    """Weight of an order's estimate for each bucket from counted ``(bucket, bin, tokens)``; bin -1 is an n-gram never seen."""
    weights = np.full(BUCKETS, 0.5)
    if not held:
        return weights
    bucket, bin_, n = (np.array(x) for x in zip(*held, strict=True))
    ratio = np.where(bin_ < 0, 0.0, np.exp(LOWEST + (bin_ + 0.5) * BIN))
    for _ in range(rounds):
        w = weights[bucket]
        part = n * w * ratio / (w * ratio + 1 - w)
        # one token more on either side keeps empty buckets in the middle and all weights inside (0, 1)
        weights = (np.bincount(bucket, part, BUCKETS) + 1) / (np.bincount(bucket, n, BUCKETS) + 2)
    return weights


def score_texts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns n-grams of up to ``order`` words from the documents whose crc32 of the id modulo 5 isn't 1; a NULL id is learnt from.
    NULL and empty texts are one token, the end. Repeated rows count as they stand; further columns don't matter; an empty
    table gives no rows. Where nothing can be learnt, the unigram floor scores alone.
    """
    part = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)), F.lit(0))
    packed = corpus.pack(docs, F.when(part == 1, SCORED).when(part == 2, HELD).otherwise(COUNTED))
    n_slots = corpus.slots(packed)

    def asked(n: int) -> DataFrame:
        return corpus.ask(packed, str(n), n_slots, lambda b: _question(b, n, n_slots), _totals, 8 if n == 1 else NGRAM_BYTES)
    answers = [asked(n) for n in range(1, order + 1)]
    kinds, n_train, kinds_less, n_less = corpus.tallies(answers[0], 4)
    weights: list[np.ndarray] = []
    for n in range(2, order + 1):
        def bins(block: corpus.Block) -> Iterator[pa.RecordBatch]:
            _, found, contexts = _counts(block, n, n_slots, 1)
            lower = _mixed((found[0] + 0.5) / (n_less + 0.5 * (kinds_less + 1)), found, contexts, weights)
            seen = contexts[-1] > 0
            context, many, lower = contexts[-1][seen], found[-1][seen], lower[seen]
            ratio = np.log(np.maximum(many, 1) / context / lower)
            bin_ = np.where(many > 0, np.clip((ratio - LOWEST) / BIN, 0, BINS - 1).astype(np.int64), -1)
            code, tokens = np.unique(_bucket(context) * (BINS + 1) + bin_ + 1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(tokens)], names=["code", "n"])
        own = corpus.with_answers(packed.where(F.col("kind") == HELD), *[x.where(F.col("part") == HELD) for x in answers[:n]])
        rows = corpus.each(own, bins, "code long, n long").groupBy("code").agg(F.sum("n")).collect()  # at most BUCKETS * (BINS + 1)
        weights.append(learn_weights(sorted((r[0] // (BINS + 1), r[0] % (BINS + 1) - 1, r[1]) for r in rows)))

    def score(block: corpus.Block) -> Iterator[pa.RecordBatch]:
        texts, found, contexts = _counts(block, order, n_slots, 0)
        floor = (found[0] + 0.5) / (n_train + 0.5 * (kinds + 1))
        mixed = _mixed(floor, found, contexts, weights)
        n = len(block.texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.ids, pa.int64()), pa.array([block.kind == SCORED] * n), pa.array(np.bincount(texts, minlength=n)),
             pa.array(np.bincount(texts[found[0] > 0], minlength=n)), pa.array([int(n_train)] * n),
             pa.array(np.bincount(texts, np.log10(floor), n)), pa.array(np.bincount(texts, np.log10(mixed), n))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return corpus.each(corpus.with_answers(packed, *answers), score,
                       "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
