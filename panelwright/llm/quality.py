"""Quality score from two zstandard dictionaries, one built from good and one from bad labelled text.

Each text is compressed in blocks with either dictionary. The normalised difference of the
sizes, beside the plain compression ratio, is calibrated to a probability by logistic
regression on labelled rows that neither dictionary has seen.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.passes import add_columns
from panelwright.scale import written

# Bound of the labelled sample: rows of each class, half of them for its dictionary and half for calibration.
SAMPLE_ROWS = 6000
# Characters that a sampled row lends to its dictionary, and bytes of the dictionary.
LENT, DICT_BYTES = 2000, 1 << 17
# A text is compressed in independent blocks of so many bytes, so that long texts score like short ones.
BLOCK = 2000
THRESHOLD = 0.3
KNOTS = (0.05, 0.2, 0.5, 0.8, 0.95)


def fold(doc_id: Column) -> Column:
    """Remainder by which rows are held out; a NULL id falls to the held-out rows."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)), F.lit(0))


def _sample(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids of each class in the order of a hash: ``doc_id, quality, lends``."""
    one = (labels.where(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 0))
           .groupBy("doc_id").agg(F.min("quality").alias("quality")).withColumn("_h", F.xxhash64("doc_id")))
    parts = [one.where(F.col("quality") == c).orderBy("_h").limit(rows) for c in (0, 1)]
    return reduce(DataFrame.unionAll, parts).select("doc_id", "quality", (F.pmod("_h", F.lit(2)) == 0).alias("lends"))


def build_dictionary(texts: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; of too little text, the text itself."""
    try:
        return zstandard.train_dictionary(size, texts, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b" ".join(texts)[:size]


def _sizes(dictionaries: tuple[bytes, bytes]):
    kept = [zstandard.ZstdCompressionDict(d) for d in dictionaries]
    plain = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    engines = [zstandard.ZstdCompressor(dict_data=d, **plain) for d in kept] + [zstandard.ZstdCompressor(**plain)]

    def sizes(text: bytes) -> tuple[int, int, int]:
        blocks = [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)]
        return tuple(sum(len(e.compress(b)) for b in blocks) for e in engines)
    return sizes


def measure(docs: DataFrame, good: bytes, bad: bytes, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``_diff, _ratio`` of its texts: normalised size difference, and size without a dictionary per byte."""
    def make():
        sizes = _sizes((good, bad))

        def compute(texts: list[bytes]) -> list[np.ndarray]:
            sized = np.array([sizes(t) for t in texts], dtype=np.float64).reshape(-1, 3)
            n = np.array([len(t) for t in texts], dtype=np.float64)
            return [(sized[:, 1] - sized[:, 0]) / np.maximum(1, sized[:, 0] + sized[:, 1]),
                    np.where(n > 0, sized[:, 2] / np.maximum(1, n), 1.0)]
        return compute
    return add_columns(docs, "text", "_diff double, _ratio double", make, drop)


def _bases(diff, ratio, knots, top, ones):
    """Piecewise linear terms of both measures; works on arrays and on columns."""
    terms = [ones, diff, ratio]
    for x, at in ((diff, knots[0]), (ratio, knots[1])):
        terms += [top(x - k) for k in at]
    return terms


def calibrate(diff: np.ndarray, ratio: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[list, list]:
    """Knots and coefficients of a ridge logistic regression, by Newton steps."""
    knots = [sorted({float(v) for v in np.quantile(x, KNOTS)}) for x in (diff, ratio)]
    x = np.stack(_bases(diff, ratio, knots, lambda v: np.maximum(v, 0.0), np.ones_like(diff)), axis=1)
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1.0
    x, beta = x / scale, np.zeros(x.shape[1])
    weight = weight / weight.mean()
    ridge = np.full(len(beta), 0.3)
    ridge[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        beta = beta + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return knots, (beta / scale).tolist()


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """The dictionaries, and the calibration or a constant score.

    Learns from at most ``sample_rows`` labelled rows of each class outside the held-out fold, taken by
    hash; of labels that disagree on a document the lower counts. Without labels of both classes
    the score is the share of good ones, one half without any.
    """
    sample = written(_sample(labels, sample_rows))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])  # 2 * sample_rows ids at most
    lent = rows.where(F.col("lends") & (F.length("text") > 0)).select(
        "quality", F.col("text").substr(F.lit(1) + F.pmod(F.xxhash64("doc_id"), F.greatest(
            F.lit(1), F.length("text") - LENT)).cast("int"), F.lit(LENT)).cast("binary").alias("text"))
    lent = [(r[0], bytes(r[1])) for r in lent.collect()]
    good, bad = (build_dictionary(sorted(t for q, t in lent if q == c)) for c in (1, 0))
    seen = measure(rows.where(~F.col("lends")).select("doc_id", "text", "quality"), good, bad, drop=("text",))
    seen = np.array([tuple(r) for r in seen.select("_diff", "_ratio", "quality").collect()], dtype=np.float64).reshape(-1, 3)
    totals = {r[0]: r[1] for r in labels.where(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 0))
              .groupBy("quality").agg(F.count(F.lit(1))).collect()}
    y = seen[:, 2]
    if len(np.unique(y)) < 2:
        return {"good": good, "bad": bad, "score": totals.get(1, 0) / sum(totals.values()) if totals else 0.5}
    seen = seen[np.lexsort(seen.T)]
    y = seen[:, 2]
    weight = np.where(y == 1, totals[1] / (y == 1).sum(), totals[0] / (y == 0).sum())
    knots, beta = calibrate(seen[:, 0], seen[:, 1], y, weight)
    return {"good": good, "bad": bad, "knots": knots, "beta": beta}


def _score(model: dict) -> Column:
    if "score" in model:
        return F.lit(float(model["score"]))
    terms = _bases(F.col("_diff"), F.col("_ratio"), model["knots"], lambda v: F.greatest(v, F.lit(0.0)), F.lit(1.0))
    logit = reduce(lambda a, b: a + b, [t * F.lit(float(b)) for t, b in zip(terms, model["beta"], strict=True)])
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit))))


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, diff, ratio``.

    Only the text makes the score; see ``fit`` for what is learnt. NULL and empty texts score like a text
    with no difference; repeated rows score alike; further columns don't matter; an empty table has no rows.
    """
    model = fit(docs, labels, sample_rows)
    return (measure(docs.select("doc_id", "text"), model["good"], model["bad"], drop=("text",)).withColumn("score", _score(model))
            .select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                    F.col("_diff").alias("diff"), F.col("_ratio").alias("ratio")))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without those that score below the threshold; one pass over the texts, no join."""
    model = fit(docs, labels, sample_rows)
    return measure(docs, model["good"], model["bad"]).where(_score(model) >= THRESHOLD).select(*docs.columns)
