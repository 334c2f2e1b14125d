"""Hard negatives by Fagin's threshold algorithm over lists sorted by dimension.

Candidates lie in blocks, each with its rows sorted by every dimension. An anchor reads these lists from the
end that its own sign prefers, scores the rows it meets exactly in integers, and stops once
no row it hasn't met can enter any of its windows of scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.scale import attach, written

# Rows of a block of candidates and of a block of anchors.
BLOCK_ROWS, ANCHOR_ROWS = 4096, 8192
# Entries read of every list at first; each further read is GROWTH times as deep.
FIRST_READ, GROWTH = 16, 3
SCALE = 256
_LONG = (-(1 << 63), (1 << 63) - 1)

_BLOCKS = "dim int, pool string, bucket int, uids binary, ids binary, labels binary, numbers binary, kind string, orders binary"


def usable(vectors: DataFrame) -> DataFrame:
    """``uid, id, label, v, dim``, written: rows with an id, a label and a vector of finite components."""
    v = F.col("embedding").cast("array<double>")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col("label").cast("long")
    return written(vectors.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), v.alias("v"))
                   .where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(whole)
                   .withColumns({"uid": F.monotonically_increasing_id(), "dim": F.size("v"),
                                 "label": F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))}))


def scaled(vectors: list) -> np.ndarray:
    """``floor(256 * x)`` of all components: 64-bit integers, or Python's own where they don't fit."""
    v = np.array([np.asarray(x, np.float64) for x in vectors]).reshape(len(vectors), -1)
    if not v.size or np.abs(v).max() < 2.0 ** 44:
        return np.floor(v * SCALE).astype(np.int64)
    whole = np.empty(v.shape, object)
    whole.flat = [int(np.floor(x * SCALE)) if abs(x) < 2.0 ** 44 else int(x) * SCALE for x in v.flat]
    return whole


def stored(numbers: np.ndarray) -> tuple[bytes, str]:
    if numbers.dtype == object:
        return " ".join(str(x) for x in numbers.flat).encode(), "text"
    most = int(np.abs(numbers).max()) if numbers.size else 0
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return numbers.astype(kind).tobytes(), kind


def restored(data: bytes, kind: str, rows: int) -> np.ndarray:
    if kind == "text":
        out = np.array([int(x) for x in data.decode().split()], object)
    else:
        out = np.frombuffer(data, np.dtype(kind)).astype(np.int64)
    return out.reshape(rows, -1)


def _packed(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values(["id", "uid"])
    numbers = scaled(part["v"].tolist())
    data, kind = stored(numbers)
    order = np.argsort(numbers, axis=0, kind="stable").T.astype("<u4")
    return pd.DataFrame({"dim": [int(part["dim"].iloc[0])], "pool": [part["pool"].iloc[0]], "bucket": [int(part["bucket"].iloc[0])],
                         "uids": [part["uid"].to_numpy("<i8").tobytes()], "ids": [part["id"].to_numpy("<i8").tobytes()],
                         "labels": [part["label"].to_numpy("<i8").tobytes()], "numbers": [data], "kind": [kind], "orders": [order.tobytes()]})


def candidates(rows: DataFrame) -> DataFrame:
    """Blocks of about ``BLOCK_ROWS`` rows with the order of their rows in every dimension, written.

    A frequent label has pools of its own, in as many buckets as it needs; rare ones share pools, so that neither
    a hot label nor very many labels decide the size of a block.
    """
    return written(rows.groupBy("dim", "pool", "bucket").applyInPandas(_packed, _BLOCKS))


def pooled(rows: DataFrame) -> DataFrame:
    """Add ``pool`` and ``bucket``; written."""
    many = rows.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("_n"))
    frequent = F.col("_n") * 2 >= BLOCK_ROWS
    pools = many.groupBy("dim").agg(F.ceil(F.sum(F.when(~frequent, F.col("_n"))) / BLOCK_ROWS).alias("_pools"))
    own, shared = F.concat(F.lit("="), F.col("label")), F.concat(F.lit("#"), F.pmod(F.xxhash64("label"), F.col("_pools")))
    named = many.join(pools, "dim").select("dim", "label", F.when(frequent, own).otherwise(shared).alias("pool"), F.when(
        frequent, F.ceil(F.col("_n") / BLOCK_ROWS)).otherwise(F.lit(1)).alias("_buckets"))
    dealt = attach(rows, written(named), ["dim", "label"])
    return written(dealt.withColumn("bucket", F.pmod(F.xxhash64("uid"), F.col("_buckets")).cast("int")).drop("_buckets"))


class Lists:
    """One block of candidates."""

    def __init__(self, uids: bytes, ids: bytes, labels: bytes, numbers: bytes, kind: str, orders: bytes):
        self.uids, self.ids, self.labels = (np.frombuffer(x, "<i8") for x in (uids, ids, labels))
        self.numbers = restored(numbers, kind, len(self.ids))
        self.orders = np.frombuffer(orders, "<u4").reshape(-1, len(self.ids))
        self.most = int(np.abs(self.numbers).max()) if self.numbers.size else 0
        self._as: dict[object, np.ndarray] = {}

    def kind(self, anchor: np.ndarray) -> type:
        """Doubles hold the products of moderate integers exactly, and multiply faster."""
        bound = self.most * (int(np.abs(anchor).max()) if len(anchor) else 0) * max(1, len(anchor))
        return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object

    def of(self, kind: type) -> np.ndarray:
        if kind not in self._as:
            self._as[kind] = self.numbers.astype(kind)
        return self._as[kind]


Windows = list[tuple[float, float]]


def search(lists: Lists, anchor: np.ndarray, eligible: np.ndarray, windows: Windows, k: int) -> tuple[list[np.ndarray], np.ndarray, int]:
    """The first ``k`` of the ``eligible`` rows of a block in each window of scores (both ends belong to it).

    Returns the places of each window's rows, best first and ties by id, the scores, and how many rows were scored.
    """
    kind, n = lists.kind(anchor), len(lists.ids)
    numbers, a = lists.of(kind), anchor.astype(kind)
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    scores, met, depth, step = np.zeros(n, kind), np.zeros(n, bool), 0, FIRST_READ
    if not len(up) + len(down):     # an anchor of zeros: every score is 0
        met[:], depth = True, n
    while depth < n:
        upto = min(n, depth + step)
        some = np.zeros(n, bool)
        some[lists.orders[up, n - upto:n - depth].ravel()] = True
        some[lists.orders[down, depth:upto].ravel()] = True
        new = np.flatnonzero(some & ~met & eligible)
        met |= some
        scores[new] = numbers[new] @ a
        depth, step = upto, step * GROWTH
        # no row that stands below this depth in every list can score more
        threshold = (numbers[lists.orders[up, n - depth], up] * a[up]).sum() + (numbers[lists.orders[down, depth - 1], down] * a[down]).sum()
        if _settled(scores[met & eligible], windows, k, threshold):
            break
    places = np.flatnonzero(met & eligible)
    out = []
    for low, high in windows:
        inside = places[(scores[places] >= low) & (scores[places] <= high)]
        if len(inside) > k:         # ties with the kth stay in
            inside = inside[scores[inside] >= np.partition(scores[inside], len(inside) - k)[len(inside) - k]]
        out.append(np.array(sorted(inside.tolist(), key=lambda p: (-int(scores[p]), int(lists.ids[p])))[:k], np.int64))
    return out, scores, len(places)


def _settled(scores: np.ndarray, windows: Windows, k: int, threshold: float) -> bool:
    """Whether rows that score ``threshold`` at most can enter no window any more; one that equals a kth score could, by its id."""
    for low, high in windows:
        if threshold < low:
            continue
        inside = scores[(scores >= low) & (scores <= high)]
        if len(inside) < k or threshold >= np.partition(inside, len(inside) - k)[len(inside) - k]:
            return False
    return True


def _packed_anchors(part: pd.DataFrame) -> pd.DataFrame:
    data, kind = stored(scaled(part["v"].tolist()))
    one = part.iloc[0]
    return pd.DataFrame({"dim": [int(one["dim"])], "pool": [one["pool"]], "a_key": [one["a_key"]], "a_uids": [part["uid"].tolist()], "a_labels": [part["label"].tolist()],
                         "a_numbers": [data], "a_kind": [kind], "a_scores": [[list(map(int, x)) for x in part["scores"]]]})


def _anchor_blocks(anchors: DataFrame) -> DataFrame:
    """Anchors ``dim, pool, a_key, uid, label, v, scores`` in one row for each ``a_key`` of a pool, written."""
    return written(anchors.groupBy("dim", "pool", "a_key").applyInPandas(
        _packed_anchors, "dim int, pool string, a_key long, a_uids array<bigint>, a_labels array<bigint>, a_numbers binary, a_kind string, a_scores array<array<bigint>>"))


def _meetings(index: DataFrame, asking: DataFrame, group: list[str]) -> DataFrame:
    """A row for each block of candidates and block of anchors of the same ``group``, dealt so that a block stands under a key of its own."""
    near = written(asking.groupBy(*group).agg(F.collect_list("a_key").alias("_near")))
    many = written(index.groupBy(*group).agg(F.count(F.lit(1)).alias("_many")))
    left = (attach(attach(index, near, group), many, group).withColumn("a_key", F.explode("_near"))
            .withColumn("_deal", F.pmod(F.xxhash64("pool", "bucket"), "_many")).drop("_near", "_many"))
    right = attach(asking, many, group).withColumn("_deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_many") - 1))).drop("_many")
    return left.join(right.drop(*{"pool"} - set(group)).hint("shuffle_merge"), [*group, "a_key", "_deal"])


def _searched(pairs: DataFrame, same_label: bool, windows: Callable[[list[int]], dict[int, tuple[float, float]]], k: int) -> DataFrame:
    """Search of every anchor of a pair's anchor block in the pair's block of candidates: ``anchor_uid, asked, id, score``,
    where ``asked`` is the key of the window, made from the anchor's ``scores``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                lists = Lists(row["uids"], row["ids"], row["labels"], row["numbers"], row["kind"], row["orders"])
                anchors = restored(row["a_numbers"], row["a_kind"], len(row["a_uids"]))
                found: list[tuple[list, list, list, list]] = []
                for uid, label, anchor, given in zip(row["a_uids"], row["a_labels"], anchors, row["a_scores"], strict=True):
                    asked = windows(given)
                    eligible = ((lists.labels == label) & (lists.uids != uid)) if same_label else lists.labels != label
                    if not asked or not eligible.any():
                        continue
                    best, scores, _ = search(lists, anchor, eligible, list(asked.values()), k)
                    for key, places in zip(asked, best, strict=True):
                        kept = [max(_LONG[0], min(_LONG[1], int(scores[p]))) for p in places]
                        found.append(([uid] * len(places), [key] * len(places), lists.ids[places].tolist(), kept))
                yield pa.RecordBatch.from_arrays([pa.array([x for part in column for x in part], pa.int64()) for column in (
                    zip(*found, strict=True) if found else [[]] * 4)], names=["anchor_uid", "asked", "id", "score"])
    out = pairs.mapInArrow(run, "anchor_uid long, asked long, id long, score long")
    best_first = Window.partitionBy("anchor_uid", "asked").orderBy(F.desc("score"), "id")
    return out.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the usable rows whose id is divisible by ``every``. Each has up to ``n_positives`` positives, the best other rows of
    its label, and for each of them up to ``n_negatives`` rows of other labels that score from ``low`` to ``high``
    percent of the positive. Equal scores go to the smaller id. Rows with a NULL id, label or vector or a NULL
    or non-finite component take no part; vectors of different lengths don't meet. Every row that repeats an id is a row,
    also as an anchor. A positive with a negative score has no negatives. A score beyond 64 bits is given as the
    nearest long. An empty table, and one without anchors, has no rows.
    """
    rows = pooled(usable(vectors))
    index = candidates(rows)
    anchors = rows.where(F.col("id") % every == 0).select("dim", "pool", "uid", "id", "label", "v")
    # an anchor finds its positives in the blocks of its label's pool
    parts = written(anchors.groupBy("dim", "pool").agg(F.ceil(F.count(F.lit(1)) / ANCHOR_ROWS).alias("_parts")))
    asking = attach(anchors, parts, ["dim", "pool"]).withColumns({"a_key": F.pmod(F.xxhash64("uid"), "_parts"), "scores": F.array().cast("array<bigint>")})
    met = _meetings(index, _anchor_blocks(asking), ["dim", "pool"])
    positives = written(_searched(met, True, lambda _: {0: (-np.inf, np.inf)}, n_positives)
                        .select("anchor_uid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # and its negatives in all blocks
    scores = positives.groupBy(F.col("anchor_uid").alias("uid")).agg(F.collect_set("positive_score").alias("scores"))
    n_parts = max(1, -(-anchors.count() // ANCHOR_ROWS))
    asking = anchors.join(scores, "uid").withColumns({"pool": F.lit(""), "a_key": F.pmod(F.xxhash64("uid"), F.lit(n_parts))})

    def windows(given: list[int]) -> dict[int, tuple[int, int]]:
        ends = {p: (-(-low * p // 100), high * p // 100) for p in given}
        return {p: (a, b) for p, (a, b) in ends.items() if a <= b}
    met = _meetings(index, _anchor_blocks(asking), ["dim"])
    negatives = _searched(met, False, windows, n_negatives).withColumnRenamed("asked", "positive_score")
    names = anchors.select(F.col("uid").alias("anchor_uid"), F.col("id").alias("anchor_id"))
    return (positives.join(negatives, ["anchor_uid", "positive_score"]).join(names, "anchor_uid")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
