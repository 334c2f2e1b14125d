"""Nearest neighbours by largest inner product over randomly rotated one-bit codes.

A vector is centred, rotated and kept as its signs with two scalars. The signs, read byte by byte from a
query's tables of partial sums, give an estimate of every inner product and a bound of its error; only vectors whose
upper bound reaches the best exact products are compared in full. Blocks of queries meet blocks of the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.scale import written

INDEX_BLOCK, QUERY_BLOCK = 8192, 1024
# Rows in hash order that place the centre; the centre only affects how tight the bounds are.
CENTRE_ROWS = 4096
# Width of the error bound in its standard deviations.
SPREAD = 2.5
# Best estimates of a block that are compared in full first, as a multiple of the neighbours wanted; they set the level for the others.
FIRST = 2

_PACKED = "dim int, block int, uids binary, ids binary, signs binary, factors binary, vectors binary, kind string"
_BITS = (np.arange(256)[:, None] >> np.arange(7, -1, -1) & 1) * 2 - 1


def rotation(dim: int) -> np.ndarray:
    """The same random orthogonal matrix in every task."""
    q, r = np.linalg.qr(np.random.default_rng(dim + 91).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame) -> DataFrame:
    """``uid, vec_id, v, dim``, written, a row for each row given. NULL ids, NULL or zero vectors and vectors with a NULL or
    non-finite component are left out."""
    v = F.col("embedding").cast("array<double>")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return written(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
                   .where(whole & F.exists("v", lambda x: x != 0)).withColumns({"dim": F.size("v"), "uid": F.monotonically_increasing_id()}))


def build_index(rows: DataFrame, n_blocks: int, centres: dict[int, list[float]]) -> DataFrame:
    """Packed blocks of about ``INDEX_BLOCK`` vectors: ids, sign bits, factors (norm, alignment, product with the centre), vectors."""
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["vec_id", "uid"])
        v = np.stack(part["v"].to_numpy()).astype(np.float64)
        dim = v.shape[1]
        centre = np.array(centres.get(dim, np.zeros(dim)))
        off = v - centre
        norm = np.sqrt((off * off).sum(axis=1))
        turned = (off / np.maximum(norm, 1e-300)[:, None]) @ rotation(dim).T
        aligned = np.where(norm > 0, np.abs(turned).sum(axis=1) / np.sqrt(dim), 1.0)
        factors = np.stack([norm, aligned, v @ centre], axis=1)
        kind = "<f4" if (v.astype("<f4") == v).all() else "<f8"
        return pd.DataFrame({"dim": [dim], "block": [int(part["block"].iloc[0])], "uids": [part["uid"].to_numpy("<i8").tobytes()],
                             "ids": [part["vec_id"].to_numpy("<i8").tobytes()], "signs": [np.packbits(turned >= 0, axis=1).tobytes()],
                             "factors": [factors.tobytes()], "vectors": [v.astype(kind).tobytes()], "kind": [kind]})
    keyed = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).cast("int"))
    return keyed.groupBy("dim", "block").applyInPandas(pack, _PACKED)


class _Block:
    def __init__(self, dim: int, uids: bytes, ids: bytes, signs: bytes, factors: bytes, vectors: bytes, kind: str):
        self.uids, self.ids = np.frombuffer(uids, "<i8"), np.frombuffer(ids, "<i8")
        self.signs = np.ascontiguousarray(np.frombuffer(signs, np.uint8).reshape(len(self.ids), -1).T)
        self.norm, self.aligned, self.with_centre = np.frombuffer(factors, np.float64).reshape(-1, 3).T
        self.vectors = np.frombuffer(vectors, np.dtype(kind)).reshape(len(self.ids), dim)


class _Search:
    """The nearest so far of one block of queries."""

    def __init__(self, dim: int, uids: bytes, ids: bytes, vectors: bytes, kind: str, k: int, centre: np.ndarray):
        self.uids, self.ids, self.k, self.centre, self.dim = np.frombuffer(uids, "<i8"), np.frombuffer(ids, "<i8"), k, centre, dim
        self.vectors = np.frombuffer(vectors, np.dtype(kind)).reshape(len(self.ids), dim).astype(np.float64)
        off = self.vectors - centre
        self.turned = (off @ rotation(dim).T / np.sqrt(dim)).astype(np.float32)
        self.norm = np.sqrt((off * off).sum(axis=1))
        self.shift = self.vectors @ centre - centre @ centre
        self.best = [(np.empty(0), np.empty(0, np.int64)) for _ in self.ids]
        self.compared = 0

    def tables(self, i: int) -> np.ndarray:
        """For each byte of a code, the query's sum over its bits' signs, by the byte's value."""
        turned = np.zeros(-(-self.dim // 8) * 8, np.float32)
        turned[:self.dim] = self.turned[i]
        return turned.reshape(-1, 8) @ _BITS.T.astype(np.float32)

    def add(self, block: _Block) -> None:
        per_row = block.norm / block.aligned
        slack = SPREAD * block.norm * np.sqrt(np.maximum(0.0, 1 / block.aligned ** 2 - 1)) / np.sqrt(max(1, self.dim - 1))
        for i, query in enumerate(self.uids):
            guess = np.zeros(len(block.ids), np.float32)
            for table, code in zip(self.tables(i), block.signs, strict=True):
                guess += table[code]
            guess = guess * per_row + block.with_centre + self.shift[i]
            upper = guess + slack * self.norm[i] + 1e-5 * (np.abs(guess) + 1)  # and the rounding of the estimate
            own = block.uids == query
            upper[own] = guess[own] = -np.inf
            first = np.argpartition(guess, -FIRST * self.k)[-FIRST * self.k:] if len(guess) > FIRST * self.k else np.arange(len(guess))
            self._compare(i, block, first[~own[first] & (upper[first] >= self._kth(i))])
            upper[first] = -np.inf
            level = self._kth(i)
            self._compare(i, block, np.flatnonzero((upper >= level) & np.isfinite(upper)))

    def _kth(self, i: int) -> float:
        scores = self.best[i][0]
        return scores[-1] if len(scores) == self.k else -np.inf

    def _compare(self, i: int, block: _Block, some: np.ndarray) -> None:
        self.compared += len(some)
        exact = (block.vectors[some].astype(np.float64) * self.vectors[i]).sum(axis=1)
        scores, ids = np.concatenate([self.best[i][0], exact]), np.concatenate([self.best[i][1], block.ids[some]])
        if len(scores) > 4 * self.k:    # what ties with the kth stays for the sort
            near = scores >= np.partition(scores, -self.k)[-self.k]
            scores, ids = scores[near], ids[near]
        order = np.lexsort((ids, -scores))[:self.k]
        self.best[i] = scores[order], ids[order]


def nearest(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The ``k`` nearest of each query: ``query_id, rank, vec_id, score``.

    Queries are the usable rows whose id is divisible by ``every``, candidates all usable rows of the same length but the
    query's own; see ``usable`` for what takes no part. Rows that repeat an id are rows of their own, as queries and as
    candidates. Scores are inner products in double precision of the given vectors; equal scores go to the smaller id. A query without candidates, and an empty table, have no rows.
    """
    rows = usable(vectors)
    n = rows.count()
    n_blocks = max(1, -(-n // INDEX_BLOCK))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(CENTRE_ROWS).select("dim", "v").collect()
    by_dim: dict[int, list] = {}
    for dim, v in sample:
        by_dim.setdefault(dim, []).append(v)
    centres = {dim: np.mean(np.array(vs), axis=0).tolist() for dim, vs in by_dim.items()}
    index = written(build_index(rows, n_blocks, centres))
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    n_asked = max(1, -(-asked.count() // QUERY_BLOCK))
    queries = written(build_index(asked, n_asked, centres).select("dim", *[F.col(c).alias(f"q_{c}") for c in ("block", "uids", "ids", "vectors", "kind")]))
    # every block of queries is sent to every block of the index, under a key of their own
    left = index.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))))
    right = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    pairs = left.join(right.hint("shuffle_merge"), ["dim", "block", "q_block"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple[int, int], _Search] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                dim, key = row["dim"], (row["dim"], row["q_block"])
                if key not in states:
                    states[key] = _Search(dim, row["q_uids"], row["q_ids"], row["q_vectors"], row["q_kind"], k, np.array(centres.get(dim, np.zeros(dim))))
                states[key].add(_Block(dim, row["uids"], row["ids"], row["signs"], row["factors"], row["vectors"], row["kind"]))
        for state in states.values():
            many = [len(s) for s, _ in state.best]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(state.uids, many)), pa.array(np.repeat(state.ids, many)), pa.array(np.concatenate([b[1] for b in state.best])),
                 pa.array(np.concatenate([b[0] for b in state.best]))], names=["query_uid", "query_id", "vec_id", "score"])
    found = pairs.mapInArrow(search, "query_uid long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
