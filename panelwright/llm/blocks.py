"""Questions that blocks of documents put to the corpus about hashes, such as how often an n-gram occurs.

Documents are packed into compressed blocks of bounded size, written once. Each block asks about
its distinct hashes, dealt over slots by their value; a slot sees what all blocks have of its hashes
and answers each block in the order asked. So a shuffle moves eight bytes for each distinct hash of a block, not a
row for each word, and a hash that every document has reaches its slot once from each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.scale import written

# Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
# Bytes of text of the corpus for each slot: about two million words.
SLOT_BYTES = 12 << 20

_BLOCKS = "block long, kind int, ids array<bigint>, sizes array<bigint>, body binary"


def pack(docs: DataFrame, kind: Column) -> DataFrame:
    """Blocks of documents of one ``kind`` (an integer) each, written: ids, sizes of the texts and the compressed texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size: dict[int, int] = {}
        number = TaskContext.get().partitionId() << 32

        def flush(k: int) -> pa.RecordBatch:
            nonlocal number
            rows = held.pop(k)
            size.pop(k)
            number += 1
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(t for _, t in rows))
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([k], pa.int32()), pa.array([[i for i, _ in rows]], pa.list_(pa.int64())),
                 pa.array([[len(t) for _, t in rows]], pa.list_(pa.int64())), pa.array([body])],
                names=["block", "kind", "ids", "sizes", "body"])
        for batch in batches:
            for i, k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                t = t or b""
                if k in held and size[k] + len(t) > BLOCK_BYTES:
                    yield flush(k)
                held.setdefault(k, []).append((i, t))
                size[k] = size.get(k, 0) + len(t)
        for k in sorted(held):
            yield flush(k)
    slim = docs.select(F.col("doc_id").cast("long"), kind.cast("int"), F.col("text").cast("binary"))
    return written(slim.mapInArrow(run, _BLOCKS))


def slots(blocks: DataFrame) -> int:
    """Number of slots for what is in ``blocks``."""
    size = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0]
    return max(1, -(-(size or 0) // SLOT_BYTES))


class Block:
    def __init__(self, row: dict):
        self.number, self.kind, self.ids = row["block"], row["kind"], row["ids"]
        body = zstandard.ZstdDecompressor().decompress(row["body"], max_output_size=max(1, sum(row["sizes"])))
        ends = np.cumsum([0, *row["sizes"]])
        self.texts = [body[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)]
        #: answers by the name of the question, each in the order asked
        self.answers: dict[str, np.ndarray] = {}
        for part in sorted(row.get("answers") or [], key=lambda x: (x["question"], x["slot"])):
            found = np.frombuffer(zstandard.ZstdDecompressor().decompress(part["answer"]), np.dtype(part["kind"]))
            self.answers.setdefault(part["question"], []).append(found.reshape(-1, part["columns"]) if part["columns"] > 1 else found)
        self.answers = {k: np.concatenate(v) for k, v in self.answers.items()}


def asked_order(hashes: np.ndarray, n_slots: int) -> np.ndarray:
    """Order in which a block asks about its distinct hashes: by slot, then by value."""
    return np.lexsort((hashes, hashes % np.uint64(n_slots)))


def each(blocks: DataFrame, fn: Callable[[Block], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from fn(Block(batch.slice(k, 1).to_pylist()[0]))
    return blocks.mapInArrow(run, schema)


def ask(blocks: DataFrame, name: str, n_slots: int, question: Callable[[Block], tuple[np.ndarray, np.ndarray]],
        answer: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, list[float]]], width: int = 8) -> DataFrame:
    """Answers for ``with_answers``, written: ``block, part (the block's kind), question, slot, kind, columns, answer, tally``.

    ``question`` gives the distinct hashes of a block in ``asked_order``, and a number for each. ``answer`` gets the hashes
    of a slot from all blocks, one block after the other, with their numbers, and gives an array in this order, of
    one or more columns, and a tally that is kept once for each slot. ``width`` bytes of each hash travel.
    """
    def put(block: Block) -> Iterator[pa.RecordBatch]:
        hashes, numbers = question(block)
        if not len(hashes):
            return
        slot = (hashes % np.uint64(n_slots)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        ends = [*cuts[1:].tolist(), len(slot)]
        kept = (hashes // np.uint64(n_slots)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        packer = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot[cuts]), pa.array([block.number] * len(cuts)),
             # byte by byte: the upper bytes of ordered hashes hardly change
             pa.array([packer.compress(kept[s:e].T.tobytes()) for s, e in zip(cuts, ends, strict=True)]),
             pa.array([packer.compress(numbers[s:e].tobytes()) for s, e in zip(cuts, ends, strict=True)]),
             pa.array([str(numbers.dtype)] * len(cuts)), pa.array([block.kind] * len(cuts), pa.int32())],
            names=["slot", "block", "hashes", "numbers", "kind", "part"])

    def settle(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("block")
        raw = [np.frombuffer(zstandard.ZstdDecompressor().decompress(h), np.uint8).reshape(width, -1).T for h in part["hashes"]]
        many = [len(r) for r in raw]
        wide = np.zeros((sum(many), 8), np.uint8)
        wide[:, :width] = np.concatenate(raw)
        numbers = np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(n), np.dtype(part["kind"].iloc[0])) for n in part["numbers"]])
        found, tally = answer(wide.view("<u8").ravel(), numbers)
        packer = zstandard.ZstdCompressor(level=1)
        out = [packer.compress(x.tobytes()) for x in np.split(found, np.cumsum(many)[:-1])]
        return pd.DataFrame({"block": part["block"].to_numpy(), "part": part["part"].to_numpy(), "question": name, "slot": part["slot"].to_numpy(),
                             "kind": str(found.dtype), "columns": 1 if found.ndim == 1 else found.shape[1], "answer": out,
                             "tally": [tally] + [None] * (len(out) - 1)})
    asked = each(blocks, put, "slot long, block long, hashes binary, numbers binary, kind string, part int")
    return written(asked.groupBy("slot").applyInPandas(
        settle, "block long, part int, question string, slot long, kind string, columns long, answer binary, tally array<double>"))


def tallies(answers: DataFrame, n: int) -> list[float]:
    """Sums of the ``n`` numbers that the slots have kept."""
    kept = answers.where(F.col("tally").isNotNull())
    return [x or 0.0 for x in kept.agg(*[F.sum(F.get("tally", F.lit(i))) for i in range(n)]).first()]


def with_answers(blocks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Blocks beside all answers they have got."""
    every = answers[0]
    for more in answers[1:]:
        every = every.unionByName(more)
    by_block = every.groupBy("block").agg(F.collect_list(F.struct("question", "slot", "kind", "columns", "answer")).alias("answers"))
    return blocks.join(by_block, "block", "left")


def first_of_runs(ordered: np.ndarray) -> np.ndarray:
    """Places at which a new value begins in an ordered array."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)
