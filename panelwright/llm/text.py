"""Words and their hashes, computed for many texts at once inside a task.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. Its hash is a 64-bit
polynomial over a table of random byte values, taken from one running sum over the
joined texts, so that no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of text that are hashed together; a longer text makes a piece of its own.
PIECE = 1 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_BYTES = np.random.default_rng(20240611).integers(0, 1 << 64, 256, dtype=np.uint64)
_LOWER_BYTES = _BYTES.copy()
_LOWER_BYTES[65:91] = _BYTES[97:123]
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_NEXT = np.uint64(0xD1342543DE82EF95)
_powers: list[np.ndarray] = []


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_array(text: Column) -> Column:
    """The words of a text; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64, for positions up to ``n``."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * PIECE)
        steps = np.full((2, size), 1, dtype=np.uint64)
        steps[0, 1:], steps[1, 1:] = np.uint64(_STEP), np.uint64(_BACK)
        _powers[:] = [np.cumprod(steps[0], dtype=np.uint64), np.cumprod(steps[1], dtype=np.uint64)]
    return _powers[0], _powers[1]


def pieces(texts: Iterable[bytes | None], limit: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """Cut a sequence of texts into runs of about ``limit`` bytes: index of the first, and the texts."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t or b""
        if held and size + len(t) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(t)
        size += len(t)
    if held:
        yield first, held


def words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and for each text where its words begin (one more entry at the end)."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    solid = ~_WHITE[joined]
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    if solid[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    up, down = _tables(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum((_LOWER_BYTES if lower else _BYTES)[joined] * up[:len(joined)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, begins)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, in order."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    last = len(hashes) - n + 1
    out = hashes[:last].copy()
    for j in range(1, n):
        out = out * _NEXT + hashes[j:last + j]
    return mix(out + np.uint64(n))
