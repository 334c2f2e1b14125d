"""Ridge regressions from mergeable sums: one pass over the rows serves any number of fits.

The sums of products of all columns add up over any split of the rows, so rows are cut into
segments once and every fit adds the segments it may see. The driver gets one small matrix for each
segment and solves a system as wide as the number of inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Partial sums of a segment that reach the driver, whatever the number of tasks.
PARTIALS = 32


def cross_sums(df: DataFrame, left: list[str], right: list[str], segment: str) -> dict[int, np.ndarray]:
    """For each value of the integer column ``segment``, of which there must be few, the sums of ``left[i] * right[j]``.
    NULL counts as 0."""
    columns = list(dict.fromkeys([*left, *right]))
    at_left, at_right = [columns.index(c) for c in left], [columns.index(c) for c in right]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column(0).to_numpy(zero_copy_only=False)
            values = np.stack([np.nan_to_num(c.to_numpy(zero_copy_only=False).astype(np.float64)) for c in batch.columns[1:]], axis=1)
            for k in np.unique(of).tolist():
                part = values[of == k]
                sums[k] = sums.get(k, 0.0) + part[:, at_left].T @ part[:, at_right]
        part = TaskContext.get().partitionId() % PARTIALS
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([part] * len(sums), pa.int32()),
                                          pa.array([m.tobytes() for m in sums.values()], pa.binary())], names=["segment", "part", "sums"])

    def add(some: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in some["sums"])
        return pd.DataFrame({"segment": [some["segment"].iloc[0]], "part": [some["part"].iloc[0]], "sums": [total.tobytes()]})
    schema = "segment int, part int, sums binary"
    slim = df.select(F.col(segment).cast("int"), *[F.col(c).cast("double") for c in columns])
    out: dict[int, np.ndarray] = {}
    for row in slim.mapInArrow(run, schema).groupBy("segment", "part").applyInPandas(add, schema).orderBy("segment", "part").collect():
        out[row["segment"]] = out.get(row["segment"], 0.0) + np.frombuffer(row["sums"]).reshape(len(left), len(right))
    return out


def ridge(moments: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Intercept and coefficients from the sums of products of ``1, inputs..., target``.

    The squared error's mean plus ``penalty`` times the squared coefficients, each scaled by its input's variance,
    is least; so the scale of an input doesn't matter. An input without variance gets 0.
    """
    n = moments[0, 0]
    if n == 0:
        return 0.0, np.zeros(len(moments) - 2)
    means = moments[0] / n
    spread = moments / n - np.outer(means, means)
    squares = np.diag(moments) / n
    varies = np.flatnonzero(np.diag(spread)[:-1] > 1e-9 * np.maximum(squares[:-1], 1e-300))
    coefficients = np.zeros(len(moments) - 2)
    if len(varies):
        scale = np.sqrt(np.diag(spread)[varies])
        inner = spread[np.ix_(varies, varies)] / np.outer(scale, scale)
        coefficients[varies - 1] = np.linalg.solve(inner + penalty * np.eye(len(varies)), spread[varies, -1] / scale) / scale
    return float(means[-1] - means[1:-1] @ coefficients), coefficients
