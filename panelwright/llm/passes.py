"""One pass over the rows of a table that adds columns computed from whole texts, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Compute = Callable[[list[bytes]], list]


def add_columns(df: DataFrame, column: str, added: str, make: Callable[[], Compute], drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the columns of the DDL string ``added``; columns of the same names are replaced.

    ``make`` is called once in each task and returns a function from the texts of a batch
    (UTF-8, NULL as empty) to one array or list for each added column. Columns in ``drop`` go.
    """
    new = df.sparkSession.createDataFrame([], added).schema
    df = df.select(*[c for c in df.columns if c not in new.names])
    place = df.columns.index(column)
    stay = [i for i, c in enumerate(df.columns) if c not in drop]
    fields = [df.schema.fields[i] for i in stay]
    names = [*[f.name for f in fields], *new.names]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*fields, *new.fields])
    kinds = [_arrow(f.dataType.simpleString()) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            texts = [t or b"" for t in batch.column(place).cast(pa.binary()).to_pylist()]
            found = compute(texts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in stay], *[pa.array(x, type=k) for x, k in zip(found, kinds, strict=True)]], names=names)
    return df.mapInArrow(run, ddl)


def _arrow(kind: str) -> pa.DataType:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
              "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.list_(_arrow(kind[6:-1])) if kind.startswith("array<") else simple[kind]
