"""Every registered query against its SQL twin at the smallest scale."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(table):
    df = table.select(sorted(table.column_names)).to_pandas()
    for c in df.columns:
        if df[c].dtype.kind not in "fi":
            df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF).toArrow()
    assert got.num_rows > 0
    if name not in contract.oracle_sql():
        return
    want = duck.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    pd.testing.assert_frame_equal(canonical(got), canonical(want), check_exact=True)


def test_entry(spark):
    assert len(contract.entry(spark).collect()) == 6
