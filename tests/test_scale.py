import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright import PanelSpec, scale
from panelwright.operators import prepare, windows

SPEC = PanelSpec()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, many ties, some missing values."""
    rng = np.random.default_rng(0)
    n = 6000
    keys = np.where(rng.random(n) < 0.34, "hot", rng.integers(0, 40, n).astype(str))
    values = np.where(rng.random(n) < 0.4, 7.0, np.round(rng.lognormal(2, 2, n), 3))
    rows = [(k, None if rng.random() < 0.05 else float(v)) for k, v in zip(keys, values)]
    return spark.createDataFrame(rows, "k string, v double").cache()


def groups(df):
    out = {}
    for k, v in df.collect():
        if v is not None:
            out.setdefault(k, []).append(v)
    return out


@pytest.mark.parametrize("limit", [10, 10_000_000])
def test_positions_are_exact(skewed, limit):
    want = groups(skewed)
    for r in scale.value_positions(skewed, ["k"], "v", limit).collect():
        x = np.array(want[r.k])
        assert (r["_before"], r["_cnt"], r["_total"]) == ((x < r.v).sum(), (x == r.v).sum(), len(x))


@pytest.mark.parametrize("limit", [10, 10_000_000])
def test_group_quantiles_are_exact(skewed, limit):
    want = groups(skewed)
    probs = {"lo": 0.1, "mid": 0.5, "hi": 0.93}
    got = scale.group_quantiles(skewed, ["k"], "v", probs, limit).collect()
    assert len(got) == len(want)
    for r in got:
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(want[r.k], p))


@pytest.mark.parametrize("limit", [1, 20, 1_000_000])
def test_column_medians_are_exact(skewed, limit):
    df = skewed.select("v", (F.col("v") * F.rand(4)).alias("u"), F.lit(None).cast("double").alias("none"),
                       F.when(F.col("k") == "hot", 1).otherwise(2).alias("two")).cache()
    got = scale.column_medians(df, df.columns, limit)
    for c in ("v", "u", "two"):
        assert got[c] == pytest.approx(np.median([r[0] for r in df.select(c).collect() if r[0] is not None]))
    assert got["none"] is None


def test_salted_join_equals_broadcast(skewed):
    stats = skewed.groupBy("k").agg(F.sum("v").alias("s"))
    a = scale.attach(skewed, stats, ["k"], limit=1000)
    b = scale.attach(skewed, stats, ["k"], limit=5)
    assert "_salt" in b._jdf.queryExecution().optimizedPlan().toString()
    assert a.count() == b.count() == skewed.count()
    assert sorted(a.na.fill(-1).collect()) == sorted(b.na.fill(-1).collect())


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_series_windows_share_one_exchange(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        F.col("l_partkey").cast("string").alias("sku"), F.col("l_shipdate").cast("date").alias("date"), F.col("l_quantity").alias("sales"))
    out = windows.change_points(windows.trend(windows.ewm(windows.rolling(windows.lags(base, SPEC), SPEC), SPEC), SPEC), SPEC)
    assert exchanges(out) == 1
    chain = prepare.min_history(prepare.clip_outliers(prepare.impute(base, SPEC), SPEC), SPEC, 3)
    assert exchanges(chain) == 1


def test_unused_features_and_columns_are_pruned(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        F.col("l_partkey").cast("string").alias("sku"), F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").alias("sales"), "l_tax", "l_discount")
    plan = windows.rolling(windows.lags(base, SPEC), SPEC).where("sku = '7'").select("sku", "sales_lag_7")._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and plan.count("Window [") == 1 and "PushedFilters: [IsNotNull(l_partkey)" in plan
