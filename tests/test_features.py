import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwright import PanelSpec, scale
from panelwright.functions import calendar as cal
from panelwright.functions.holidays import holiday_days
from panelwright.operators import asof, cleanup, cross, recent, windows
from panelwright.plans.features import build_features, raw_features
from panelwright.spec import FeatureOptions

SPEC = PanelSpec()
N = None


@pytest.fixture(scope="module")
def random_series():
    rng = np.random.default_rng(5)
    out = {}
    for name, n, share in (("full", 120, 0), ("gappy", 150, 0.3), ("sparse", 400, 0.9), ("tiny", 12, 0.2)):
        x = rng.integers(0, 60, n).astype(float)
        x[rng.random(n) < share] = np.nan
        out[name] = [None if np.isnan(v) else v for v in x]
    out["hole"] = [3.0] + [None] * 900 + list(rng.integers(1, 9, 30).astype(float)) + [None] * 40 + [8.0]
    out["steady"] = [4.0] * 60
    out["late"] = [None] * 35 + list(rng.integers(0, 60, 700).astype(float))
    return out


def same(got, want, tol=1e-9):
    want = pd.Series(want, dtype=float)
    got = pd.Series(got, dtype=float)
    np.testing.assert_array_equal(got.isna().values, want.isna().values)
    np.testing.assert_allclose(got.dropna().values, want.dropna().values, rtol=tol, atol=tol)


@pytest.mark.parametrize("span", [7, 14])
def test_ewm_matches_pandas(panel_of, by_series, random_series, span):
    got = by_series(windows.ewm(panel_of(random_series), SPEC), f"sales_ewm_{span}")
    for name, x in random_series.items():
        same(got[name], pd.Series(x, dtype=float).ewm(span=span, adjust=False).mean())


def test_ewm_of_any_span(panel_of, by_series, random_series):
    """Spans of one row up to a thousand, several columns, negative values and long series."""
    series = random_series | {"long": np.random.default_rng(8).normal(0, 50, 1500).tolist()}
    other = {k: [None if v is None else float(-2.0 * v) for v in x[::-1]] for k, x in series.items()}
    opts = FeatureOptions(ewm={"sales": (1, 2, 28, 1000), "price": (3,), "absent": (5,)})
    got = windows.ewm(panel_of(series, price=other), SPEC, opts).cache()
    assert got.columns == ["sku", "date", "sales", "price", "sales_ewm_1", "sales_ewm_2", "sales_ewm_28", "sales_ewm_1000", "price_ewm_3"]
    for column, values, spans in (("sales", series, (1, 2, 28, 1000)), ("price", other, (3,))):
        for span in spans:
            found = by_series(got, f"{column}_ewm_{span}")
            for name, x in values.items():
                same(found[name], pd.Series(x, dtype=float).ewm(span=span, adjust=False).mean())


def test_rolling_and_lags_match_pandas(panel_of, by_series, random_series):
    df = windows.rolling(windows.lags(panel_of(random_series), SPEC), SPEC)
    for name, x in random_series.items():
        s = pd.Series(x, dtype=float)
        same(by_series(df, "sales_lag_7")[name], s.shift(7))
        same(by_series(df, "sales_rolling_mean_14")[name], s.rolling(14, min_periods=1).mean(), 1e-7)
        same(by_series(df, "sales_rolling_std_7")[name], s.rolling(7, min_periods=2).std(), 1e-6)


def test_velocity_matches_numpy(panel_of, by_series, random_series):
    df = windows.trend(panel_of(random_series), SPEC)
    for name, x in random_series.items():
        s = np.array(x, dtype=float)
        for k in (7, 14, 21, 28):
            if len(s) < 28:
                want = acc = np.zeros(len(s))
            else:
                g = np.gradient(s)
                want = np.convolve(np.where(np.isfinite(g), g, 0), np.ones(k) / k, mode="same")
                acc = np.gradient(want)
            same(by_series(df, f"sales_velocity_{k}d")[name], want)
            same(by_series(df, f"sales_acceleration_{k}d")[name], acc)


def test_trend_strength(panel_of, by_series, random_series):
    got = by_series(windows.trend(panel_of(random_series), SPEC), "trend_strength")
    want = np.corrcoef(np.arange(120), np.array(random_series["full"]))[0, 1] ** 2
    assert got["full"][0] == pytest.approx(want)
    assert set(got["steady"]) == {0.0} and set(got["gappy"]) == {0.0} and set(got["tiny"]) == {0.0}


def test_growth_over_zero(panel_of, by_series):
    df = windows.with_growth(panel_of({"a": [0, 0, 5, N, 4]}), "sales", {"g": 1}, windows.in_order(SPEC))
    assert by_series(df, "g")["a"] == [N, N, float("inf"), 0.0, pytest.approx(-0.2)]


def test_recent_state(panel_of, by_series):
    falling = list(range(40, 10, -1))
    cases = {"fall": falling, "flat": [5] * 30, "gap": falling[:-3] + [N] + falling[-2:], "short": [3, 2, 1],
             "up": falling[::-1]}
    df = recent.volatility(recent.decline(panel_of(cases), SPEC), SPEC)
    assert {k: v[0] for k, v in by_series(df, "sales_decline_indicator").items()} == {"fall": 1, "flat": 0, "gap": 0, "short": 0, "up": 0}
    assert {k: v[0] for k, v in by_series(df, "consecutive_decline_days").items()} == {"fall": 13, "flat": 0, "gap": 1, "short": 0, "up": 0}
    assert by_series(df, "decline_magnitude")["fall"][0] == pytest.approx(29 / (40 + 1e-6))
    vol = {k: v[0] for k, v in by_series(df, "volatility_risk_score").items()}
    tail = np.array(falling, float)
    assert vol["fall"] == pytest.approx(np.mean([tail[-k:].std() / (tail[-k:].mean() + 1e-6) for k in (7, 14, 21)]))
    assert vol["gap"] is None and vol["short"] == 0.0


def test_days_since_promo(panel_of, by_series):
    df = panel_of({"a": [1] * 6, "none": [1] * 3}, promo_flag={"a": [0, 1, 0, N, 1, 0], "none": [0, 0, N]})
    got = by_series(windows.days_since_promo(df, SPEC), "days_since_last_promo")
    assert got == {"a": [999, 0, 1, 2, 0, 1], "none": [999] * 3}


def test_price_rank_and_median_with_ties(panel_of, by_series):
    names = [f"s{i}" for i in range(5)]
    prices = dict(zip(names, [3.0, 1.0, 3.0, None, 2.0]))
    df = panel_of({n: [1] for n in names}, category={n: "c" for n in names}, price=prices)
    out = cross.price_position(df, SPEC)
    rank = pd.Series(prices, dtype=float).rank(pct=True)
    same([by_series(out, "price_rank_in_category")[n][0] for n in names], rank[names].values)
    assert [by_series(out, "price_vs_category_median")[n][0] for n in names] == pytest.approx([1.2, 0.4, 1.2, 1.0, 0.8])


def test_brand_popularity_is_zero_without_own_sales(panel_of, by_series):
    df = panel_of({"a": [3], "b": [0], "c": [N]}, brand={"a": "x", "b": "x", "c": "x"})
    got = by_series(cross.brand_popularity(df, SPEC), "brand_popularity_index")
    assert got["a"][0] == pytest.approx(1 / 3) and got["b"] == [0.0] and got["c"] == [0.0]


def test_concentration_without_sales(panel_of):
    df = panel_of({"a": [0, 3], "b": [0, 1]}, category={"a": "c", "b": "c"})
    row = cross.concentration_table(df, SPEC).first()
    assert row.portfolio_concentration_risk == pytest.approx((0.5 + (9 + 1) / 16) / 2)


def test_market_state_defaults(panel_of):
    row = cross.market_state(panel_of({"a": [1, 2]}), SPEC).first()
    assert (row.category_instability_index, row.market_fragmentation_score, row.portfolio_concentration_risk) == (0.5, 0.5, 0.5)


def test_holiday_rules(spark):
    days = {r.day for r in holiday_days(spark, 2021, 2023).collect()}
    y2022 = {d for d in days if d.year == 2022}
    assert y2022 == {dt.date(2022, m, d) for m, d in (
        (1, 1), (1, 17), (2, 21), (5, 30), (6, 19), (6, 20), (7, 4), (9, 5), (10, 10), (11, 11), (11, 24), (12, 25), (12, 26))}
    assert dt.date(2021, 12, 31) in days and dt.date(2023, 11, 10) in days and dt.date(2021, 6, 18) in days


def test_holiday_distance_uses_days_present(panel_of, by_series):
    df = cal.holiday_neighbours(cal.holiday_distance(panel_of({"a": [1] * 16}), SPEC), SPEC)     # Jan 1 and 15, 2024
    assert by_series(df, "days_to_holiday")["a"] == [0, 1, 2, 3, 4, 5, 6, 7, 6, 5, 4, 3, 2, 1, 0, 1]
    assert by_series(df, "is_pre_holiday")["a"][13:] == [1, 0, 1]
    assert by_series(df, "is_post_holiday")["a"][12:] == [1, 0, 1, 0]


@pytest.fixture
def rich(panel_of):
    rng = np.random.default_rng(2)
    names = [f"s{i:02d}" for i in range(12)]
    x = {n: [None if rng.random() < 0.1 else float(rng.integers(0, 30)) for _ in range(70)] for n in names}
    return panel_of(
        x, category={n: "AB"[i % 2] for i, n in enumerate(names)}, subcategory={n: "xyz"[i % 3] for i, n in enumerate(names)},
        brand={n: "pq"[i // 6] for i, n in enumerate(names)}, product_group={n: "g" for n in names},
        promo_flag={n: [int(rng.random() < 0.2) for _ in range(70)] for n in names},
        promo_discount={n: [float(rng.integers(0, 4)) / 10 for _ in range(70)] for n in names},
        price={n: [float(rng.integers(1, 6)) for _ in range(70)] for n in names})


def test_full_build_is_complete_and_bounded(rich):
    out, rules = build_features(rich, SPEC)
    assert out.count() == 840
    left = cleanup.leftovers(out, SPEC).first()
    assert (left.infinite_values, left.missing_values) == (0, 0)
    missing = set(SPEC.known) - set(out.columns) - {"special_event"}
    assert not missing
    top = out.agg(F.max("brand_market_share"), F.max("price_rank_in_category")).first()
    assert max(top) <= 1.0


def test_features_do_not_depend_on_the_size_limits(rich, monkeypatch):
    columns = sorted(raw_features(rich, SPEC).columns)
    rounded = [F.round(c, 7).alias(c) if t == "double" else F.col(c) for c, t in rich.select("*").dtypes]
    assert rounded
    usual = raw_features(rich, SPEC).select(*columns).toPandas().sort_values(["sku", "date"]).reset_index(drop=True)
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(scale, "GROUP_ROWS", 2)
    monkeypatch.setattr(scale, "EXACT_VALUES", 3)
    split = raw_features(rich, SPEC).select(*columns).toPandas().sort_values(["sku", "date"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(usual, split, rtol=1e-9)


def test_cleanup_kinds(spark):
    rows = [("a", 1.0, 1, 3.0, 50.0, 2e6), ("a", None, None, None, None, float("inf")), ("a", 3.0, 0, -1.0, -50.0, 5.0)]
    df = spark.createDataFrame(rows, "sku string, sales double, promo_flag int, price_rank double, x_growth double, big double")
    rules = cleanup.fit(df, SPEC)
    out = cleanup.apply(df, SPEC, rules).orderBy("sales").collect()
    assert [r.sales for r in out] == [1.0, 2.0, 3.0]
    assert sorted(r.promo_flag for r in out) == [0, 0, 1]
    assert sorted(r.price_rank for r in out) == [0.0, 0.0, 1.0]
    assert sorted(r.x_growth for r in out) == [-10.0, 0.0, 10.0]
    assert sorted(r.big for r in out) == [5.0, 1e6, 1e6]


def test_cleanup_bounds_need_gaps(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 7.0)], "sku string, price_rank double")
    out = cleanup.apply(df, PanelSpec(target="none"), cleanup.fit(df, SPEC)).collect()
    assert [r.price_rank for r in out] == [5.0, 7.0]


def test_asof_features_do_not_know_the_future(panel_of):
    rng = np.random.default_rng(4)
    values = {f"s{i}": rng.integers(1, 40, 70).astype(float).tolist() for i in range(3)}
    extra = {"promo_flag": {k: [int(i % 5 == 0) for i in range(70)] for k in values}, "promo_discount": 0.1, "price": 2.0,
             "category": {k: "c" for k in values}, "subcategory": {k: "d" for k in values}, "brand": {k: "b" for k in values}}
    extra = {c: (v if isinstance(v, dict) else {k: v for k in values}) for c, v in extra.items()}
    cut = dt.date(2024, 1, 1) + dt.timedelta(days=49)

    names = [*asof.SERIES, *asof.SEASONS, "category_instability_index", "market_fragmentation_score", "portfolio_concentration_risk"]
    later = {k: v[:50] + [500.0] * 20 for k, v in values.items()}
    got = [raw_features(panel_of(v, **extra), SPEC, asof=cut).select("sku", "date", *names).orderBy("sku", "date").collect() for v in (values, later)]
    assert len(got[0]) == 210 and got[0] == got[1]
    whole = raw_features(panel_of(later, **extra), SPEC).select("sku", "date", *names).orderBy("sku", "date").collect()
    assert whole != got[0]
