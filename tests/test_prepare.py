import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwright import PanelSpec, PrepOptions
from panelwright.operators import prepare as prep
from panelwright.plans.prepare import prepare_panel
from panelwright.sources import tables

SPEC = PanelSpec()
N = None


def close(got, want):
    for g, w in zip(got, want, strict=True):
        assert (g is None and (w is None or np.isnan(w))) or g == pytest.approx(w, abs=1e-9), (got, want)


def interpolated_by_hand(values, limit=7):
    """Plain-loop statement of the imputation rules, for one series starting on a Monday."""
    s = [np.nan if v is None else float(v) for v in values]
    n, miss = len(s), [v is None for v in values]
    run = [0] * n
    for i in range(n):
        if miss[i]:
            a = i
            while a > 0 and miss[a - 1]:
                a -= 1
            b = i
            while b < n - 1 and miss[b + 1]:
                b += 1
            run[i] = b - a + 1
    small = [m and r <= limit for m, r in zip(miss, run)]
    large = [m and r > limit for m, r in zip(miss, run)]
    line = pd.Series(s).interpolate(limit=limit).tolist()
    out = list(s)
    if any(small):
        if n > 14:
            mean = pd.Series(s).groupby([i % 7 for i in range(n)]).transform("mean")
            out = [0.7 * line[i] + 0.3 * mean[i] if small[i] else s[i] for i in range(n)]
        else:
            out = line
    if any(large):
        carried = pd.Series(out).ffill().tolist()
        last = -1
        for i in range(n):
            if not miss[i]:
                last = i
            elif large[i] and last >= 0:
                out[i] = carried[i] * 0.95 ** (i - last)
            elif large[i]:
                out[i] = np.nan
        out = [v if not np.isnan(v) else b for v, b in zip(out, pd.Series(out).bfill())]
    return out


CASES = {
    "inner1": [5, N, 7] + list(range(15)),
    "lead1": [N] + list(range(3, 20)),
    "lead7": [N] * 7 + list(range(1, 12)),
    "lead8": [N] * 8 + list(range(1, 12)),
    "inner7": [4, 9] + [N] * 7 + list(range(10)),
    "inner8": [4, 9] + [N] * 8 + list(range(10)),
    "tail7": list(range(10)) + [N] * 7,
    "tail8": list(range(10)) + [N] * 8,
    "len14": [2, N, 4, 8] + [N] * 8 + [3, 1],
    "len15": [2, N, 4, 8] + [N] * 8 + [3, 1, 6],
    "short_lead": [N] * 8 + [3, N, 6],
    "short_large": [6] + [N] * 9,
    "unseen_weekday": [N, 3, 4] + [N] * 4 + [N] * 8 + [2, 5, N, 1],
    "nothing": [N] * 9,
    "single": [4],
}


@pytest.fixture
def gaps(panel_of):
    return panel_of(CASES)


def test_interpolation_matches_loops(gaps, by_series):
    got = by_series(prep.impute_interpolate(gaps, SPEC, 7), "sales")
    for name, values in CASES.items():
        close(got[name], interpolated_by_hand(values))


def test_gap_runs(gaps, by_series):
    got = by_series(prep.gap_runs(gaps, SPEC), "gap_run")
    assert got["inner8"][:11] == [0, 0] + [8] * 8 + [0]
    assert got["nothing"] == [9] * 9 and got["lead1"][0] == 1 and got["tail8"][-1] == 8


@pytest.mark.parametrize("limit", [None, 2])
def test_forward_fill(gaps, by_series, limit):
    got = by_series(prep.impute_ffill(gaps, SPEC, limit), "sales")
    for name, values in CASES.items():
        close(got[name], pd.Series(values, dtype=float).ffill(limit=limit).bfill())


def test_imputation_keeps_observed_and_leaves_no_gap(gaps, by_series):
    got = by_series(prep.impute(gaps, SPEC), "sales")
    for name, values in CASES.items():
        assert None not in got[name]
        assert all(g == v for g, v in zip(got[name], values) if v is not None)
    assert got["nothing"] == [0.0] * 9


def test_order_and_partitioning_do_not_matter(gaps, by_series):
    mixed = gaps.repartition(5).orderBy(F.rand(3))
    assert by_series(prep.impute(mixed, SPEC), "sales") == by_series(prep.impute(gaps, SPEC), "sales")


def clip_by_hand(x, promo):
    x, promo = np.array(x, float), np.array(promo)
    q1, q3 = np.quantile(x, 0.25), np.quantile(x, 0.75)
    cv = x.std(ddof=1) / (x.mean() + 1e-6) if len(x) > 1 else np.nan
    k = 2.5 if cv > 1.5 else 2.0 if cv > 0.8 else 1.5
    lo, hi = max(0, q1 - k * (q3 - q1)), q3 + k * (q3 - q1)
    top = np.full(len(x), hi)
    if (promo == 1).sum() > 5:
        p1, p3 = np.quantile(x[promo == 1], [0.25, 0.75])
        top[promo == 1] = p3 + 1.5 * (p3 - p1)
    return np.minimum(np.maximum(x, lo), top)


def test_clip_outliers_by_promotion_count(panel_of, by_series):
    rng = np.random.default_rng(1)
    x = {n: list(np.r_[rng.integers(5, 15, 30), 400, 90]) for n in ("five", "six", "spiky")} | {"one": [7]}
    x["spiky"] = [0] * 25 + [100, 200, 900, 1, 2, 3, 4]
    promo = {"five": [1] * 5 + [0] * 27, "six": [1] * 5 + [0] * 26 + [1], "spiky": [0] * 32, "one": [0]}
    df = panel_of(x, promo_flag=promo)
    got = by_series(prep.clip_outliers(df, SPEC), "sales")
    for name in x:
        close(got[name], clip_by_hand(x[name], promo[name]))
    no_promo = by_series(prep.clip_outliers(df.drop("promo_flag"), SPEC), "sales")
    close(no_promo["six"], clip_by_hand(x["six"], [0] * 32))


def test_remove_outliers(panel_of, by_series):
    x = list(range(100))
    got = by_series(prep.remove_outliers(panel_of({"a": x}), SPEC, 0.05, 0.9), "sales")["a"]
    assert got == [float(v) for v in x if np.quantile(x, 0.05) <= v <= np.quantile(x, 0.9)]


def test_history_and_zero_filters(panel_of):
    df = panel_of({"n59": [1] * 59, "n60": [1] * 60, "zero": [0] * 60})
    assert {r.sku for r in prep.min_history(df, SPEC, 60).select("sku").distinct().collect()} == {"n60", "zero"}
    assert {r.sku for r in prep.drop_zero_series(df, SPEC).select("sku").distinct().collect()} == {"n59", "n60"}


def test_densify(panel_of, by_series):
    df = panel_of({"a": [1, 2, 3, 4, 5, 6], "b": [9, 8, 7, 6, 5, 4]}, category={"a": "x", "b": ["u", None, None, "v", "v", "v"]})
    holes = df.where("NOT (sku = 'a' AND day(date) IN (1, 2, 4)) AND NOT (sku = 'b' AND day(date) IN (3, 6))")
    full = prep.densify(holes, SPEC)
    assert full.count() == 12
    assert by_series(full, "sales") == {"a": [N, N, 3.0, N, 5.0, 6.0], "b": [9.0, 8.0, N, 6.0, 5.0, N]}
    assert by_series(full, "category") == {"a": ["x"] * 6, "b": ["u", "u", "u", "v", "v", "v"]}
    assert by_series(prep.densify(full, SPEC), "sales") == by_series(full, "sales")


def test_duplicate_keys_are_reported(panel_of):
    df = panel_of({"a": [1, 2]})
    assert prep.assert_unique_keys(df, SPEC) is df
    with pytest.raises(ValueError, match="duplicate"):
        prep.assert_unique_keys(df.union(df), SPEC)


def test_prepare_orders(panel_of):
    df = panel_of({"long": list(range(70)), "brief": [1] * 10}).where("NOT (sku = 'long' AND day(date) = 15)")
    out = prepare_panel(df, SPEC, PrepOptions())
    assert out.count() == 70 and out.where("sales IS NULL").count() == 2       # 15 January and 15 February, targets left missing
    first = prepare_panel(df, SPEC, PrepOptions(densify_first=True, min_history=0))
    assert first.count() == 140 and first.where("sales IS NULL").count() == 0


def test_quality_report(panel_of):
    raw = panel_of({"a": [1, N, 3], "b": [N, 2, 2]}).unionByName(panel_of({"a": [5]}).withColumn("sku", F.lit(None).cast("string")))
    kept = raw.where("sku = 'a'")
    row = prep.quality_report(raw, prep.impute_zero(raw.where("sku IS NOT NULL"), SPEC), kept, SPEC).first()
    assert row.asDict() == {"initial_missing": 2, "final_missing": 0, "initial_series": 2, "removed_series": 1, "rows_without_id": 1}


def test_read_panel_rejects_bad_dates(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("sku,date,sales,promo_flag,extra\na,2024-01-01,3,1,x\n,2024-01-01,3,1,x\nb,2024-01-02,NaN,0,y\n")
    rows = tables.read_panel(spark, str(path), SPEC).orderBy("sku").collect()
    assert [(r.sku, r.sales, r.promo_flag, r.extra) for r in rows] == [("a", 3.0, 1, "x"), ("b", None, 0, "y")]
    path.write_text("sku,date,sales\na,2024-13-01,3\n")
    with pytest.raises(Exception):
        tables.read_panel(spark, str(path), SPEC).collect()
    assert tables.read_panel(spark, str(path), SPEC, lenient=True).first().date is None
