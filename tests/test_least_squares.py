"""Sums, ridge, importance, ensemble selection and positional category features against plain loops."""

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright import ForecastOptions, PanelSpec, scale
from panelwright.operators import cross, forecast, regression
from panelwright.operators.least_squares import cross_sums, ridge
from panelwright.sources.retail import daily_panel

SPEC = PanelSpec()


def test_sums_add_up_over_segments(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 3))
    seg = rng.integers(0, 3, 500)
    df = spark.createDataFrame([(int(s), *map(float, r)) for s, r in zip(seg, x)] + [(1, None, 2.0, 0.0)], "s int, a double, b double, c double").repartition(7)
    got = cross_sums(df, ["a", "b"], ["b", "c"], "s")
    for k in range(3):
        want = x[seg == k][:, :2].T @ x[seg == k][:, 1:] + (np.array([[0, 0], [4.0, 0]]) if k == 1 else 0)
        assert np.allclose(got[k], want)
    assert cross_sums(df.limit(0), ["a"], ["a"], "s") == {}


def test_ridge_is_the_least_penalised_error():
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.standard_normal(200), 2000 + rng.integers(0, 5, 200), np.full(200, 3.0), np.zeros(200)])
    y = 4 + 2 * x[:, 0] - 0.5 * x[:, 1] + 0.1 * rng.standard_normal(200)
    whole = np.column_stack([np.ones(200), x, y])
    a, b = ridge(whole.T @ whole, 0.0)
    assert np.allclose(b, [*np.linalg.lstsq(np.column_stack([np.ones(200), x[:, :2]]), y, rcond=None)[0][1:], 0, 0], atol=1e-6)
    assert a == pytest.approx(y.mean() - x.mean(0) @ b)
    a, b = ridge(whole.T @ whole, 0.3)

    def loss(c):
        e = (y - y.mean()) - (x - x.mean(0)) @ c
        return (e ** 2).mean() + 0.3 * (c ** 2 * x.var(0)).sum()
    for d in np.eye(4)[:2] * 1e-4:
        assert loss(b) < loss(b + d) and loss(b) < loss(b - d)
    assert ridge(np.zeros((6, 6)), 0.1)[1].tolist() == [0, 0, 0, 0]


def plain_fit(rows, names, cut):
    """Refit on the rows before the cut, with the levels computed anew."""
    used = [r for r in rows if r["_back"] > cut and r["sales"] is not None]
    overall = np.mean([r["sales"] for r in used])
    level = {}
    for c in ("category", "brand"):
        for v in {r[c] for r in rows}:
            of = [r["sales"] for r in used if r[c] == v and v is not None]
            level[c, v] = (sum(of) + 20 * overall) / (len(of) + 20) if of else overall

    def inputs(r):
        lags = [r[c] + overall * r["no_history"] if c in regression.lag_names(7) else r[c] for c in names]
        return [float(v) for v in lags] + [level[c, r[c]] for c in ("category", "brand")]
    x, y = np.array([inputs(r) for r in used]), np.array([r["sales"] for r in used])
    whole = np.column_stack([np.ones(len(y)), x, y])
    a, b = ridge(whole.T @ whole, regression.PENALTY)
    return lambda r: a + np.dot(inputs(r), b)


def test_every_cut_equals_its_own_fit(panel_of):
    rng = np.random.default_rng(5)
    sales = {f"s{i}": [None if rng.random() < 0.1 else float(v) for v in rng.integers(0, 30, n)] for i, n in enumerate((70, 55, 64, 30, 9, 3))}
    sales["none"] = [None] * 25
    df = panel_of(sales, promo_flag={k: rng.integers(0, 2, len(v)).tolist() for k, v in sales.items()},
                  category={k: "ab"[i % 2] if i < 5 else None for i, k in enumerate(sales)}, brand={k: f"b{i % 3}" for i, k in enumerate(sales)})
    opts = ForecastOptions(horizon=7, val_windows=3, val_step=5)
    model, tested = regression.fit_and_backtest(df, SPEC, opts)
    table, names = regression.inputs_table(df, SPEC, 7)
    rows = [r.asDict() for r in table.collect()]
    got = {(r.sku, r.window_no, r.date): r[regression.NAME] for r in tested.collect()}
    want = {}
    for k in range(3):
        fit = plain_fit(rows, names, 5 * k + 7)
        want |= {(r["sku"], k, r["date"]): fit(r) for r in rows if 5 * k < r["_back"] <= 5 * k + 7}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)
    fit = plain_fit(rows, names, 0)
    scored = {(r.sku, r.date): r["mean"] for r in regression._valued(model, regression.encoded_inputs(model, table, filled=False)).collect()}
    assert len(scored) == len(rows) and all(scored[r["sku"], r["date"]] == pytest.approx(fit(r), abs=1e-6) for r in rows)


def test_importance_equals_a_plain_permutation(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(80)]
    rng = np.random.default_rng(8)
    rows = [(f"s{s}", d, 10.0 + 25 * int(p), int(p), 0.0, 0, f"c{s % 2}") for s in range(6) for d in days for p in [rng.random() < 0.3]]
    df = spark.createDataFrame(rows, "sku string, date date, sales double, promo_flag int, promo_discount double, special_event int, category string")
    model = regression.fit_global(df, SPEC, 7)
    one, two = ([tuple(r) for r in regression.permutation_importance(model, x, SPEC, top=None, rows=30).collect()] for x in (df.repartition(3), df.repartition(11)))
    assert [c for c, _ in one] == [c for c, _ in two] and np.allclose([v for _, v in one], [v for _, v in two])
    assert one[0][0] == "promo_flag" and one[0][1] > 3 and len(one) == len(model.coefficients)
    table, _ = regression.inputs_table(df, SPEC, 7)
    chosen = regression.encoded_inputs(model, table.where("_back <= 30"), filled=False).withColumn("k", F.md5(F.concat_ws("|", F.lit("7"), "sku", F.col("date").cast("string"))))
    held = [r.asDict() for r in chosen.orderBy("k").collect()]
    mean = [model.intercept + sum(b * r[c] for c, b in model.coefficients.items()) for r in held]
    for c, value in one[:5]:
        moved = [m + model.coefficients[c] * (o[c] - r[c]) for m, r, o in zip(mean, held, held[1:] + held[:1])]
        assert value == pytest.approx(np.mean([abs(r["sales"] - v) - abs(r["sales"] - m) for r, v, m in zip(held, moved, mean)]), abs=1e-9)
    assert regression.permutation_importance(model, df.where("sku = 'x'"), SPEC).collect() == []


def plain_selection(rows, models, rounds):
    chosen = []
    for k in range(1, rounds + 1):
        errors = []
        for i, m in enumerate(models):
            mix = [np.mean([r[x] for x in [*[c for c, _ in chosen], m]]) for r in rows]
            errors.append((np.mean([abs(v - r["actual"]) for v, r in zip(mix, rows)]), i, m))
        chosen.append((min(errors)[2], min(errors)[0]))
    return chosen


def test_ensemble_selection(spark):
    rng = np.random.default_rng(3)
    actual = rng.integers(1, 40, 300).astype(float)
    models = ("a", "b", "c", "d")
    tested = [dict(actual=float(y), a=float(y + 6 + rng.normal()), b=float(y - 5 + rng.normal()), c=float(y + rng.normal(0, 9)), d=20.0) for y in actual]
    df = spark.createDataFrame([(r["actual"], r["a"], r["b"], r["c"], r["d"]) for r in tested] + [(None, 1.0, 1.0, 1.0, 1.0), (3.0, None, 1.0, 1.0, 1.0)],
                               "actual double, a double, b double, c double, d double")
    got, want = forecast.select_ensemble(df, models, rounds=8), plain_selection(tested, models, 8)
    assert [m for m, _ in got] == [m for m, _ in want] and np.allclose([e for _, e in got], [e for _, e in want])
    weights = forecast.selected_weights(got, models)
    assert sum(weights.values()) == pytest.approx(1) and weights["a"] > 0 and weights["b"] > 0 and weights["d"] == 0
    single = min(np.mean([abs(r[m] - r["actual"]) for r in tested]) for m in models)
    blend = np.mean([abs(sum(weights[m] * r[m] for m in models) - r["actual"]) for r in tested])
    assert blend == pytest.approx(min(e for _, e in got)) and blend < single
    assert forecast.select_ensemble(df.limit(0), models) == [] and forecast.selected_weights([], models) == dict.fromkeys(models, 0.25)
    for metric in ("rmse", "wape", "cost"):
        picked = forecast.select_ensemble(df, models, ForecastOptions(eval_metric=metric), 3)
        assert len(picked) == 3 and min(e for _, e in picked) <= picked[0][1]


def test_unknown_names_are_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "actual double, a double")
    with pytest.raises(ValueError, match="mape"):
        forecast.leaderboard(df, ("a",), ForecastOptions(eval_metric="mape"))
    with pytest.raises(ValueError, match="forest"):
        regression.fit_global(df, SPEC, 7, "forest")


def test_numbers_are_dense_and_in_order(spark):
    df = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(20_000)], "k string, i int").repartition(5)
    got = [(r.k, r.i) for r in scale.numbered(df, ["k", "i"], "n").orderBy("n").collect()]
    assert got == sorted((("hot" if i % 3 else f"k{i}"), i) for i in range(20_000))
    assert [r.n for r in scale.numbered(df, ["k", "i"], "n").select("n").orderBy("n").limit(3).collect()] == [0, 1, 2]


@pytest.mark.parametrize("chunk", [7, 16, 1000])
def test_positional_category_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(cross, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(chunk)
    rows = [(f"s{s:02}", dt.date(2024, 1, 1) + dt.timedelta(days=d), None if rng.random() < (0.9 if s == 4 else 0.2) else float(rng.integers(0, 4)), None if s == 9 else "ab"[s % 2])
            for s in range(10) for d in range(12)]
    df = spark.createDataFrame(rows, "sku string, date date, category_total_sales double, category string")
    out = cross.category_dynamics(df, SPEC, compat=True)
    got = {(r.sku, r.date): (r.category_growth_rate, r.category_volatility) for r in out.collect()}
    assert len(got) == len(rows) == out.count() and out.columns == [*df.columns, "category_growth_rate", "category_volatility"]
    for c, some in itertools.groupby(sorted((r for r in rows if r[3]), key=lambda r: (r[3], r[0], r[1])), key=lambda r: r[3]):
        some, padded, held = list(some), [], None
        for r in some:
            held = held if r[2] is None else r[2]
            padded.append(held)
        for i, r in enumerate(some):
            then, now = padded[i - 7] if i >= 7 else None, padded[i]
            if then is None or now is None:
                growth = 0.0
            elif then == 0:
                growth = 0.0 if now == 0 else 10.0
            else:
                growth = float(np.clip(now / then - 1, -10, 10))
            near = [x[2] for x in some[max(0, i - 6):i + 1] if x[2] is not None]
            spread = float(np.std(near, ddof=1)) if len(near) > 1 else 0.0
            assert got[r[0], r[1]] == (pytest.approx(growth), pytest.approx(spread))


def test_no_window_over_a_category_alone(spark):
    df = daily_panel(spark, "/root/testdata/sf0.001").withColumn("category_total_sales", F.col("sales"))
    plan = cross.category_dynamics(df, SPEC, compat=True)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert windows and all("windowspecdefinition(category" not in line for line in windows)
