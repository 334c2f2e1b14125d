"""The regression over all series, and the modes around it."""

import dataclasses
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright import ForecastOptions, PanelSpec, Settings, scale
from panelwright.operators import evaluate, forecast, prepare, regression
from panelwright.plans import forecasting
from panelwright.plans.prepare import prepare_panel
from panelwright.sources import tables
from panelwright.sources.retail import daily_panel

SPEC = PanelSpec()
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("kind", ["panel", "gappy", "prepared"])
def test_every_series_gets_its_horizon(spark, kind):
    df = daily_panel(spark, SF, gappy=kind != "panel")
    df = scale.written(prepare_panel(df, SPEC) if kind == "prepared" else df)
    model = regression.fit_global(df, SPEC, 14)
    out = regression.predict_global(model, df, SPEC)
    good = out.agg(F.count(F.lit(1)), F.count_if(F.col("mean").isNotNull() & ~F.isnan("mean")), F.countDistinct("sku", "step")).first()
    assert set(good) == {14 * df.select("sku").distinct().count()}


def test_short_and_empty_series(panel_of):
    df = panel_of({"long": [float(i % 7) for i in range(90)], "short": [3.0], "none": [None] * 20}, category={"long": "a", "short": None, "none": "b"})
    out = regression.predict_global(regression.fit_global(df, SPEC, 14), df, SPEC).collect()
    assert len(out) == 42 and all(r.mean is not None and np.isfinite(r.mean) for r in out)


def test_thousands_of_categories(spark):
    rows = spark.range(5000 * 4).select(
        F.concat(F.lit("s"), F.col("id") % 5000).alias("sku"), F.expr("date_add(DATE'2024-01-01', cast(id / 5000 as int))").alias("date"),
        (F.col("id") % 5000 % 50).cast("double").alias("sales"), F.concat(F.lit("c"), F.col("id") % 5000).alias("category"))
    for kind in ("linear", "trees"):
        model = regression.fit_global(rows, SPEC, 2, kind)
        names = [r.feature for r in regression.feature_importance(model, 100).collect()]
        assert "category_level" in names and (kind == "linear" or names[0] == "category_level")
    assert regression.predict_global(model, rows, SPEC).count() == 10_000


def test_backtest_does_not_look_past_its_cut(panel_of):
    rng = np.random.default_rng(2)
    values = {f"s{i}": rng.integers(1, 40, 80).astype(float).tolist() for i in range(4)}
    opts = ForecastOptions(horizon=7, val_windows=2, val_step=7)
    a = regression.backtest_global(panel_of(values), SPEC, opts)
    changed = {k: v[:-7] + [999.0] * 7 for k, v in values.items()}
    b = regression.backtest_global(panel_of(changed), SPEC, opts)
    assert a.count() == 4 * 2 * 7
    got = [{(r.sku, r.date): r[regression.NAME] for r in x.where(f"window_no = {k}").collect()} for x in (a, b) for k in (0, 1)]
    assert got[0].keys() == got[2].keys() and all(got[0][k] == pytest.approx(got[2][k]) for k in got[0])
    assert all(got[1][k] == pytest.approx(got[3][k]) for k in got[1])


@pytest.fixture
def job(spark, tmp_path):
    """A panel with strong promotions, and settings that use it."""
    rng = np.random.default_rng(9)
    lines = ["item,day,units,promo_flag,promo_discount,special_event,category,stock"]
    for s in range(5):
        for d in range(120):
            promo = rng.random() < 0.2
            units = 20 + 5 * (d % 7) + 30 * promo + rng.integers(0, 3)
            lines.append(f"i{s},{np.datetime64('2023-01-01') + d},{units},{float(promo) if d else ''},{0.3 if promo else 0},0,c{s % 2},{s + 0.5}")
    (tmp_path / "train.csv").write_text("\n".join(lines))
    cfg = {"data": {"train_path": str(tmp_path / "train.csv"), "id_column": "item", "timestamp_column": "day", "target_column": "units",
                    "datetime_format": "%Y-%m-%d", "test_size": 14}, "features": {"static_features": ["category"]},
           "model": {"prediction_length": 14, "save_path": str(tmp_path / "model"), "num_val_windows": 1, "val_step_size": 14,
                     "quantile_levels": [0.1, 0.5, 0.9]},
           "output": {"predictions_path": str(tmp_path / "out.csv"), "metrics_path": str(tmp_path / "metrics")}}
    return cfg, tmp_path


def test_plan_changes_the_forecast_and_training_keeps_the_model(spark, job, monkeypatch):
    cfg, path = job
    monkeypatch.setenv("TMPDIR", str(path))
    before = scale.checkpoint_folder(spark)
    out = forecasting.run(spark, Settings.from_dict(cfg), "train_predict")
    assert out["forecast"].count() == 70
    metrics = spark.read.json(str(path / "metrics")).first()
    assert (metrics.n_unmatched, metrics.n_unmatched_skus) == (0, 0)
    assert "FORECAST EVALUATION REPORT" in [r.value for r in spark.read.text(str(path / "metrics_report.txt")).collect()]
    assert (path / "out_leaderboard").exists() and (path / "out_importance").exists() and (path / "out_holdout_chart").exists()
    board = spark.read.option("header", True).csv(str(path / "out_leaderboard")).collect()
    scores = {r.model: float(r.score_val) for r in board}
    assert max(scores, key=scores.get) == regression.NAME        # the only model that sees promotions
    plain = {tuple(r)[:2]: r.mean for r in forecasting.run(spark, Settings.from_dict(cfg), "predict")["forecast"].collect()}
    plan = ["item,day,promo_flag,promo_discount,special_event"]
    plan += [f"i{s},{np.datetime64('2023-05-01') + d},1.0,0.3,0" for s in range(5) for d in range(14) if s < 3]
    (path / "promo.csv").write_text("\n".join(plan))
    cfg["data"]["future_promo_path"] = str(path / "promo.csv")
    promoted = {tuple(r)[:2]: r.mean for r in forecasting.run(spark, Settings.from_dict(cfg), "predict")["forecast"].collect()}
    assert plain.keys() == promoted.keys() and len(plain) == 70
    assert all((promoted[k] > plain[k] + 3) == (k[0] in ("i0", "i1", "i2")) for k in plain)
    assert not [d for d in os.listdir(before.removeprefix("file://")) if d.startswith("panel-") and os.path.getmtime(f"{before}/{d}") > os.path.getmtime(path / "metrics")]


def test_cost_moves_choice_and_point(spark, job):
    cfg, path = job
    raw = tables.read_panel(spark, cfg["data"]["train_path"], Settings.from_dict(cfg).panel)
    assert dict(raw.dtypes)["stock"] == "double" and dict(raw.dtypes)["promo_flag"] == "int" and raw.where("promo_flag IS NULL").count() == 5
    base = Settings.from_dict(cfg)
    dear = dataclasses.replace(base, forecast=dataclasses.replace(base.forecast, use_cost=True, eval_metric="cost", over_penalty=9.0, global_model=False))
    low, mean = (forecasting.predict(raw, forecasting.train(raw, s), s).agg(F.avg("mean")).first()[0]
                 for s in (dear, dataclasses.replace(base, forecast=dataclasses.replace(base.forecast, global_model=False))))
    assert low < mean
    tested = forecast.backtest(raw.select("item", "day", "units"), base.panel, base.forecast)
    mae, rmse = (forecast.leaderboard(tested, opts=dataclasses.replace(base.forecast, eval_metric=m)).agg(F.sum("score_val")).first()[0] for m in ("mae", "rmse"))
    assert rmse < mae < 0


def test_a_fraction_is_no_flag(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sku,date,sales,promo_flag\na,2024-01-01,1,0.5\n")
    with pytest.raises(Exception, match="is no flag"):
        tables.read_panel(spark, str(tmp_path / "a.csv"), SPEC).collect()


def test_densify_refuses_a_repeated_day(spark):
    rows = [("a", "2024-01-01"), ("a", "2024-01-05"), ("a", "2024-01-05"), ("a", "2024-01-07")]
    df = spark.createDataFrame(rows, "sku string, date string").selectExpr("sku", "to_date(date) AS date", "1D AS sales")
    with pytest.raises(Exception, match="two rows for one"):
        prepare.densify(df, SPEC).collect()
    assert prepare.densify(df.distinct(), SPEC).count() == 7


def test_unmatched_days_are_counted(panel_of):
    days = panel_of({"a": [1, 2, 3], "b": [4, 5, 6]})
    got = evaluate.unmatched(days, days.where("sku = 'a' AND sales < 3"), SPEC).first()
    assert tuple(got) == (4, 2)


def test_work_folder_must_be_shared(spark):
    class Session:
        class conf:
            get = staticmethod(lambda k, d=None: {"spark.master": "spark://host:7077"}.get(k, d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scale.checkpoint_folder(Session())


def test_settings_from_costs():
    opts = Settings.from_dict({"model": {"asymmetric_loss": {"over_penalty_factor": 2.0}, "eval_metric": "RMSE"}}).forecast
    assert opts.use_cost and opts.eval_metric == "cost" and opts.over_penalty == 2.0
    assert Settings.from_dict({"model": {"eval_metric": "RMSE"}}).forecast.eval_metric == "rmse"
    assert json.dumps(dataclasses.asdict(opts))
