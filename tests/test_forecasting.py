import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright import ForecastOptions, PanelSpec, Settings
from panelwright.operators import evaluate, forecast, frames, report
from panelwright.plans import forecasting

SPEC = PanelSpec()


def test_baselines_on_simple_series(panel_of):
    df = panel_of({"line": list(range(1, 43)), "week": [1, 2, 3, 4, 5, 9, 8] * 6, "one": [5]})
    rows = {(r.sku, r.step): r for r in forecast.point_forecasts(df, SPEC, 9).collect()}
    assert rows[("line", 9)].drift == pytest.approx(51) and rows[("line", 9)].trend_weekday == pytest.approx(51)
    assert [rows[("week", s)].seasonal_naive for s in range(1, 10)] == [1, 2, 3, 4, 5, 9, 8, 1, 2]
    assert rows[("line", 1)].moving_average == np.mean(range(15, 43))
    assert all(rows[("one", 1)][m] == 5 for m in forecast.MODELS)


def test_split_is_a_partition(panel_of):
    df = panel_of({"a": range(30), "b": range(20)})
    train, test = frames.train_test_split(df, SPEC, 14)
    assert train.count() == 22 and test.count() == 50
    roles = {(r.role, r["count"]) for r in frames.split_roles(df, SPEC, 14).groupBy("role").count().collect()}
    assert roles == {("train", 22), ("holdout", 28)}


def test_validation_windows(panel_of):
    opts = ForecastOptions(horizon=3, val_windows=2, val_step=4)
    rows = frames.validation_windows(panel_of({"a": range(10)}), SPEC, opts).collect()
    valid = {(r.window_no, r.step): r.sales for r in rows if r.role == "valid"}
    assert valid == {(0, 1): 7, (0, 2): 8, (0, 3): 9, (1, 1): 3, (1, 2): 4, (1, 3): 5}
    assert sum(r.role == "train" for r in rows) == 7 + 3


def test_quantiles_are_monotone(panel_of):
    rng = np.random.default_rng(3)
    df = panel_of({f"s{i}": list(rng.integers(1, 50, 80)) for i in range(5)})
    tested = forecast.backtest(df, SPEC)
    offsets = forecast.residual_quantiles(tested, forecast.MODELS, (0.9, 0.1, 0.5))
    out = forecast.with_quantiles(forecast.to_long(forecast.point_forecasts(df, SPEC)), offsets, (0.9, 0.1, 0.5))
    assert out.where("NOT (q_0_1 <= q_0_5 AND q_0_5 <= q_0_9)").count() == 0 and out.count() == 5 * 14 * 4
    weights = forecast.ensemble_weights(forecast.leaderboard(tested)).agg(F.sum("weight")).first()[0]
    assert weights == pytest.approx(1.0)


def test_metrics_by_hand(spark):
    rows = [("a", 10.0, 12.0, 0), ("a", 20.0, 15.0, 0), ("b", 0.0, 4.0, 0), ("b", 8.0, 1.0, 1), ("b", 5.0, 5.0, None)]
    df = spark.createDataFrame([(k, i, a, p, f) for i, (k, a, p, f) in enumerate(rows)],
                               "sku string, date int, actual double, predicted double, promo_flag int")
    m = evaluate.metrics(df, spark.range(1).selectExpr("2L AS n")).first()
    assert m.weighted_mape == pytest.approx(100 * 7 / 35) and m.bias_pct == pytest.approx(-100 * 3 / 35)
    assert m.under_bias_pct == pytest.approx(-100 * 5 / 35) and m.over_bias_pct == pytest.approx(100 * 2 / 35)
    assert (m.n_samples, m.n_skus) == (3, 2) and m.mae == pytest.approx(7 / 3)
    none = evaluate.metrics(df.where("actual = 0"), spark.range(1).selectExpr("2L AS n"))
    assert none.first().asDict() == {k: (0 if k in ("n_samples", "n_skus") else None) for k in evaluate.METRICS}
    text = [r.text for r in report.metrics_report(none).orderBy("line_no").collect()]
    assert "Weighted MAPE: nan%" in text and "Number of valid samples: 0" in text


def test_point_column():
    assert evaluate.point_column(["0.1", "mean", "0.5"]) == "mean"
    assert evaluate.point_column(["0.1", "0.5"]) == "0.5" and evaluate.point_column(["x", "y"]) == "x"


def test_modes_from_json(spark, tmp_path):
    rng = np.random.default_rng(9)
    lines = ["item,day,units,promo_flag,category"]
    for s in range(6):
        for d in range(120):
            day = np.datetime64("2023-01-01") + d
            if rng.random() > 0.05:
                lines.append(f"i{s},{day},{int(20 + 5 * (d % 7) + rng.integers(0, 5))},{int(rng.random() < 0.1)},c{s % 2}")
    (tmp_path / "train.csv").write_text("\n".join(lines))
    config = {
        "data": {"train_path": str(tmp_path / "train.csv"), "id_column": "item", "timestamp_column": "day",
                 "target_column": "units", "datetime_format": "%Y-%m-%d", "test_size": 14},
        "features": {"static_features": ["category"]},
        "model": {"prediction_length": 14, "save_path": str(tmp_path / "model"), "num_val_windows": 2, "val_step_size": 14,
                  "quantile_levels": [0.1, 0.5, 0.9]},
        "output": {"predictions_path": str(tmp_path / "forecast"), "metrics_path": str(tmp_path / "metrics.json")}}
    path = tmp_path / "config.json"
    path.write_text(json.dumps(config))
    settings = Settings.from_json(str(path))
    assert settings.panel.target == "units" and settings.forecast.quantiles == (0.1, 0.5, 0.9)

    out = forecasting.run(spark, settings, "train_predict")
    m = spark.read.json(str(tmp_path / "metrics.json")).first()
    assert m.n_skus == 6 and 0 < m.weighted_mape < 30
    assert out["forecast"].count() == 6 * 14
    assert spark.read.option("header", True).csv(str(tmp_path / "forecast")).columns == ["item", "day", "mean", "q_0_1", "q_0_5", "q_0_9"]
    assert "FORECAST EVALUATION REPORT" in [r.value for r in spark.read.text(str(tmp_path / "metrics_report.txt")).collect()]

    assert forecasting.run(spark, settings, "train") == {}
    ahead = forecasting.run(spark, settings, "predict")["forecast"]
    assert ahead.agg(F.min("day")).first()[0].isoformat() == "2023-05-01" and ahead.count() == 84
    placed = forecasting.train_predict(forecasting.tables.read_panel(spark, str(tmp_path / "train.csv"), settings.panel),
                                       settings, alignment="position")
    assert placed["metrics"].first().n_samples > 0
