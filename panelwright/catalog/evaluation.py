"""Evaluation of a forecast: the last 14 rows of every series, predicted by the row a week back."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from panelwright import scale
from panelwright.catalog.base import BODIES, R, SPEC, panel, r, register
from panelwright.catalog.forecasts import _BT, _ROUNDS, _models, _selection
from panelwright.catalog.preparation import _BOUNDS
from panelwright.functions.numeric import in_order, whole
from panelwright.operators import evaluate, forecast, frames, report
from panelwright.plans import forecasting, state
from panelwright.sources import tables
from panelwright.spec import ForecastOptions, Settings

KEY = ["sku", "date"]

_AHEAD = """
seq_ AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY date DESC) AS rn,
                lag(sales, 7) OVER (PARTITION BY sku ORDER BY date) AS mean FROM panel),
fc AS (SELECT sku, date, mean, mean - 5 AS q_0_1, mean + 5 AS q_0_9 FROM seq_ WHERE rn <= 14)"""


def _forecast(spark, sf):
    df = panel(spark, sf).withColumn("mean", F.lag("sales", 7).over(in_order(SPEC)))
    return frames.last_rows(df, SPEC, 14).select(
        *KEY, "mean", (F.col("mean") - 5).alias("q_0_1"), (F.col("mean") + 5).alias("q_0_9"))


def _aligned(spark, sf):
    return evaluate.align(panel(spark, sf), _forecast(spark, sf), SPEC, 14)


_ALIGNED = f"""{_AHEAD},
al AS (SELECT p.sku, p.date, p.sales AS actual, p.promo_flag, f.mean AS predicted FROM panel p JOIN fc f ON f.sku = p.sku AND f.date = p.date),
ok AS (SELECT * FROM al WHERE actual <> 0 AND coalesce(promo_flag, 0) <> 1)"""


@register("align_by_date", f"WITH {_ALIGNED} SELECT * FROM al")
def align_by_date(spark, sf):
    return _aligned(spark, sf)


@register("align_by_position", f"""
WITH {_AHEAD}, moved AS (SELECT sku, date + 400 AS date, mean FROM fc WHERE sku NOT LIKE '%#1%' OR mean > 20),
a AS (SELECT sku, date, sales AS actual, promo_flag, row_number() OVER (PARTITION BY sku ORDER BY date) AS k, count(*) OVER (PARTITION BY sku) AS n
      FROM seq_ WHERE rn <= 14),
f AS (SELECT sku, mean, row_number() OVER (PARTITION BY sku ORDER BY date) AS k, count(*) OVER (PARTITION BY sku) AS n FROM moved)
SELECT a.sku, a.date, a.actual, a.promo_flag, f.mean AS predicted FROM a JOIN f ON f.sku = a.sku AND f.k = a.k AND f.n = a.n""")
def align_by_position(spark, sf):
    """Forecast dates far from the actual ones, and some forecast rows missing."""
    fc = _forecast(spark, sf).where(~F.col("sku").contains("#1") | (F.col("mean") > 20))
    fc = fc.select("sku", F.date_add("date", 400).alias("date"), "mean")
    return evaluate.align(panel(spark, sf), fc, SPEC, 14, how="position").select(*KEY, "actual", "promo_flag", "predicted")


@register("length_mismatch", f"""
WITH {_AHEAD}, moved AS (SELECT * FROM fc WHERE sku NOT LIKE '%#1%' OR mean > 20),
a AS (SELECT sku, least(count(*), 14) AS n_actual FROM panel GROUP BY sku),
f AS (SELECT sku, count(*) AS n_forecast FROM moved GROUP BY sku)
SELECT a.sku, n_actual, coalesce(n_forecast, 0) AS n_forecast FROM a LEFT JOIN f ON f.sku = a.sku WHERE n_actual <> coalesce(n_forecast, 0)""")
def length_mismatch(spark, sf):
    fc = _forecast(spark, sf).where(~F.col("sku").contains("#1") | (F.col("mean") > 20))
    return evaluate.mismatched(panel(spark, sf), fc, SPEC, 14)


@register("scored_rows", f"WITH {_ALIGNED} SELECT * FROM ok")
def scored_rows(spark, sf):
    return evaluate.scored_rows(_aligned(spark, sf))


@register("point_column", f"WITH {_AHEAD} SELECT sku, date, mean AS point, mean AS median FROM fc")
def point_column(spark, sf):
    fc = _forecast(spark, sf)
    only = fc.select(*KEY, "q_0_9", F.col("mean").alias("0.5"))
    first = evaluate.point_column(fc.columns[2:])
    return fc.select(*KEY, F.col(first).alias("point")).join(
        only.select(*KEY, F.col(f"`{evaluate.point_column(only.columns[2:])}`").alias("median")), KEY)


_M = {
    "weighted_mape": "100 * sum(abs(predicted - actual) / actual * actual) / sum(actual)",
    "bias_pct": "100 * sum(predicted - actual) / sum(actual)",
    "under_bias_pct": "100 * coalesce(sum(predicted - actual) FILTER (WHERE predicted < actual), 0) / sum(actual)",
    "over_bias_pct": "100 * coalesce(sum(predicted - actual) FILTER (WHERE predicted > actual), 0) / sum(actual)",
    "rmse": "sqrt(avg(pow(predicted - actual, 2)))",
    "mae": "avg(abs(predicted - actual))",
}
_METRICS = ", ".join(f"{R(e)} AS {n}" for n, e in _M.items()) + \
    ", count(*) AS n_samples, (SELECT count(DISTINCT sku) FROM panel) AS n_skus"


def _metrics(spark, sf):
    df = panel(spark, sf)
    return evaluate.metrics(evaluate.align(df, _forecast(spark, sf), SPEC, 14), evaluate.count_series(df, SPEC))


@register("evaluation_metrics", f"WITH {_ALIGNED} SELECT {_METRICS} FROM ok")
def evaluation_metrics(spark, sf):
    return _metrics(spark, sf).withColumns({m: r(m) for m in _M})


@register("evaluation_metrics_empty", f"""
SELECT {', '.join(f'CAST(NULL AS DOUBLE) AS {n}' for n in _M)}, CAST(0 AS BIGINT) AS n_samples, CAST(0 AS BIGINT) AS n_skus
FROM panel GROUP BY 1""")
def evaluation_metrics_empty(spark, sf):
    """All actual values out of stock."""
    none = _aligned(spark, sf).withColumn("actual", F.lit(0.0))
    return evaluate.metrics(none, evaluate.count_series(panel(spark, sf), SPEC))


@register("write_metrics", f"WITH {_ALIGNED} SELECT {_METRICS} FROM ok")
def write_metrics(spark, sf):
    path = f"{scale.checkpoint_folder(spark)}/metrics-{uuid.uuid4().hex}"
    one = _metrics(spark, sf).withColumns({m: r(m) for m in _M})
    tables.write_metrics(one, path)
    return spark.read.schema(one.schema).json(path)


_LINES = [("'" + "=" * 60 + "'"), "'FORECAST EVALUATION REPORT'", "'" + "=" * 60 + "'", "''",
          "'EVALUATION METRICS (excluding OOS and promo periods)'", "'" + "-" * 60 + "'",
          "'Number of SKUs evaluated: ' || n_skus", "'Number of valid samples: ' || n_samples",
          "printf('Weighted MAPE: %.2f%%', weighted_mape)", "printf('Overall Bias %%: %.2f%%', bias_pct)",
          "printf('Under Bias %% (pred < actual): %.2f%%', under_bias_pct)",
          "printf('Over Bias %% (pred > actual): %.2f%%', over_bias_pct)",
          "printf('RMSE: %.2f', rmse)", "printf('MAE: %.2f', mae)", "'" + "=" * 60 + "'"]


@register("metrics_report", f"""
WITH {_ALIGNED}, m AS (SELECT {_METRICS} FROM ok),
t AS (SELECT [{', '.join(_LINES)}] AS lines FROM m)
SELECT CAST(i - 1 AS INTEGER) AS line_no, lines[i] AS text FROM t, generate_series(1, {len(_LINES)}) g(i)""")
def metrics_report(spark, sf):
    return report.metrics_report(_metrics(spark, sf))


@register("residuals", f"""
WITH {_ALIGNED} SELECT sku, date, {R('actual - predicted')} AS residual,
  {R('sqrt(avg(pow(actual - predicted, 2)) OVER (PARTITION BY sku))')} AS rmse FROM al""")
def residuals(spark, sf):
    return evaluate.residuals(_aligned(spark, sf), SPEC).select(*KEY, r("residual"), r("rmse"))


@register("series_errors", f"""
WITH {_ALIGNED} SELECT sku, {R('avg(abs(actual - predicted))')} AS mae,
  {R('100 * avg(abs(actual - predicted) / abs(actual)) FILTER (WHERE actual <> 0)')} AS mape FROM al GROUP BY sku""")
def series_errors(spark, sf):
    return evaluate.series_errors(_aligned(spark, sf), SPEC).select("sku", r("mae"), r("mape"))


@register("holdout_chart", f"""
WITH {_AHEAD}, c AS (SELECT sku, coalesce(max(date) FILTER (WHERE rn > 14), min(date)) AS cutoff FROM seq_ GROUP BY sku)
SELECT s.sku, date, CASE WHEN rn > 14 THEN 'history' ELSE 'actual' END AS kind, sales AS value, CAST(NULL AS DOUBLE) AS lower,
       CAST(NULL AS DOUBLE) AS upper, cutoff FROM seq_ s JOIN c ON c.sku = s.sku WHERE rn <= 74
UNION ALL SELECT f.sku, date, 'forecast', mean, q_0_1, q_0_9, cutoff FROM fc f JOIN c ON c.sku = f.sku""")
def holdout_chart(spark, sf):
    return evaluate.holdout_chart(panel(spark, sf), _forecast(spark, sf), SPEC, 14, 60)


@register("future_chart", f"""
WITH {_AHEAD} SELECT sku, date, 'history' AS kind, sales AS value, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper
FROM seq_ WHERE rn <= 90
UNION ALL SELECT sku, date + 14, 'forecast', mean, q_0_1, q_0_9 FROM fc""")
def future_chart(spark, sf):
    ahead = _forecast(spark, sf).withColumn("date", F.date_add("date", 14))
    return evaluate.future_chart(panel(spark, sf), ahead, SPEC, 90)


@register("train_and_evaluate")
def train_and_evaluate(spark, sf):
    """Preparation, features, backtest, forecast and metrics in one run."""
    return forecasting.train_predict(panel(spark, sf), Settings())["metrics"]


@register("train_then_predict")
def train_then_predict(spark, sf):
    """Train, store, reload, and forecast beyond the data."""
    path, settings = f"{scale.checkpoint_folder(spark)}/trained-{uuid.uuid4().hex}", Settings()
    forecasting.save(forecasting.train(panel(spark, sf), settings), spark, path)
    return forecasting.predict(panel(spark, sf), forecasting.load(spark, path), settings)


def _renamed(sql: str) -> str:
    """A second set of fits beside the first."""
    return re.sub(r"\b(fits|wd|pred)\b", r"\1_final", sql)


# the whole run by its parts: prepared and cleaned panel, backtest, greedy selection, forecast from the cut, metrics
_RUN = f"""
WITH {_BOUNDS.replace('FROM gappy', 'FROM panel').strip()},
kept AS (SELECT c.sku, c.date, c.sales, p.promo_flag FROM clipped c JOIN panel p ON p.sku = c.sku AND p.date = c.date
         WHERE c.sku IN (SELECT sku FROM clipped GROUP BY sku HAVING count(*) >= 60)),
limits AS (SELECT min(date) AS lo, max(date) AS hi FROM kept),
cells AS (SELECT sku, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT DISTINCT sku FROM kept), limits),
middle AS (SELECT quantile_cont(sales, 0.5) AS m FROM kept),
clean_ AS (SELECT c.sku, c.date, coalesce(k.sales, m) AS sales, coalesce(k.promo_flag, 0) AS promo_flag
           FROM cells c LEFT JOIN kept k ON k.sku = c.sku AND k.date = c.date, middle),
{_BT.replace('FROM panel', 'FROM clean_').strip().removeprefix('WITH ')}, {_selection()},
rounds_ AS ({' UNION ALL '.join(f'SELECT {k} AS k, e, c FROM pick_{k}' for k in range(1, _ROUNDS + 1))}),
best_ AS (SELECT k, c FROM rounds_ ORDER BY e, k LIMIT 1),
now_ AS (SELECT sku, date, sales, 0 AS window_no, back AS rn FROM train),
{_renamed(_models('now_'))},
fc AS (SELECT sku, date, list_sum(list_transform(list_zip([{', '.join(forecast.MODELS)}], c), lambda z: z[1] * z[2])) / k AS mean FROM pred_final, best_),
al AS (SELECT p.sku, p.date, p.sales AS actual, p.promo_flag, f.mean AS predicted FROM clean_ p JOIN fc f ON f.sku = p.sku AND f.date = p.date),
ok AS (SELECT * FROM al WHERE actual <> 0 AND coalesce(promo_flag, 0) <> 1)"""


@register("train_and_evaluate_closed_forms", f"""{_RUN}
SELECT {_METRICS.replace('FROM panel', 'FROM clean_')}, CAST(0 AS BIGINT) AS n_unmatched, CAST(0 AS BIGINT) AS n_unmatched_skus FROM ok""")
def train_and_evaluate_closed_forms(spark, sf):
    """The whole run without the regression: preparation, cleanup, backtest, selection, forecast and metrics."""
    settings = Settings(forecast=ForecastOptions(global_model=False, ensemble_rounds=_ROUNDS))
    return forecasting.train_predict(panel(spark, sf), settings)["metrics"].withColumns({m: r(m) for m in _M})


@register("train_and_forecast_closed_forms", f"{_RUN} SELECT sku, date, {R('mean')} AS mean FROM fc")
def train_and_forecast_closed_forms(spark, sf):
    """The forecast of that run, stored and read again."""
    settings = Settings(forecast=ForecastOptions(global_model=False, ensemble_rounds=_ROUNDS))
    return forecasting.train_predict(panel(spark, sf), settings)["forecast"].select(*KEY, r("mean"))


@register("train_then_predict_from_state", f"""{_RUN.replace("now_ AS (SELECT sku, date, sales, 0 AS window_no, back AS rn FROM train)", "now_ AS (SELECT sku, date, sales, 0 AS window_no, rn FROM back_)")}
SELECT sku, date, {R('mean')} AS mean FROM fc""")
def train_then_predict_from_state(spark, sf):
    """Train, store the model and the state of every series, and forecast beyond the data from these alone."""
    settings = Settings(forecast=ForecastOptions(global_model=False, ensemble_rounds=_ROUNDS))
    path = f"{scale.checkpoint_folder(spark)}/trained-{uuid.uuid4().hex}"
    raw = panel(spark, sf)
    forecasting.save(forecasting.train(raw, settings), spark, path)
    cleaned, _ = forecasting.cleaned_history(raw, settings)
    state.store(forecasting.series_state(cleaned, settings), f"{path}/state", SPEC.id, [], 4)
    return forecasting.predict_from_state(state.stored(spark, f"{path}/state"), forecasting.load(spark, path), settings).select(*KEY, r("mean"))


@register("state_with_new_days", BODIES["baseline_forecasts"].replace(" FROM pred", f", {R('trend_weekday')} AS trend_weekday FROM pred"))
def state_with_new_days(spark, sf):
    """The state of the history up to a year before its end, merged with what came later, forecasts like the whole history."""
    df = scale.written(panel(spark, sf).select(*KEY, "sales"))
    cut = F.date_sub(F.max("date").over(whole(SPEC)), 365)
    early = df.withColumn("_cut", cut).where(F.col("date") <= F.col("_cut")).drop("_cut")
    after = state.merged(state.series_state(early, SPEC), df, SPEC)
    return state.forecasts(after, SPEC).select(*KEY, "step", *[r(m) for m in forecast.MODELS])
