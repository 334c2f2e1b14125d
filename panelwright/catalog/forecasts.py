"""Splits, validation windows, future frames and forecasts."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from panelwright import scale
from panelwright.catalog.base import R, SPEC, panel, r, register
from panelwright.catalog.calendars import HOLIDAYS_SQL, _int
from panelwright.operators import forecast, frames, regression
from panelwright.sources import tables
from panelwright.spec import ForecastOptions

KEY = ["sku", "date"]
OPTS = ForecastOptions()
Q = OPTS.quantiles
QNAMES = [forecast.quantile_name(q) for q in Q]

_BACK = "back_ AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY date DESC) AS rn FROM panel)"


@register("static_table", "SELECT sku, category, subcategory, brand, product_group FROM statics")
def static_table(spark, sf):
    return frames.static_table(panel(spark, sf), SPEC)


@register("static_table_first_known", """
SELECT sku, arg_min(c, date) FILTER (WHERE c IS NOT NULL) AS category
FROM (SELECT sku, date, CASE WHEN sales > 40 THEN category || '-' || month(date) END AS c FROM panel) GROUP BY sku""")
def static_table_first_known(spark, sf):
    holes = panel(spark, sf).select(*KEY, F.when(
        F.col("sales") > 40, F.concat_ws("-", "category", F.month("date"))).alias("category"))
    return frames.static_table(holes, SPEC)


@register("train_test_split", f"""
WITH {_BACK} SELECT sku, date, CASE WHEN rn > 14 THEN 'train' ELSE 'holdout' END AS role FROM back_""")
def train_test_split(spark, sf):
    return frames.split_roles(panel(spark, sf), SPEC, 14).select(*KEY, "role")


_TRAIN = "train AS (SELECT sku, date, sales, row_number() OVER (PARTITION BY sku ORDER BY date DESC) AS back FROM back_ WHERE rn > 14)"


@register("validation_windows", f"""
WITH {_BACK}, {_TRAIN}
SELECT sku, date, CAST(w AS INTEGER) AS window_no, CASE WHEN back - 14 * w <= 14 THEN 'valid' ELSE 'train' END AS role,
       CAST(CASE WHEN back - 14 * w <= 14 THEN 15 - (back - 14 * w) END AS INTEGER) AS step
FROM train, (VALUES (0), (1)) v(w) WHERE back - 14 * w >= 1""")
def validation_windows(spark, sf):
    train, _ = frames.train_test_split(panel(spark, sf), SPEC, 14)
    return frames.validation_windows(train, SPEC, OPTS).select(*KEY, "window_no", "role", "step")


@register("last_rows", f"WITH {_BACK} SELECT sku, date, sales FROM back_ WHERE rn <= 30")
def last_rows(spark, sf):
    return frames.last_rows(panel(spark, sf), SPEC, 30).select(*KEY, "sales")


@register("last_days", "SELECT sku, max(date) AS last_date FROM panel GROUP BY sku")
def last_days(spark, sf):
    return frames.last_days(panel(spark, sf), SPEC)


@register("first_series", """
SELECT sku, date, sales FROM panel WHERE sku IN (SELECT DISTINCT sku FROM panel ORDER BY sku LIMIT 5)""")
def first_series(spark, sf):
    return frames.first_series(panel(spark, sf), SPEC, 5).select(*KEY, "sales")


@register("distinct_days", "SELECT DISTINCT date FROM panel")
def distinct_days(spark, sf):
    return panel(spark, sf).select("date").distinct()


@register("append_frames", """
SELECT sku, date, sales FROM panel UNION ALL
SELECT sku, last_ + CAST(s AS INTEGER) AS date, NULL AS sales FROM (SELECT sku, max(date) AS last_ FROM panel GROUP BY sku), generate_series(1, 14) g(s)""")
def append_frames(spark, sf):
    df = panel(spark, sf).select(*KEY, "sales")
    return df.unionByName(frames.future_days(df, SPEC, 14).drop("step"), allowMissingColumns=True)


_FUTURE = f"""{HOLIDAYS_SQL},
last_ AS (SELECT sku, max(date) AS l FROM panel GROUP BY sku),
future AS (SELECT sku, l + CAST(s AS INTEGER) AS date, l + 1 AS d1, l + 14 AS d2 FROM last_, generate_series(1, 14) g(s))"""


@register("future_calendar", f"""
WITH {_FUTURE} SELECT sku, date, {_int('isodow(date) - 1', 'day_of_week')}, {_int('day(date)', 'day_of_month')},
  {_int('month(date)', 'month')}, {_int('week(date)', 'week_of_year')}, {_int('isodow(date) >= 6', 'is_weekend')},
  {R('sin(2 * pi() * dayofyear(date) / 30.44)')} AS day_of_year_sin_monthly,
  {_int('(isodow(date) >= 6)::INT * month(date)', 'weekend_month_interaction')} FROM future""")
def future_calendar(spark, sf):
    frame = frames.future_frame(panel(spark, sf), SPEC, 14)
    return frame.select(*KEY, "day_of_week", "day_of_month", "month", "week_of_year", "is_weekend",
                        r("day_of_year_sin_monthly"), "weekend_month_interaction")


@register("future_holidays", f"""
WITH {_FUTURE}, near AS (
  SELECT f.sku, f.date, CAST(coalesce(min(abs(date_diff('day', f.date, h.day))), 999) AS INTEGER) AS days_to_holiday
  FROM future f LEFT JOIN holidays h ON h.day BETWEEN f.d1 - 30 AND f.d2 + 30 GROUP BY f.sku, f.date)
SELECT sku, date, CAST(date IN (SELECT day FROM holidays) AS INTEGER) AS is_holiday, days_to_holiday,
       CAST(days_to_holiday = 1 AS INTEGER) AS is_pre_holiday,
       lead(CAST(days_to_holiday = 1 AS INTEGER), 1, 0) OVER (PARTITION BY sku ORDER BY date) AS is_post_holiday FROM near""")
def future_holidays(spark, sf):
    return frames.future_frame(panel(spark, sf), SPEC, 14).select(
        *KEY, "is_holiday", "days_to_holiday", "is_pre_holiday", "is_post_holiday")


@register("future_promo_join", f"""
WITH {_FUTURE}, plan AS (SELECT sku, date + 30 AS date, promo_flag, promo_discount, special_event FROM panel)
SELECT f.sku, f.date, coalesce(p.promo_flag, 0) AS promo_flag, coalesce(p.promo_discount, 0.0) AS promo_discount,
       coalesce(p.special_event, 0) AS special_event,
       {_int('coalesce(p.promo_flag, 0) * (isodow(f.date) - 1)', 'promo_dow_interaction')}
FROM future f LEFT JOIN plan p ON p.sku = f.sku AND p.date = f.date""")
def future_promo_join(spark, sf):
    df = panel(spark, sf)
    plan = df.select("sku", F.date_add("date", 30).alias("date"), "promo_flag", "promo_discount", "special_event")
    return frames.future_frame(df, SPEC, 14, plan).select(
        *KEY, "promo_flag", "promo_discount", "special_event", "promo_dow_interaction")


def _models(rows: str) -> str:
    """Point forecasts per (sku, window_no) from ``rows(sku, date, sales, window_no, rn)``."""
    return f"""
fits AS (SELECT sku, window_no, max(date) FILTER (WHERE rn = 1) AS last_, avg(sales) FILTER (WHERE rn BETWEEN 1 AND 28) AS m,
                regr_slope(sales, 1 - rn) FILTER (WHERE rn >= 1) AS b, regr_intercept(sales, 1 - rn) FILTER (WHERE rn >= 1) AS a
         FROM {rows} GROUP BY sku, window_no HAVING count(*) FILTER (WHERE rn >= 1) > 0),
wd AS (SELECT sku, window_no, isodow(date) AS d, avg(sales) AS x, avg(1 - rn) AS t FROM {rows} WHERE rn >= 1 GROUP BY ALL),
pred AS (SELECT f.sku, f.window_no, CAST(g.s AS INTEGER) AS step, last_ + CAST(g.s AS INTEGER) AS date,
                coalesce(n.sales, m) AS seasonal_naive, m AS moving_average, coalesce(a + b * g.s, m) AS drift,
                coalesce(a + b * g.s + wd.x - (a + b * wd.t), a + b * g.s, m) AS trend_weekday
         FROM fits f CROSS JOIN generate_series(1, 14) g(s)
         LEFT JOIN {rows} n ON n.sku = f.sku AND n.window_no = f.window_no AND n.rn = 7 - (g.s - 1) % 7
         LEFT JOIN wd ON wd.sku = f.sku AND wd.window_no = f.window_no AND wd.d = isodow(last_ + CAST(g.s AS INTEGER)))"""


_NOW = f"WITH {_BACK}, now_ AS (SELECT sku, date, sales, 0 AS window_no, rn FROM back_), {_models('now_')}"


@register("baseline_forecasts", f"""{_NOW}
SELECT sku, date, step, {', '.join(f'{R(m)} AS {m}' for m in forecast.MODELS[:3])} FROM pred""")
def baseline_forecasts(spark, sf):
    return forecast.point_forecasts(panel(spark, sf), SPEC, 14).select(*KEY, "step", *[r(m) for m in forecast.MODELS[:3]])


@register("trend_weekday_forecast", f"{_NOW} SELECT sku, date, step, {R('trend_weekday')} AS trend_weekday FROM pred")
def trend_weekday_forecast(spark, sf):
    return forecast.point_forecasts(panel(spark, sf), SPEC, 14).select(*KEY, "step", r("trend_weekday"))


@register("write_forecast", f"{_NOW} SELECT sku, date, {R('moving_average')} AS mean FROM pred")
def write_forecast(spark, sf):
    path = f"{scale.checkpoint_folder(spark)}/forecast-{uuid.uuid4().hex}"
    wide = forecast.point_forecasts(panel(spark, sf), SPEC, 14)
    tables.write_forecast(wide.select(*KEY, F.col("moving_average").alias("mean")), path)
    return spark.read.schema("sku string, date date, mean double").option("header", True).csv(path).withColumn("mean", r("mean"))


_BT = f"""WITH {_BACK}, {_TRAIN},
cut_ AS (SELECT sku, date, sales, w AS window_no, back - 14 * w - 14 AS rn FROM train, (VALUES (0), (1)) v(w) WHERE back - 14 * w - 14 > -14),
{_models('cut_')},
tested AS (SELECT p.sku, p.window_no, c.date, p.step, c.sales AS actual, seasonal_naive, moving_average, drift, trend_weekday
           FROM pred p JOIN cut_ c ON c.sku = p.sku AND c.window_no = p.window_no AND c.rn = 1 - p.step),
long_ AS (UNPIVOT tested ON {', '.join(forecast.MODELS)} INTO NAME model VALUE mean),
board AS (SELECT model, -avg(abs(mean - actual)) AS score_val FROM long_ GROUP BY model),
weights AS (SELECT model, (1 / -score_val) / sum(1 / -score_val) OVER () AS weight FROM board),
blend AS (SELECT t.sku, t.window_no, t.step, t.date, any_value(t.actual) AS actual, sum(weight * mean) / sum(weight) AS mean
          FROM long_ t JOIN weights w ON w.model = t.model GROUP BY ALL)"""


def _tested(spark, sf):
    train, _ = frames.train_test_split(panel(spark, sf).select(*KEY, "sales"), SPEC, 14)
    return forecast.backtest(train, SPEC, OPTS)


@register("backtest", f"""{_BT} SELECT sku, CAST(window_no AS INTEGER) AS window_no, date, step, actual,
       {', '.join(f'{R(m)} AS {m}' for m in forecast.MODELS)} FROM tested""")
def backtest(spark, sf):
    return _tested(spark, sf).select("sku", "window_no", "date", "step", "actual", *[r(m) for m in forecast.MODELS])


@register("leaderboard", f"{_BT} SELECT model, {R('score_val')} AS score_val FROM board")
def leaderboard(spark, sf):
    return forecast.leaderboard(_tested(spark, sf)).select("model", r("score_val"))


def _board(metric: str, error: str) -> None:
    @register(f"leaderboard_{metric}", f"{_BT} SELECT model, {R(f'-({error})')} AS score_val FROM long_ GROUP BY model")
    def board(spark, sf):
        return forecast.leaderboard(_tested(spark, sf), opts=replace(OPTS, eval_metric=metric)).select("model", r("score_val"))


_board("rmse", "sqrt(avg(pow(mean - actual, 2)))")
_board("wape", "sum(abs(mean - actual)) / sum(abs(actual)) FILTER (WHERE mean IS NOT NULL)")
_board("cost", "avg(greatest(1.5 * (mean - actual), 1.0 * (actual - mean)))")


_ROUNDS = 6


def _selection() -> str:
    """The rounds of the greedy selection: ``m`` the chosen model's place, ``e`` the error, ``c`` how often each was chosen."""
    models = forecast.MODELS
    steps = [f"use_ AS (SELECT *, [{', '.join(models)}] AS f FROM tested WHERE actual IS NOT NULL AND {' AND '.join(f'{m} IS NOT NULL' for m in models)})",
             f"pick_0 AS (SELECT 0 AS m, NULL::DOUBLE AS e, [{', '.join('0' for _ in models)}] AS c)"]
    for k in range(1, _ROUNDS + 1):
        steps.append(f"""try_{k} AS (SELECT g.m, avg(abs((list_sum(list_transform(list_zip(f, c), lambda z: z[1] * z[2])) + f[g.m]) / {k} - actual)) AS e
                         FROM use_, (SELECT c FROM pick_{k - 1}), range(1, {len(models) + 1}) g(m) GROUP BY g.m)""")
        steps.append(f"""pick_{k} AS (SELECT t.m, t.e, list_transform(c, lambda n, i: n + CAST(i = t.m AS INTEGER)) AS c
                         FROM try_{k} t, (SELECT c FROM pick_{k - 1}) ORDER BY t.e, t.m LIMIT 1)""")
    return ", ".join(steps)


_NAMED = "[" + ", ".join(f"'{m}'" for m in forecast.MODELS) + "]"


@register("ensemble_selection", f"{_BT}, {_selection()} " + " UNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS round, {_NAMED}[m] AS model, {R('e')} AS error FROM pick_{k}" for k in range(1, _ROUNDS + 1)))
def ensemble_selection(spark, sf):
    """The model that each round of the greedy ensemble adds, and the error with it."""
    chosen = forecast.select_ensemble(scale.written(_tested(spark, sf)), rounds=_ROUNDS)
    rows = [(k + 1, m, e) for k, (m, e) in enumerate(chosen)]
    return spark.createDataFrame(rows, "round int, model string, error double").select("round", "model", r("error"))


@register("ensemble_weights", f"{_BT} SELECT model, {R('weight')} AS weight FROM weights")
def ensemble_weights(spark, sf):
    return forecast.ensemble_weights(forecast.leaderboard(_tested(spark, sf))).select("model", r("weight"))


@register("ensemble_backtest", f"""{_BT} SELECT sku, CAST(window_no AS INTEGER) AS window_no, date, step, {R('mean')} AS ensemble FROM blend""")
def ensemble_backtest(spark, sf):
    tested = scale.written(_tested(spark, sf))
    weights = forecast.ensemble_weights(forecast.leaderboard(tested))
    return forecast.combine(tested, weights).select("sku", "window_no", "date", "step", r("ensemble"))


_QUANT = ", ".join(f"{R(f'quantile_cont(actual - mean, {q})')} AS {n}" for q, n in zip(Q, QNAMES))


@register("residual_quantiles", f"{_BT} SELECT model, step, {_QUANT} FROM long_ GROUP BY model, step")
def residual_quantiles(spark, sf):
    return forecast.residual_quantiles(scale.written(_tested(spark, sf)), forecast.MODELS, Q).select("model", "step", *[r(n) for n in QNAMES])


_OFFSETS = ", ".join(f"quantile_cont(actual - mean, {q}) AS o{i}" for i, q in enumerate(Q))


@register("quantile_forecasts", f"""{_BT},
offsets AS (SELECT model, step, {_OFFSETS} FROM long_ GROUP BY model, step)
SELECT l.sku, CAST(l.window_no AS INTEGER) AS window_no, l.step, l.model,
       {', '.join(f'{R(f"mean + o{i}")} AS {n}' for i, n in enumerate(QNAMES))}
FROM long_ l JOIN offsets o ON o.model = l.model AND o.step = l.step""")
def quantile_forecasts(spark, sf):
    tested = scale.written(_tested(spark, sf))
    offsets = forecast.residual_quantiles(tested, forecast.MODELS, Q)
    long = forecast.to_long(tested).select("sku", "window_no", "step", "model", "mean")
    return forecast.with_quantiles(long, offsets, Q).select("sku", "window_no", "step", "model", *[r(n) for n in QNAMES])


@register("asymmetric_cost", f"""{_BT}
SELECT model, {R('avg(greatest(1.5 * (mean - actual), 1.0 * (actual - mean)))')} AS mean_cost,
       {R('quantile_cont(actual - mean, 0.4)')} AS best_offset FROM long_ GROUP BY model""")
def asymmetric_cost(spark, sf):
    tested = scale.written(_tested(spark, sf))
    long = forecast.to_long(tested).select("model", (F.col("actual") - F.col("mean")).alias("residual"))
    best = scale.group_quantiles(long, ["model"], "residual", {"best_offset": forecast.optimal_level(OPTS)})
    return forecast.cost_board(tested, opts=OPTS).join(best, "model").select("model", r("mean_cost"), r("best_offset"))


@register("regression_inputs", f"""
WITH seq_ AS (SELECT sku, date, sales, promo_flag, promo_discount, row_number() OVER (PARTITION BY sku ORDER BY date) AS rn, count(*) OVER (PARTITION BY sku) AS n FROM panel),
fut AS (SELECT DISTINCT sku, n, max(date) OVER (PARTITION BY sku) AS last FROM seq_),
ahead AS (SELECT sku, n, last + CAST(s AS INTEGER) AS date, CAST(s AS INTEGER) AS step FROM fut, generate_series(1, 14) g(s))
SELECT a.sku, a.date, a.step,
  max(sales) FILTER (WHERE rn = a.n + a.step - 14) AS back_14, max(sales) FILTER (WHERE rn = a.n + a.step - 21) AS back_21,
  max(sales) FILTER (WHERE rn = a.n + a.step - 28) AS back_28,
  {R('avg(sales) FILTER (WHERE rn BETWEEN a.n + a.step - 20 AND a.n + a.step - 14)')} AS mean_7,
  {R('avg(sales) FILTER (WHERE rn BETWEEN a.n + a.step - 41 AND a.n + a.step - 14)')} AS mean_28
FROM ahead a JOIN seq_ s ON s.sku = a.sku GROUP BY a.sku, a.n, a.date, a.step""")
def regression_inputs(spark, sf):
    rows, _ = regression.lagged_inputs(regression.future_rows(panel(spark, sf), SPEC, 14), SPEC, 14)
    return rows.where("step IS NOT NULL").select("sku", "date", "step", "back_14", "back_21", "back_28", r("mean_7"), r("mean_28"))
