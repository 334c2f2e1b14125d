"""The regression over all series: its sums, coefficients, forecasts and importances, with the normal equations in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelwright import scale
from panelwright.catalog.base import R, SPEC, panel, r, register
from panelwright.catalog.calendars import HOLIDAYS_SQL, PI2
from panelwright.functions.calendar import FOURIER_PERIODS
from panelwright.operators import regression

HORIZON = 14
_LAGS = {"back_14": "b14", "back_21": "b21", "back_28": "b28", "mean_7": "m7", "mean_28": "m28"}
_DOW, _END = "(isodow(date) - 1)", "CAST(isodow(date) >= 6 AS INTEGER)"

# input of the regression: its SQL over the rows of raw_, one_ (the overall mean) and the levels
INPUTS = {n: f"coalesce({c}, lvl, overall)" for n, c in _LAGS.items()}
INPUTS |= {f"{n}_missing": f"CAST({c} IS NULL AS INTEGER)" for n, c in _LAGS.items()}
INPUTS |= {"day_of_week": _DOW, "day_of_month": "day(date)", "month": "month(date)", "quarter": "quarter(date)", "week_of_year": "week(date)",
           "year": "year(date)", "day_of_year": "dayofyear(date)", "is_weekend": _END, "is_month_start": "CAST(day(date) <= 5 AS INTEGER)",
           "is_month_end": "CAST(day(date) >= 25 AS INTEGER)", "day_of_week_sin": f"sin({PI2} * {_DOW} / 7)", "day_of_week_cos": f"cos({PI2} * {_DOW} / 7)",
           "month_sin": f"sin({PI2} * month(date) / 12)", "month_cos": f"cos({PI2} * month(date) / 12)",
           "is_holiday": "CAST(date IN (SELECT day FROM holidays) AS INTEGER)", "weekend_month_interaction": f"{_END} * month(date)",
           "holiday_weekend_interaction": f"CAST(date IN (SELECT day FROM holidays) AS INTEGER) * {_END}", "promo_flag": "promo_flag",
           "promo_discount": "promo_discount", "special_event": "special_event", "promo_dow_interaction": f"promo_flag * {_DOW}",
           "promo_weekend_interaction": f"promo_flag * {_END}"}
INPUTS |= {f"day_of_year_{fn}_{n}": f"{fn}({PI2} * dayofyear(date) / {p})" for n, p in FOURIER_PERIODS.items() for fn in ("sin", "cos")}
INPUTS |= {f"{c}_level": f"coalesce({c}_level, overall)" for c in SPEC.static}
NAMES = list(INPUTS)
_P = len(NAMES)


def _levels(rows: str) -> str:
    return ",\n".join(f"level_{c} AS (SELECT {c}, (sum(sales) + {regression.PRIOR_ROWS} * any_value(overall)) / (count(*) + {regression.PRIOR_ROWS}) AS {c}_level "
                      f"FROM {rows}, one_ WHERE sales IS NOT NULL AND {c} IS NOT NULL GROUP BY {c})" for c in SPEC.static)


_JOINS = " ".join(f"LEFT JOIN level_{c} USING ({c})" for c in SPEC.static)


def fitted(used: str) -> str:
    """CTEs ``ready_`` (all rows and the future ones, with inputs ``x``) and ``model_`` (``b`` by position, ``a``), fitted where ``used``."""
    return f"""{HOLIDAYS_SQL},
last_ AS (SELECT sku, max(date) AS l, any_value(category) AS category, any_value(subcategory) AS subcategory, any_value(brand) AS brand, any_value(product_group) AS product_group
          FROM panel GROUP BY sku),
ext_ AS (SELECT sku, date, sales, promo_flag, promo_discount, special_event, category, subcategory, brand, product_group, CAST(NULL AS INTEGER) AS step,
                row_number() OVER (PARTITION BY sku ORDER BY date DESC) AS back FROM panel
         UNION ALL SELECT sku, l + CAST(s AS INTEGER), NULL, 0, 0.0, 0, category, subcategory, brand, product_group, CAST(s AS INTEGER), NULL FROM last_, generate_series(1, {HORIZON}) g(s)),
one_ AS (SELECT coalesce(avg(sales), 0) AS overall FROM ext_ WHERE {used}),
{_levels(f'(SELECT * FROM ext_ WHERE {used})')},
raw_ AS (SELECT *, lag(sales, 14) OVER w AS b14, lag(sales, 21) OVER w AS b21, lag(sales, 28) OVER w AS b28,
                avg(sales) OVER (PARTITION BY sku ORDER BY date ROWS BETWEEN 20 PRECEDING AND 14 PRECEDING) AS m7,
                avg(sales) OVER (PARTITION BY sku ORDER BY date ROWS BETWEEN 41 PRECEDING AND 14 PRECEDING) AS m28,
                avg(sales) OVER (PARTITION BY sku ORDER BY date ROWS BETWEEN 56 PRECEDING AND 14 PRECEDING) AS lvl
         FROM ext_ WINDOW w AS (PARTITION BY sku ORDER BY date)),
ready_ AS (SELECT raw_.*, [{', '.join(f'CAST({e} AS DOUBLE)' for e in INPUTS.values())}] AS x FROM raw_ {_JOINS}, one_),
whole_ AS (SELECT list_prepend(1.0::DOUBLE, list_append(x, sales)) AS v FROM ready_ WHERE sales IS NOT NULL AND {used}),
sums_ AS (SELECT i, j, sum(v[i] * v[j]) AS s FROM whole_, range(1, {_P + 3}) a(i), range(1, {_P + 3}) b(j) WHERE i <= j GROUP BY i, j),
square_ AS (SELECT i, j, s FROM sums_ UNION ALL SELECT j, i, s FROM sums_ WHERE i < j),
about_ AS (SELECT d.i, m.s / n.s AS mean, d.s / n.s - (m.s / n.s) ** 2 AS var, d.s / n.s AS sq FROM square_ d JOIN square_ m ON m.i = 1 AND m.j = d.i, (SELECT s FROM square_ WHERE i = 1 AND j = 1) n
           WHERE d.i = d.j AND d.i > 1),
cell_ AS (SELECT q.i, q.j, CASE WHEN a.var > 1e-9 * a.sq AND (b.var > 1e-9 * b.sq OR q.j = {_P + 2})
                 THEN (q.s / n.s - a.mean * b.mean) / sqrt(a.var) / CASE WHEN q.j = {_P + 2} THEN 1 ELSE sqrt(b.var) END ELSE 0 END + CASE WHEN q.i = q.j THEN CASE WHEN a.var > 1e-9 * a.sq THEN {regression.PENALTY} ELSE 1 END ELSE 0 END AS c
          FROM square_ q JOIN about_ a ON a.i = q.i JOIN about_ b ON b.i = q.j, (SELECT s FROM square_ WHERE i = 1 AND j = 1) n WHERE q.i BETWEEN 2 AND {_P + 1} AND q.j > 1),
matrix_ AS (SELECT list(line ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS line FROM cell_ GROUP BY i)),
gauss_(k, m) AS (
  SELECT 1, m FROM matrix_ UNION ALL
  SELECT k + 1, list_transform(m, lambda line, i: CASE WHEN i = k THEN list_transform(line, lambda c: c / m[k][k])
                                                     ELSE list_transform(line, lambda c, j: c - line[k] / m[k][k] * m[k][j]) END) FROM gauss_ WHERE k <= {_P}),
slopes_ AS (SELECT g.i, CASE WHEN a.var > 1e-9 * a.sq THEN m[g.i][{_P + 1}] / sqrt(a.var) ELSE 0 END AS b, a.mean FROM gauss_, range(1, {_P + 1}) g(i) JOIN about_ a ON a.i = g.i + 1 WHERE k = {_P + 1}),
model_ AS (SELECT list(b ORDER BY i) AS b, (SELECT mean FROM about_ WHERE i = {_P + 2}) - sum(b * mean) AS a FROM slopes_)"""


_VALUE = "a + list_sum(list_transform(list_zip(x, b), lambda z: z[1] * z[2]))"
_ALL = fitted("back IS NOT NULL")
_FORECAST = f"WITH RECURSIVE {_ALL} SELECT sku, date, step, {R(_VALUE, 4)} AS mean FROM ready_, model_ WHERE step IS NOT NULL"


@register("global_linear_regression", _FORECAST)
def global_linear_regression(spark, sf):
    """Forecast of every series by the regression over all of them."""
    df = scale.written(panel(spark, sf))
    return regression.predict_global(regression.fit_global(df, SPEC, HORIZON), df, SPEC).select("sku", "date", "step", r("mean", digits=4))


@register("regression_coefficients", f"""WITH RECURSIVE {_ALL}
SELECT [{', '.join(f"'{n}'" for n in NAMES)}][i] AS input, {R('b', 4)} AS coefficient FROM slopes_ UNION ALL SELECT 'intercept', {R('a', 4)} FROM model_""")
def regression_coefficients(spark, sf):
    model = regression.fit_global(scale.written(panel(spark, sf)), SPEC, HORIZON)
    found = spark.createDataFrame(list((model.coefficients | {"intercept": model.intercept}).items()), "input string, coefficient double")
    return found.select("input", r("coefficient", digits=4))


def _cut(k: int) -> str:
    used = fitted(f"back > {14 * k + 14}")
    return f"WITH RECURSIVE {used} SELECT sku, CAST({k} AS INTEGER) AS window_no, date, {R(_VALUE, 4)} AS mean FROM ready_, model_ WHERE back BETWEEN {14 * k + 1} AND {14 * k + 14}"


@register("regression_backtest", _cut(1))
def regression_backtest(spark, sf):
    """The earlier of the two cuts, from the same sums as the later one and the final fit."""
    tested = regression.backtest_global(panel(spark, sf), SPEC).where("window_no = 1")
    return tested.select("sku", "window_no", "date", r(regression.NAME, "mean", digits=4))


@register("feature_importance", f"""WITH RECURSIVE {_ALL},
chosen_ AS (SELECT sku, date, sales, x, {_VALUE} AS mean, b, row_number() OVER (ORDER BY md5('7|' || sku || '|' || CAST(date AS VARCHAR)), sku, date) - 1 AS place, count(*) OVER () AS n
            FROM ready_, model_ WHERE back <= {HORIZON}),
dealt_ AS (SELECT c.sales, c.mean, c.b, c.x, o.x AS other FROM chosen_ c JOIN chosen_ o ON (c.place + 1) % c.n = o.place),
grown_ AS (SELECT i, avg(abs(sales - mean - b[i] * (other[i] - x[i])) - abs(sales - mean)) AS importance FROM dealt_, range(1, {_P + 1}) g(i) GROUP BY i)
SELECT [{', '.join(f"'{n}'" for n in NAMES)}][i] AS feature, {R('importance', 4)} AS importance FROM grown_ ORDER BY importance DESC LIMIT 20""")
def feature_importance(spark, sf):
    """By how much the error over the last fortnight grows when an input's values are dealt anew: the 20 inputs that matter most."""
    df = scale.written(panel(spark, sf))
    top = regression.permutation_importance(regression.fit_global(df, SPEC, HORIZON), df, SPEC)
    return top.select("feature", r("importance", digits=4))


@register("saved_model_forecast", _FORECAST)
def saved_model_forecast(spark, sf):
    """Fitted, stored, loaded again, and used."""
    df = scale.written(panel(spark, sf))
    path = f"{scale.checkpoint_folder(spark)}/model-{uuid.uuid4().hex}"
    regression.save_model(regression.fit_global(df, SPEC, HORIZON), path)
    return regression.predict_global(regression.load_model(path), df, SPEC).select("sku", "date", "step", r("mean", digits=4))


@register("tree_importance")
def tree_importance(spark, sf):
    """The same importance for boosted trees, which have no SQL form."""
    df = scale.written(panel(spark, sf))
    top = regression.permutation_importance(regression.fit_global(df, SPEC, HORIZON, "trees"), df, SPEC)
    return top.select("feature", F.col("importance"))
