"""Per-series window and recent-state features, on a panel with missing targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog.base import R, SPEC, dense, gappy, panel, r, register
from panelwright.functions.numeric import in_order, with_growth
from panelwright.operators import recent, windows

KEY = ["sku", "date"]


def _rounded(df, *names):
    return df.select(*KEY, *[r(n) for n in names])


def _sql_rounded(*names):
    return ", ".join(f"{R(n)} AS {n}" for n in names)


@register("pct_change", f"""
WITH f AS (SELECT sku, date, last_value(sales IGNORE NULLS) OVER (PARTITION BY sku ORDER BY date ROWS UNBOUNDED PRECEDING) AS f FROM gappy),
g AS (SELECT *, lag(f, 7) OVER (PARTITION BY sku ORDER BY date) AS l FROM f)
SELECT sku, date, {R('f / l - 1')} AS growth FROM g""")
def pct_change(spark, sf):
    return _rounded(with_growth(gappy(spark, sf), "sales", {"growth": 7}, in_order(SPEC)), "growth")


@register("lags", "SELECT sku, date, " + ", ".join(
    f"lag(sales, {k}) OVER (PARTITION BY sku ORDER BY date) AS sales_lag_{k}" for k in (1, 7, 14, 30)) + " FROM gappy")
def lags(spark, sf):
    return windows.lags(gappy(spark, sf).select(*KEY, "sales"), SPEC).drop("sales")


_FN = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def _roll_sql(fns):
    return "SELECT sku, date, " + ", ".join(
        R(f"{_FN[fn]}(sales) OVER (PARTITION BY sku ORDER BY date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)")
        + f" AS sales_rolling_{fn}_{k}" for k in (7, 14, 30) for fn in fns) + " FROM gappy"


@register("rolling_mean_min_max", _roll_sql(("mean", "min", "max")))
def rolling_mean_min_max(spark, sf):
    df = windows.rolling(gappy(spark, sf), SPEC)
    return _rounded(df, *[c for c in df.columns if "_rolling_" in c and "_std_" not in c])


@register("rolling_std", _roll_sql(("std",)))
def rolling_std(spark, sf):
    df = windows.rolling(gappy(spark, sf), SPEC)
    return _rounded(df, *[c for c in df.columns if "_rolling_std_" in c])


def _ewm_cte(span: int) -> str:
    a = 2.0 / (span + 1)
    return f"""
walk{span} AS (
  SELECT sku, p, sales AS y, CAST(1.0 AS DOUBLE) AS w FROM rows_ WHERE p = 1
  UNION ALL
  SELECT n.sku, n.p,
         CASE WHEN n.sales IS NULL THEN k.y WHEN k.y IS NULL THEN n.sales
              ELSE (k.w * {1 - a!r} * k.y + {a!r} * n.sales) / (k.w * {1 - a!r} + {a!r}) END,
         CASE WHEN n.sales IS NULL THEN CASE WHEN k.y IS NULL THEN 1.0 ELSE k.w * {1 - a!r} END ELSE 1.0 END
  FROM walk{span} k JOIN rows_ n ON n.sku = k.sku AND n.p = k.p + 1)"""


@register("ewm", f"""
WITH RECURSIVE rows_ AS MATERIALIZED (SELECT sku, date, sales, row_number() OVER (PARTITION BY sku ORDER BY date) AS p FROM gappy),
{_ewm_cte(7)}, {_ewm_cte(14)}
SELECT r.sku, r.date, {R('a.y')} AS sales_ewm_7, {R('b.y')} AS sales_ewm_14
FROM rows_ r JOIN walk7 a ON a.sku = r.sku AND a.p = r.p JOIN walk14 b ON b.sku = r.sku AND b.p = r.p""")
def ewm(spark, sf):
    return _rounded(windows.ewm(gappy(spark, sf), SPEC), "sales_ewm_7", "sales_ewm_14")


_GRADIENT = """
o AS (SELECT sku, date, sales, row_number() OVER w AS p, count(*) OVER (PARTITION BY sku) AS n,
             lag(sales) OVER w AS b, lead(sales) OVER w AS a FROM gappy WINDOW w AS (PARTITION BY sku ORDER BY date)),
g AS (SELECT *, coalesce(CASE WHEN p = 1 THEN a - sales WHEN p = n THEN sales - b ELSE (a - b) / 2 END, 0) AS v FROM o)"""
_VELOCITY = f"""{_GRADIENT},
vel AS (SELECT sku, date, p, n, """ + ", ".join(
    f"CASE WHEN n < 28 THEN 0.0 ELSE sum(v) OVER (PARTITION BY sku ORDER BY p ROWS BETWEEN {-lo} PRECEDING AND {hi} FOLLOWING) / {k} END AS v{k}"
    for k, (lo, hi) in windows.VELOCITY_FRAMES.items()) + " FROM g)"


@register("gradient_velocity", f"WITH {_VELOCITY} SELECT sku, date, " + ", ".join(
    f"{R(f'v{k}')} AS sales_velocity_{k}d" for k in windows.VELOCITY_FRAMES) + " FROM vel")
def gradient_velocity(spark, sf):
    return _rounded(windows.trend(gappy(spark, sf), SPEC), *[f"sales_velocity_{k}d" for k in windows.VELOCITY_FRAMES])


@register("acceleration", f"""WITH {_VELOCITY} SELECT sku, date, """ + ", ".join(
    R(f"CASE WHEN n < 28 THEN 0.0 WHEN p = 1 THEN lead(v{k}) OVER w - v{k} WHEN p = n THEN v{k} - lag(v{k}) OVER w "
      f"ELSE (lead(v{k}) OVER w - lag(v{k}) OVER w) / 2 END") + f" AS sales_acceleration_{k}d"
    for k in windows.VELOCITY_FRAMES) + " FROM vel WINDOW w AS (PARTITION BY sku ORDER BY p)")
def acceleration(spark, sf):
    return _rounded(windows.trend(gappy(spark, sf), SPEC), *[f"sales_acceleration_{k}d" for k in windows.VELOCITY_FRAMES])


def _trend_sql(base):
    return f"""
WITH o AS (SELECT sku, date, sales, row_number() OVER (PARTITION BY sku ORDER BY date) AS p FROM {base}),
t AS (SELECT sku, CASE WHEN count(*) < 28 OR count(sales) < count(*) OR stddev_pop(sales) <= 1e-6 THEN 0.0
             ELSE least(1.0, pow(covar_pop(sales, p), 2) / (var_pop(sales) * var_pop(p))) END AS s FROM o GROUP BY sku)
SELECT o.sku, o.date, {R('s')} AS trend_strength FROM o JOIN t ON t.sku = o.sku"""


@register("trend_strength", _trend_sql("panel"))
def trend_strength(spark, sf):
    return _rounded(windows.trend(panel(spark, sf), SPEC), "trend_strength")


@register("trend_strength_with_gaps", _trend_sql("gappy"))
def trend_strength_with_gaps(spark, sf):
    return _rounded(windows.trend(gappy(spark, sf), SPEC), "trend_strength")


@register("change_point_score", f"""
WITH v AS (SELECT sku, date, count(*) OVER (PARTITION BY sku) AS n,
                  CASE WHEN count(sales) OVER w = 7 THEN var_samp(sales) OVER w END AS v
           FROM gappy WINDOW w AS (PARTITION BY sku ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY sku ORDER BY date ROWS UNBOUNDED PRECEDING) AS f FROM v),
c AS (SELECT *, lag(f, 7) OVER (PARTITION BY sku ORDER BY date) AS l FROM f)
SELECT sku, date, {R('''CASE WHEN n < 21 OR f IS NULL OR l IS NULL THEN 0.0
  WHEN l = 0 THEN CASE WHEN f = 0 THEN 0.0 ELSE 1e9 END ELSE f / l - 1 END''', 4)} AS change_point_score FROM c""")
def change_point_score(spark, sf):
    df = windows.change_points(gappy(spark, sf), SPEC)
    finite = F.when(F.col("change_point_score") == float("inf"), 1e9).otherwise(F.col("change_point_score"))
    return df.select(*KEY, r(finite, "change_point_score", 4))


def _season_cte(name, part):
    return f"""{name} AS (SELECT sku, var_pop(m) AS v FROM (SELECT sku, avg(sales) AS m FROM gappy GROUP BY sku, {part}) GROUP BY sku)"""


@register("seasonality", f"""
WITH {_season_cte('wk', 'isodow(date)')}, {_season_cte('mo', 'day(date)')},
s AS (SELECT sku, count(*) AS n, avg(sales) AS m FROM gappy GROUP BY sku)
SELECT g.sku, g.date, {R('CASE WHEN n < 28 OR m <= 0 THEN 0.0 ELSE wk.v / (m + 1e-6) END')} AS weekly_seasonality,
       {R('CASE WHEN n < 28 OR m <= 0 THEN 0.0 ELSE mo.v / (m + 1e-6) END')} AS monthly_seasonality
FROM gappy g JOIN s ON s.sku = g.sku JOIN wk ON wk.sku = g.sku JOIN mo ON mo.sku = g.sku""")
def seasonality(spark, sf):
    return _rounded(windows.seasonality(gappy(spark, sf), SPEC), "weekly_seasonality", "monthly_seasonality")


@register("promo_frequency", f"""
SELECT sku, date, {R('avg(promo_flag) OVER (PARTITION BY sku ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)')} AS promo_frequency_30d FROM panel""")
def promo_frequency(spark, sf):
    return _rounded(windows.promo_frequency(panel(spark, sf), SPEC), "promo_frequency_30d")


@register("promo_effectiveness", f"""
WITH s AS (SELECT sku, count(*) FILTER (WHERE promo_flag = 0) AS n0, count(*) FILTER (WHERE promo_flag = 1) AS n1,
                  avg(sales) FILTER (WHERE promo_flag = 0) AS m0, avg(sales) FILTER (WHERE promo_flag = 1) AS m1 FROM gappy GROUP BY sku)
SELECT g.sku, g.date, {R('CASE WHEN n0 > 5 AND n1 > 5 AND m0 > 1e-6 THEN least(10.0, greatest(-10.0, (m1 - m0) / m0)) ELSE 0.0 END')}
       AS historical_promo_effectiveness FROM gappy g JOIN s ON s.sku = g.sku""")
def promo_effectiveness(spark, sf):
    return _rounded(windows.promo_effect(gappy(spark, sf), SPEC), "historical_promo_effectiveness")


@register("days_since_promo", """
WITH o AS (SELECT sku, date, promo_flag, row_number() OVER (PARTITION BY sku ORDER BY date) AS p FROM panel)
SELECT sku, date, CAST(coalesce(p - max(CASE WHEN promo_flag = 1 THEN p END) OVER (
  PARTITION BY sku ORDER BY p ROWS UNBOUNDED PRECEDING), 999) AS INTEGER) AS days_since_last_promo FROM o""")
def days_since_promo(spark, sf):
    return windows.days_since_promo(panel(spark, sf), SPEC).select(*KEY, "days_since_last_promo")


@register("discount_ratio", f"""
WITH m AS (SELECT sku, date, promo_discount AS x, avg(promo_discount) OVER (
             PARTITION BY sku ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS m FROM dense)
SELECT sku, date, {R('least(10.0, greatest(0.1, coalesce(CASE WHEN m IS NULL THEN NULL ELSE x / greatest(m, 1e-6) END, 1.0)))')}
       AS discount_vs_historical_avg FROM m""")
def discount_ratio(spark, sf):
    return _rounded(windows.discount_depth(dense(spark, sf), SPEC), "discount_vs_historical_avg")


@register("deep_discount_flag", """
SELECT sku, date, CAST(promo_flag = 1 AND promo_discount >= quantile_cont(promo_discount, 0.75) OVER (PARTITION BY sku)
       AS INTEGER) AS is_deep_discount FROM panel""")
def deep_discount_flag(spark, sf):
    return windows.discount_depth(panel(spark, sf), SPEC).select(*KEY, "is_deep_discount")


_TAIL = """
o AS (SELECT sku, date, sales, row_number() OVER (PARTITION BY sku ORDER BY date DESC) AS rn,
             count(*) OVER (PARTITION BY sku) AS n, sales < lag(sales) OVER (PARTITION BY sku ORDER BY date) AS falling FROM gappy)"""


@register("decline_indicator", f"""
WITH {_TAIL}, s AS (SELECT sku, max(n) AS n, regr_slope(sales, -rn) FILTER (WHERE rn <= 7) AS b,
    stddev_pop(sales) FILTER (WHERE rn <= 7) AS sd, count(sales) FILTER (WHERE rn <= 7) AS c FROM o GROUP BY sku)
SELECT o.sku, o.date, CAST(coalesce(s.n >= 14 AND c = 7 AND sd > 1e-6 AND b < -0.1, false) AS INTEGER) AS sales_decline_indicator
FROM o JOIN s ON s.sku = o.sku""")
def decline_indicator(spark, sf):
    return recent.decline(gappy(spark, sf), SPEC).select(*KEY, "sales_decline_indicator")


@register("consecutive_decline", f"""
WITH {_TAIL}, s AS (SELECT sku, max(n) AS n, coalesce(min(rn) FILTER (WHERE rn <= 13 AND NOT coalesce(falling, false)) - 1, 13) AS streak
                    FROM o GROUP BY sku)
SELECT o.sku, o.date, CAST(CASE WHEN s.n >= 14 THEN streak ELSE 0 END AS INTEGER) AS consecutive_decline_days
FROM o JOIN s ON s.sku = o.sku""")
def consecutive_decline(spark, sf):
    return recent.decline(gappy(spark, sf), SPEC).select(*KEY, "consecutive_decline_days")


@register("decline_magnitude", f"""
WITH {_TAIL}, s AS (SELECT sku, max(n) AS n, max(sales) FILTER (WHERE rn <= 30) AS peak, max(sales) FILTER (WHERE rn = 1) AS now_,
    count(*) FILTER (WHERE rn <= 30 AND sales IS NULL) AS gone FROM o GROUP BY sku)
SELECT o.sku, o.date, {R('CASE WHEN s.n >= 14 AND gone = 0 THEN least(1.0, greatest(0.0, (peak - now_) / (peak + 1e-6))) ELSE 0.0 END')}
       AS decline_magnitude FROM o JOIN s ON s.sku = o.sku""")
def decline_magnitude(spark, sf):
    return _rounded(recent.decline(gappy(spark, sf), SPEC), "decline_magnitude")


_CV = " + ".join(f"stddev_pop(sales) FILTER (WHERE rn <= {k}) / (avg(sales) FILTER (WHERE rn <= {k}) + 1e-6)" for k in (7, 14, 21))


@register("volatility_risk", f"""
WITH {_TAIL}, s AS (SELECT sku, max(n) AS n, ({_CV}) / 3 AS cv, count(sales) FILTER (WHERE rn <= 21) AS c FROM o GROUP BY sku)
SELECT o.sku, o.date, {R('CASE WHEN s.n < 21 THEN 0.0 WHEN c = 21 THEN least(5.0, greatest(0.0, cv)) END')} AS volatility_risk_score
FROM o JOIN s ON s.sku = o.sku""")
def volatility_risk(spark, sf):
    return _rounded(recent.volatility(gappy(spark, sf), SPEC), "volatility_risk_score")
