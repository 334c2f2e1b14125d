"""Cross-series features and cleanup."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright import scale
from panelwright.catalog.base import R, SPEC, dense, gappy, panel, r, register
from panelwright.functions.numeric import in_order
from panelwright.operators import cleanup, cross
from panelwright.plans.features import build_features

KEY = ["sku", "date"]


def _rounded(df, *names):
    return df.select(*KEY, *[r(n) for n in names])


_TOTAL = "sum(sales) OVER (PARTITION BY category, date)"
_CATEGORY = f"""
own AS (SELECT sku, date, category, CASE WHEN sales IS NOT NULL THEN greatest(0.0, {_TOTAL} - sales) END AS rest FROM gappy)"""


@register("category_total", f"WITH {_CATEGORY} SELECT sku, date, rest AS category_total_sales FROM own")
def category_total(spark, sf):
    return cross.category_total(gappy(spark, sf), SPEC).select(*KEY, "category_total_sales")


@register("category_growth", f"""
WITH {_CATEGORY}, f AS (SELECT sku, date, last_value(rest IGNORE NULLS) OVER (PARTITION BY sku ORDER BY date ROWS UNBOUNDED PRECEDING) AS f FROM own),
g AS (SELECT *, lag(f, 7) OVER (PARTITION BY sku ORDER BY date) AS l FROM f)
SELECT sku, date, {R('''CASE WHEN f IS NULL OR l IS NULL THEN 0.0 WHEN l = 0 THEN CASE WHEN f = 0 THEN 0.0 ELSE 10.0 END
  ELSE least(10.0, greatest(-10.0, f / l - 1)) END''')} AS category_growth_rate FROM g""")
def category_growth(spark, sf):
    return _rounded(cross.category_dynamics(cross.category_total(gappy(spark, sf), SPEC), SPEC), "category_growth_rate")


@register("category_volatility", f"""
WITH {_CATEGORY} SELECT sku, date, {R('''least(1e6, coalesce(stddev_samp(rest) OVER (
  PARTITION BY sku ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0.0))''')} AS category_volatility FROM own""")
def category_volatility(spark, sf):
    return _rounded(cross.category_dynamics(cross.category_total(gappy(spark, sf), SPEC), SPEC), "category_volatility")


@register("category_dynamics_positional", f"""
WITH {_CATEGORY}, f AS (SELECT *, last_value(rest IGNORE NULLS) OVER (PARTITION BY category ORDER BY sku, date ROWS UNBOUNDED PRECEDING) AS f FROM own),
g AS (SELECT *, lag(f, 7) OVER (PARTITION BY category ORDER BY sku, date) AS l FROM f)
SELECT sku, date, {R('''CASE WHEN f IS NULL OR l IS NULL THEN 0.0 WHEN l = 0 THEN CASE WHEN f = 0 THEN 0.0 ELSE 10.0 END
  ELSE least(10.0, greatest(-10.0, f / l - 1)) END''')} AS category_growth_rate,
  {R('''least(1e6, coalesce(stddev_samp(rest) OVER (PARTITION BY category ORDER BY sku, date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0.0))''')} AS category_volatility FROM g""")
def category_dynamics_positional(spark, sf):
    """Growth and spread along all rows of a category, as older runs computed them."""
    return _rounded(cross.category_dynamics(cross.category_total(gappy(spark, sf), SPEC), SPEC, compat=True), "category_growth_rate", "category_volatility")


@register("brand_market_share", f"""
SELECT sku, date, {R(f'''coalesce(least(1.0, greatest(0.0, coalesce(sum(sales) OVER (PARTITION BY brand, category, date), 0)
  / greatest(coalesce({_TOTAL}, 0), 1e-6))), 0.0)''')} AS brand_market_share FROM gappy""")
def brand_market_share(spark, sf):
    return _rounded(cross.brand_share(gappy(spark, sf), SPEC), "brand_market_share")


@register("brand_popularity", f"""
SELECT sku, date, {R('''CASE WHEN sales > 0 THEN CAST(count(*) FILTER (WHERE sales > 0) OVER (PARTITION BY brand, date) AS DOUBLE)
  / count(*) OVER (PARTITION BY brand, date) ELSE 0.0 END''')} AS brand_popularity_index FROM gappy""")
def brand_popularity(spark, sf):
    return _rounded(cross.brand_popularity(gappy(spark, sf), SPEC), "brand_popularity_index")


@register("subcategory_competition", """
SELECT sku, date, least(1000, greatest(1, count(*) OVER (PARTITION BY subcategory, date))) AS subcategory_competition FROM gappy""")
def subcategory_competition(spark, sf):
    return cross.subcategory_peers(gappy(spark, sf), SPEC).select(*KEY, "subcategory_competition")


@register("similar_products", f"""
SELECT sku, date, {R('''least(1e6, greatest(0.0, coalesce((sum(sales) OVER (PARTITION BY subcategory, date) - sales)
  / greatest(count(*) OVER (PARTITION BY subcategory, date) - 1, 1), 0.0)))''')} AS similar_products_avg FROM gappy""")
def similar_products(spark, sf):
    return _rounded(cross.subcategory_peers(gappy(spark, sf), SPEC), "similar_products_avg")


_PRICES = "SELECT sku, date, category, CASE WHEN sales IS NOT NULL THEN round(price / 100) END AS price FROM gappy"


def _coarse_prices(spark, sf):
    """Prices in whole hundreds, with gaps, so that ties and missing prices occur."""
    return gappy(spark, sf).withColumn("price", F.when(F.col("sales").isNotNull(), F.round(F.col("price") / 100)))


@register("price_rank", f"""
WITH q AS ({_PRICES})
SELECT sku, date, {R('''CASE WHEN price IS NOT NULL THEN (rank() OVER (PARTITION BY category, date ORDER BY price NULLS LAST)
  + (count(*) OVER (PARTITION BY category, date, price) - 1) / 2.0) / count(price) OVER (PARTITION BY category, date) END''')}
  AS price_rank_in_category FROM q""")
def price_rank(spark, sf):
    return _rounded(cross.price_position(_coarse_prices(spark, sf), SPEC), "price_rank_in_category")


@register("price_vs_median", f"""
WITH q AS ({_PRICES})
SELECT sku, date, {R('''least(100.0, greatest(0.01, coalesce(CASE WHEN price IS NOT NULL THEN
  price / greatest(quantile_cont(price, 0.5) OVER (PARTITION BY category, date), 1e-6) END, 1.0)))''')} AS price_vs_category_median FROM q""")
def price_vs_median(spark, sf):
    return _rounded(cross.price_position(_coarse_prices(spark, sf), SPEC), "price_vs_category_median")


def _growth(n):
    return f"""CASE WHEN lag(t, {n}) OVER w IS NULL THEN 0.0 WHEN lag(t, {n}) OVER w = 0 THEN
      CASE WHEN t = 0 THEN 0.0 ELSE 'inf'::DOUBLE END ELSE t / lag(t, {n}) OVER w - 1 END"""


@register("category_instability", f"""
WITH d AS (SELECT category, date, coalesce(sum(sales), 0) AS t FROM dense GROUP BY category, date),
g AS (SELECT category, {_growth(7)} AS g7, {_growth(30)} AS g30, {_growth(90)} AS g90 FROM d WINDOW w AS (PARTITION BY category ORDER BY date)),
s AS (SELECT category, CASE WHEN max(g7) < 'inf'::DOUBLE AND max(g30) < 'inf'::DOUBLE THEN least(2.0, greatest(0.0,
        stddev_samp(CASE WHEN g7 < 'inf'::DOUBLE THEN g7 END) * 0.4 + stddev_samp(CASE WHEN g30 < 'inf'::DOUBLE THEN g30 END) * 0.3
        + greatest(0.0, -avg(g90)) * 0.3)) END AS i
      FROM g GROUP BY category)
SELECT p.sku, p.date, {R('coalesce(i, 0.5)')} AS category_instability_index FROM dense p LEFT JOIN s ON s.category = p.category""")
def category_instability(spark, sf):
    df = dense(spark, sf)
    return _rounded(scale.attach(df, cross.instability_table(df, SPEC), ["category"]), "category_instability_index")


@register("category_instability_observed_days", f"""
WITH d AS (SELECT category, date, coalesce(sum(sales), 0) + 1 AS t FROM panel GROUP BY category, date),
g AS (SELECT category, {_growth(7)} AS g7, {_growth(30)} AS g30, {_growth(90)} AS g90 FROM d WINDOW w AS (PARTITION BY category ORDER BY date))
SELECT category, {R('least(2.0, greatest(0.0, stddev_samp(g7) * 0.4 + stddev_samp(g30) * 0.3 + greatest(0.0, -avg(g90)) * 0.3))')}
  AS category_instability_index FROM g GROUP BY category""")
def category_instability_observed_days(spark, sf):
    """One unit added per category and day, so that growth stays finite."""
    first = panel(spark, sf).groupBy("category", "date").agg((F.sum("sales") + 1).alias("sales"))
    return cross.instability_table(first, SPEC).select("category", r("category_instability_index"))


@register("market_fragmentation", f"""
WITH d AS (SELECT subcategory, date, least(3.0, greatest(0.0, coalesce(
             CASE WHEN count(sales) > 0 THEN stddev_samp(sales) / (sum(sales) / count(sales) + 1e-6) END, 0.0))) AS f
           FROM gappy GROUP BY subcategory, date)
SELECT subcategory, {R('avg(f)')} AS market_fragmentation_score FROM d GROUP BY subcategory""")
def market_fragmentation(spark, sf):
    return cross.fragmentation_table(gappy(spark, sf), SPEC).select("subcategory", r("market_fragmentation_score"))


@register("portfolio_concentration", f"""
WITH d AS (SELECT category, date, CASE WHEN coalesce(sum(sales), 0) <= 0 THEN 0.5
             ELSE least(1.0, sum(sales * sales) / pow(sum(sales), 2)) END AS h FROM dense GROUP BY category, date)
SELECT category, {R('avg(h)')} AS portfolio_concentration_risk FROM d GROUP BY category""")
def portfolio_concentration(spark, sf):
    return cross.concentration_table(dense(spark, sf), SPEC).select("category", r("portfolio_concentration_risk"))


@register("market_headwind", """
WITH d AS (SELECT date, coalesce(sum(sales), 0) AS t FROM gappy GROUP BY date),
g AS (SELECT date, t, lag(t, 7) OVER (ORDER BY date) AS l FROM d)
SELECT p.sku, p.date, CAST(coalesce(CASE WHEN l > 0 THEN t / l - 1 < -0.02 END, false) AS INTEGER) AS market_headwind
FROM gappy p JOIN g ON g.date = p.date""")
def market_headwind(spark, sf):
    return cross.market_state(gappy(spark, sf), SPEC).select(*KEY, "market_headwind")


_CLEAN_INPUT = """
raw_ AS (SELECT sku, date, sales, promo_flag, special_event AS is_event, price,
                CASE WHEN sales IS NOT NULL THEN price / 1000 END AS price_rank,
                CASE WHEN lag(sales) OVER w IS NOT NULL THEN sales / nullif(lag(sales) OVER w, 0) - 1 END * 20 AS sales_growth,
                price * 1000 AS big FROM dense WINDOW w AS (PARTITION BY sku ORDER BY date))"""


@register("cleanup", f"""
WITH {_CLEAN_INPUT}, m AS (SELECT quantile_cont(sales, 0.5) AS s, quantile_cont(price, 0.5) AS p, quantile_cont(big, 0.5) AS b FROM raw_)
SELECT sku, date, {R('coalesce(sales, s)')} AS sales, coalesce(promo_flag, 0) AS promo_flag, coalesce(is_event, 0) AS is_event,
       {R('coalesce(price, p)')} AS price, {R('least(1.0, greatest(0.0, coalesce(price_rank, 0.0)))')} AS price_rank,
       {R('least(10.0, greatest(-10.0, coalesce(sales_growth, 0.0)))')} AS sales_growth, {R('least(1e6, coalesce(big, b))')} AS big
FROM raw_, m""")
def clean_columns(spark, sf):
    df = dense(spark, sf)
    before = F.lag("sales").over(in_order(SPEC))
    df = df.select(*KEY, "sales", "promo_flag", F.col("special_event").alias("is_event"), "price",
                   F.when(F.col("sales").isNotNull(), F.col("price") / 1000).alias("price_rank"),
                   (F.try_divide(F.col("sales"), before) * 20 - 20).alias("sales_growth"), (F.col("price") * 1000).alias("big"))
    df = scale.written(df)
    out = cleanup.apply(df, SPEC, cleanup.fit(df, SPEC))
    return out.select(*KEY, "promo_flag", "is_event", *[r(c) for c in ("sales", "price", "price_rank", "sales_growth", "big")])


@register("cleanup_leftovers", """
WITH f AS (SELECT sales, price, promo_flag, promo_discount, special_event, lag(sales, 3) OVER (PARTITION BY sku ORDER BY date) AS back,
                  CASE WHEN sales = 1 THEN CAST('inf' AS DOUBLE) ELSE sales END AS ratio FROM dense)
SELECT 'before' AS stage, count(*) FILTER (isinf(ratio)) AS infinite_values,
       CAST(count(*) * 7 - count(sales) - count(price) - count(promo_flag) - count(promo_discount) - count(special_event) - count(back) - count(ratio) AS BIGINT) AS missing_values FROM f
UNION ALL SELECT 'after', 0, 0""")
def cleanup_leftovers(spark, sf):
    """Missing and infinite values of numeric columns before and after cleanup."""
    df = dense(spark, sf).withColumns({
        "back": F.lag("sales", 3).over(in_order(SPEC)),
        "ratio": F.when(F.col("sales") == 1, F.lit(float("inf"))).otherwise(F.col("sales"))})
    df = scale.written(df)
    cleaned = cleanup.apply(df, SPEC, cleanup.fit(df, SPEC))
    return cleanup.leftovers(df, SPEC).select(F.lit("before").alias("stage"), "*").unionAll(
        cleanup.leftovers(cleaned, SPEC).select(F.lit("after"), "*"))


@register("all_features")
def all_features(spark, sf):
    """The whole feature table after cleanup (its parts have their own SQL twins)."""
    out, _ = build_features(scale.written(dense(spark, sf)), SPEC)
    return out


_SKETCHED = ("sales", "price", "promo_discount")


@register("cleanup_sketch", "SELECT " + ", ".join(f"""(SELECT count(*) FILTER (s < m.v) <= 0.5001 * count(s) + 1 AND count(*) FILTER (s <= m.v) >= 0.4999 * count(s) - 1
  FROM (SELECT {c} AS s FROM dense), (SELECT median({c}) AS v FROM dense) m) AS {c}_within""" for c in _SKETCHED) + " FROM range(1)")
def cleanup_sketch(spark, sf):
    """Whether each sketched median's rank lies within a ten-thousandth of the rows of the middle, by an exact count."""
    df = scale.written(dense(spark, sf).select(*_SKETCHED))
    counts, middle = scale.sketched_medians(df, list(_SKETCHED))
    inside = [((F.count_if(F.col(c) < middle[c]) <= 0.5001 * counts[c] + 1) & (F.count_if(F.col(c) <= middle[c]) >= 0.4999 * counts[c] - 1)).alias(f"{c}_within")
              for c in _SKETCHED]
    return df.agg(*inside)
