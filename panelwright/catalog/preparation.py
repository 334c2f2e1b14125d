"""Sources, projections, imputation, outliers, densification."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelwright import scale
from panelwright.catalog.base import R, SPEC, dense, gappy, panel, r, register, rounded
from panelwright.functions.numeric import clip, in_order
from panelwright.operators import frames, report
from panelwright.operators import prepare as prep
from panelwright.plans.prepare import prepare_panel
from panelwright.sources import tables
from panelwright.spec import PanelSpec, PrepOptions

KEY = ["sku", "date"]


def _folder(spark, name: str) -> str:
    return f"{scale.checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


@register("read_panel_csv", f"""
SELECT sku, date, sales, category, subcategory, brand, product_group, promo_flag, promo_discount,
       special_event, {R('price')} AS price FROM gappy""")
def read_panel_csv(spark, sf):
    path = _folder(spark, "panel-csv")
    gappy(spark, sf).write.option("header", True).csv(path)
    return tables.read_panel(spark, path, SPEC).withColumn("price", r("price"))


@register("read_panel_parquet", f"""
SELECT sku, date, sales, category, subcategory, brand, product_group, promo_flag, promo_discount,
       special_event, {R('price')} AS price FROM gappy""")
def read_panel_parquet(spark, sf):
    """Days as text and flags as doubles, as other writers leave them."""
    path = _folder(spark, "panel-parquet")
    gappy(spark, sf).withColumns({"date": F.date_format("date", "yyyy-MM-dd"), "promo_flag": F.col("promo_flag").cast("double")}).write.parquet(path)
    return tables.read_panel(spark, path, SPEC, fmt="parquet").withColumn("price", r("price"))


@register("normalised_table", "SELECT p_brand AS sku, p_type AS category, CAST(p_size AS DOUBLE) AS sales FROM part")
def normalised_table(spark, sf):
    spec = PanelSpec(id="p_brand", ts="day", target="p_size", static=("p_type",))
    part = spark.read.parquet(f"{sf}/part.parquet")
    return tables.normalise(part, spec).select(F.col("p_brand").alias("sku"), F.col("p_type").alias("category"),
                                               F.col("p_size").alias("sales"))


_TEXT_DAY = "CASE WHEN l_orderkey % 10 = 0 THEN 'n/a' ELSE strftime(l_shipdate, '%Y-%m-%d') END"


@register("parse_time_strict", "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem")
def parse_time_strict(spark, sf):
    text = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"))
    return tables.parse_time(text, "day", "yyyy-MM-dd")


@register("parse_time_lenient", f"""
SELECT l_orderkey, l_linenumber, TRY_CAST({_TEXT_DAY} AS DATE) AS day FROM lineitem""")
def parse_time_lenient(spark, sf):
    text = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 10 == 0, "n/a").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("day"))
    return tables.parse_time(text, "day", "yyyy-MM-dd", lenient=True)


@register("read_future_promo", """
SELECT sku, date, promo_flag, promo_discount, special_event FROM panel""")
def read_future_promo(spark, sf):
    path = _folder(spark, "promo-csv")
    panel(spark, sf).select(*KEY, "promo_flag", "promo_discount", "special_event").write.option("header", True).csv(path)
    return tables.read_future_promo(spark, path, SPEC)


@register("panel_profile", f"""
SELECT count(DISTINCT sku) AS n_series, count(*) AS n_rows, min(date) AS first_day, max(date) AS last_day,
       {R('avg(sales)')} AS mean_target, max(sales) AS max_target, count(*) FILTER (WHERE sales = 0) AS zero_days,
       {R('100.0 * count(*) FILTER (WHERE sales = 0) / count(*)')} AS zero_pct,
       count(*) FILTER (WHERE promo_flag = 1) AS promo_days,
       {R('100 * avg(promo_discount) FILTER (WHERE promo_discount > 0)')} AS avg_discount_pct,
       CAST(sum(special_event) AS BIGINT) AS event_days FROM panel""")
def panel_profile(spark, sf):
    return report.panel_profile(panel(spark, sf), SPEC).withColumns(
        {c: r(c) for c in ("mean_target", "zero_pct", "avg_discount_pct")})


@register("series_mix", f"""
WITH s AS (SELECT DISTINCT sku, category FROM panel)
SELECT category, count(*) AS n_series, {R('count(*) * 100.0 / (SELECT count(*) FROM s)')} AS pct
FROM s GROUP BY category""")
def series_mix(spark, sf):
    return report.series_mix(panel(spark, sf), SPEC, "category").withColumn("pct", r("pct"))


@register("drop_static_columns", "SELECT sku, date, sales, promo_flag, promo_discount, special_event FROM panel")
def drop_static_columns(spark, sf):
    return frames.without_static(panel(spark, sf), SPEC).drop("price")


@register("available_covariates", "SELECT sku, date, promo_flag, promo_discount, special_event FROM panel")
def available_covariates(spark, sf):
    df = panel(spark, sf)
    return df.select(*KEY, *frames.available(df, SPEC.known))


@register("min_history", """
SELECT sku, date, sales FROM panel WHERE sku IN (SELECT sku FROM panel GROUP BY sku HAVING count(*) >= 120)""")
def min_history(spark, sf):
    """Some series have more than 120 rows and some fewer at the small scales."""
    return prep.min_history(panel(spark, sf), SPEC, 120).select(*KEY, "sales")


@register("drop_zero_series", """
WITH low AS (SELECT sku, date, CASE WHEN bn % 3 = 0 THEN 0.0 ELSE greatest(sales - 48, 0) END AS sales FROM panel)
SELECT * FROM low WHERE sku IN (SELECT sku FROM low WHERE sales > 0)""")
def drop_zero_series(spark, sf):
    """Every third brand sells nothing."""
    third = F.split("brand", "#")[1].cast("int") % 3 == 0
    low = panel(spark, sf).withColumn("sales", F.when(third, 0.0).otherwise(F.greatest(F.col("sales") - 48, F.lit(0.0))))
    return prep.drop_zero_series(low, SPEC).select(*KEY, "sales")


@register("clip_scalar", f"""
SELECT sku, date, CASE WHEN sales IS NOT NULL THEN least(greatest(sales, 10.0), 40.0) END AS clipped,
       CASE WHEN sales IS NOT NULL THEN greatest(sales, 25.0) END AS floored FROM gappy""")
def clip_scalar(spark, sf):
    x = F.col("sales")
    return gappy(spark, sf).select(*KEY, clip(x, 10.0, 40.0).alias("clipped"), clip(x, lo=25.0).alias("floored"))


@register("series_positions", """
SELECT sku, date, CAST(row_number() OVER (PARTITION BY sku ORDER BY date) AS INTEGER) AS position FROM panel""")
def series_positions(spark, sf):
    return panel(spark, sf).select(*KEY, F.row_number().over(in_order(SPEC)).alias("position"))


def _runs(base: str) -> str:
    return f"""
pos AS (SELECT sku, date, sales, row_number() OVER w AS p, count(*) OVER (PARTITION BY sku) AS n,
               count(sales) OVER w AS grp FROM {base} WINDOW w AS (PARTITION BY sku ORDER BY date)),
runs AS (SELECT *, CASE WHEN sales IS NULL THEN
                sum(CASE WHEN sales IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY sku, grp) ELSE 0 END AS run,
                max(CASE WHEN sales IS NOT NULL THEN p END) OVER (PARTITION BY sku, grp) AS pp,
                max(sales) OVER (PARTITION BY sku, grp) AS pv,
                avg(sales) OVER (PARTITION BY sku, isodow(date)) AS dm FROM pos),
near AS (SELECT *, min(CASE WHEN sales IS NOT NULL THEN p END) OVER f AS np, first_value(sales IGNORE NULLS) OVER f AS nv
         FROM runs WINDOW f AS (PARTITION BY sku ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def _imputed(base: str, limit: int = 7) -> str:
    """Interpolation with all its branches, as common table expressions ending in ``imputed``."""
    return _runs(base) + f""",
gaps AS (SELECT *, sales IS NULL AND run <= {limit} AS small, sales IS NULL AND run > {limit} AS large,
                CASE WHEN np IS NULL THEN pv ELSE pv + (nv - pv) * (p - pp) / (np - pp) END AS line,
                CASE WHEN np IS NULL THEN pv ELSE pv + (nv - pv) * {limit}.0 / (np - pp) END AS line_end FROM near),
flags AS (SELECT *, bool_or(small) OVER (PARTITION BY sku) AS any_small,
                 bool_or(large) OVER (PARTITION BY sku) AS any_large FROM gaps),
filled AS (SELECT *, CASE WHEN sales IS NOT NULL THEN sales
    WHEN small THEN CASE WHEN n > 14 THEN 0.7 * line + 0.3 * dm ELSE line END
    ELSE pow(0.95, p - pp) * CASE WHEN n > 14 OR NOT any_small THEN pv WHEN p - pp <= {limit} THEN line ELSE line_end END
    END AS f FROM flags),
imputed AS (SELECT sku, date, coalesce(f, CASE WHEN any_large THEN first_value(f IGNORE NULLS) OVER (
    PARTITION BY sku ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END) AS sales FROM filled)"""


@register("gap_run_length", f"WITH {_runs('dense')} SELECT sku, date, CAST(run AS INTEGER) AS gap_run FROM runs")
def gap_run_length(spark, sf):
    return prep.gap_runs(dense(spark, sf), SPEC).select(*KEY, "gap_run")


@register("impute_interpolate", f"WITH {_imputed('dense')} SELECT sku, date, {R('sales')} AS sales FROM imputed")
def impute_interpolate(spark, sf):
    return prep.impute_interpolate(dense(spark, sf), SPEC, 7).select(*KEY, r("sales"))


@register("impute_interpolate_observed_days",
          f"WITH {_imputed('gappy', 1)} SELECT sku, date, {R('sales')} AS sales FROM imputed")
def impute_interpolate_observed_days(spark, sf):
    return prep.impute_interpolate(gappy(spark, sf), SPEC, 1).select(*KEY, r("sales"))


_CHUNKS = """chunks AS (SELECT sku || '/' || ((row_number() OVER (PARTITION BY sku ORDER BY date) - 1) // 14) AS sku,
                    date, sales FROM dense)"""


def _chunks(spark, sf):
    """Every series cut into consecutive series of 14 rows, the longest that count as short."""
    block = F.floor((F.row_number().over(in_order(SPEC)) - 1) / 14)
    cut = dense(spark, sf).withColumn("_block", block)
    return cut.select(F.concat_ws("/", "sku", "_block").alias("sku"), "date", "sales")


@register("impute_short_series", f"""
WITH {_CHUNKS}, {_imputed('chunks')} SELECT sku, date, {R('sales')} AS sales FROM imputed""")
def impute_short_series(spark, sf):
    return prep.impute_interpolate(_chunks(spark, sf), SPEC, 7).select(*KEY, r("sales"))


@register("impute_ffill", f"""
WITH {_runs('dense')} SELECT sku, date, coalesce(sales, CASE WHEN p - pp <= 7 THEN pv END, nv) AS sales FROM near""")
def impute_ffill(spark, sf):
    return prep.impute_ffill(dense(spark, sf), SPEC, 7).select(*KEY, "sales")


@register("impute_zero", "SELECT sku, date, coalesce(sales, 0.0) AS sales FROM gappy")
def impute_zero(spark, sf):
    return prep.impute_zero(gappy(spark, sf), SPEC).select(*KEY, "sales")


@register("fill_remaining_median", f"""
SELECT sku, date, {R('coalesce(sales, quantile_cont(sales, 0.5) OVER (PARTITION BY sku), 0.0)')} AS sales FROM gappy""")
def fill_remaining_median(spark, sf):
    return prep.fill_remaining(gappy(spark, sf), SPEC).select(*KEY, r("sales"))


_BOUNDS = """
stats AS (SELECT sku, quantile_cont(sales, 0.25) AS q1, quantile_cont(sales, 0.75) AS q3,
                 stddev_samp(sales) / (avg(sales) + 1e-6) AS cv,
                 quantile_cont(sales, 0.25) FILTER (WHERE promo_flag = 1) AS pq1,
                 quantile_cont(sales, 0.75) FILTER (WHERE promo_flag = 1) AS pq3,
                 count(*) FILTER (WHERE promo_flag = 1) AS pn FROM gappy GROUP BY sku),
width AS (SELECT *, (CASE WHEN cv > 1.5 THEN 2.5 WHEN cv > 0.8 THEN 2.0 ELSE 1.5 END) * (q3 - q1) AS k FROM stats),
bounds AS (SELECT sku, greatest(0.0, q1 - k) AS lo, q3 + k AS hi,
                  CASE WHEN pn > 5 THEN pq3 + 1.5 * (pq3 - pq1) ELSE q3 + k END AS hi_promo FROM width),
clipped AS (SELECT g.sku, g.date, lo, hi, CASE WHEN sales IS NOT NULL THEN
                   least(greatest(sales, lo), CASE WHEN promo_flag = 1 THEN hi_promo ELSE hi END) END AS sales
            FROM gappy g JOIN bounds b ON g.sku = b.sku)"""


@register("clip_outliers", f"WITH {_BOUNDS} SELECT sku, date, {R('sales')} AS sales FROM clipped")
def clip_outliers(spark, sf):
    return prep.clip_outliers(gappy(spark, sf), SPEC).select(*KEY, r("sales"))


@register("outlier_counts", f"""
WITH {_BOUNDS} SELECT sku, count(*) FILTER (WHERE sales = lo OR sales = hi) AS n_outliers FROM clipped GROUP BY sku""")
def outlier_counts(spark, sf):
    return prep.outlier_counts(gappy(spark, sf), SPEC)


@register("remove_outliers", """
SELECT sku, date, sales FROM (
  SELECT *, quantile_cont(sales, 0.01) OVER (PARTITION BY sku) AS lo, quantile_cont(sales, 0.99) OVER (PARTITION BY sku) AS hi
  FROM gappy) WHERE sales BETWEEN lo AND hi""")
def remove_outliers(spark, sf):
    return prep.remove_outliers(gappy(spark, sf), SPEC, 0.01, 0.99).select(*KEY, "sales")


@register("densify", "SELECT sku, date, sales, promo_flag, promo_discount, special_event FROM dense")
def densify(spark, sf):
    return dense(spark, sf).select(*KEY, "sales", "promo_flag", "promo_discount", "special_event")


@register("densify_carry_static", "SELECT sku, date, category, subcategory, brand, product_group FROM dense")
def densify_carry_static(spark, sf):
    return dense(spark, sf).select(*KEY, *SPEC.static)


@register("carry_static", """
SELECT sku, date, coalesce(last_value(c IGNORE NULLS) OVER (PARTITION BY sku ORDER BY date ROWS UNBOUNDED PRECEDING),
  first_value(c IGNORE NULLS) OVER (PARTITION BY sku ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS category
FROM (SELECT sku, date, CASE WHEN sales > 30 THEN category || '-' || month(date) END AS c FROM gappy)""")
def carry_static(spark, sf):
    holes = gappy(spark, sf).select(*KEY, F.when(
        F.col("sales") > 30, F.concat_ws("-", "category", F.month("date"))).alias("category"))
    return prep.carry_static(holes, SPEC)


@register("quality_report", f"""
WITH {_imputed('gappy')}
SELECT (SELECT count(*) FROM gappy WHERE sales IS NULL) AS initial_missing,
       (SELECT count(*) FROM imputed WHERE sales IS NULL) AS final_missing,
       (SELECT count(DISTINCT sku) FROM gappy) AS initial_series,
       (SELECT count(*) FROM (SELECT sku FROM gappy GROUP BY sku HAVING count(*) < 120)) AS removed_series,
       CAST(0 AS BIGINT) AS rows_without_id""")
def quality_report(spark, sf):
    raw = gappy(spark, sf)
    return prep.quality_report(raw, prep.impute_interpolate(raw, SPEC, 7), prep.min_history(raw, SPEC, 120), SPEC)


@register("duplicate_keys", """
SELECT p_brand || '~' || p_type AS sku, CAST(l_shipdate AS DATE) AS date, count(*) AS n_rows
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").join(
        spark.read.parquet(f"{sf}/part.parquet"), F.col("l_partkey") == F.col("p_partkey"))
    return prep.duplicate_keys(lines.select(F.concat_ws("~", "p_brand", "p_type").alias("sku"),
                                            F.col("l_shipdate").cast("date").alias("date")), SPEC)


@register("prepared_panel", f"""
WITH {_imputed('gappy')},
whole AS (SELECT i.sku, i.date, coalesce(i.sales, quantile_cont(i.sales, 0.5) OVER (PARTITION BY i.sku), 0.0) AS sales,
                 p.promo_flag FROM imputed i JOIN panel p ON p.sku = i.sku AND p.date = i.date),
{_BOUNDS.replace('FROM gappy', 'FROM whole').strip()},
kept AS (SELECT * FROM clipped WHERE sku IN (SELECT sku FROM clipped GROUP BY sku HAVING count(*) >= 60)),
limits AS (SELECT min(date) AS lo, max(date) AS hi FROM kept),
cells AS (SELECT sku, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
          FROM (SELECT DISTINCT sku FROM kept), limits)
SELECT c.sku, c.date, s.category, {R('k.sales')} AS sales
FROM cells c JOIN statics s ON s.sku = c.sku LEFT JOIN kept k ON k.sku = c.sku AND k.date = c.date""")
def prepared_panel(spark, sf):
    return prepare_panel(gappy(spark, sf), SPEC, PrepOptions()).select(*KEY, "category", r("sales"))
