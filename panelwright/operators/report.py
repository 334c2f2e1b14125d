"""Panel profiles and the text report of a metrics row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.spec import PanelSpec

# Report labels and number formats by metric.
REPORT_LINES = (
    ("Number of SKUs evaluated: %d", "n_skus"),
    ("Number of valid samples: %d", "n_samples"),
    ("Weighted MAPE: %.2f%%", "weighted_mape"),
    ("Overall Bias %%: %.2f%%", "bias_pct"),
    ("Under Bias %% (pred < actual): %.2f%%", "under_bias_pct"),
    ("Over Bias %% (pred > actual): %.2f%%", "over_bias_pct"),
    ("RMSE: %.2f", "rmse"),
    ("MAE: %.2f", "mae"),
)


def metrics_report(metrics: DataFrame, models: tuple[str, ...] = (), horizon: int | None = None) -> DataFrame:
    """``(line_no, text)`` of a readable report; a missing metric prints as nan."""
    head = [F.lit("=" * 60), F.lit("FORECAST EVALUATION REPORT"), F.lit("=" * 60)]
    if models:
        head.append(F.lit(f"Model: {list(models)}"))
    if horizon is not None:
        head.append(F.lit(f"Prediction Length: {horizon} days"))
    head += [F.lit(""), F.lit("EVALUATION METRICS (excluding OOS and promo periods)"), F.lit("-" * 60)]
    body = []
    for template, name in REPORT_LINES:
        plain = template.replace("%.2f", "nan").replace("%%", "%")
        body.append(F.coalesce(F.when(F.col(name).isNotNull(), F.format_string(template, F.col(name))), F.lit(plain)))
    lines = F.array(*head, *body, F.lit("=" * 60))
    return metrics.select(F.posexplode(lines).alias("line_no", "text"))


def panel_profile(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row: size, date range, target level, zero days, promotion and event days."""
    x, n = F.col(spec.target), F.count(F.lit(1))
    zero = F.count_if(x == 0)
    out = [F.countDistinct(spec.id).alias("n_series"), n.alias("n_rows"), F.min(spec.ts).alias("first_day"),
           F.max(spec.ts).alias("last_day"), F.avg(x).alias("mean_target"), F.max(x).alias("max_target"),
           zero.alias("zero_days"), (F.try_divide(zero, n) * 100).alias("zero_pct")]
    if "promo_flag" in df.columns:
        out.append(F.count_if(F.col("promo_flag") == 1).alias("promo_days"))
    if "promo_discount" in df.columns:
        out.append((F.avg(F.when(F.col("promo_discount") > 0, F.col("promo_discount"))) * 100).alias("avg_discount_pct"))
    if "special_event" in df.columns:
        out.append(F.sum("special_event").cast("long").alias("event_days"))
    return df.agg(*out)


def series_mix(df: DataFrame, spec: PanelSpec, by: str) -> DataFrame:
    """Number and percentage of series per value of a series attribute."""
    series = df.groupBy(spec.id).agg(F.max(by).alias(by))
    total = series.agg(F.count(F.lit(1)).alias("n"))
    return series.groupBy(by).agg(F.count(F.lit(1)).alias("n_series")).select(
        by, "n_series", (F.col("n_series") * 100.0 / total.scalar()).alias("pct"))
