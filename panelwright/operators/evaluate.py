"""Forecast evaluation: alignment, business metrics, residuals and chart tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.numeric import in_order, in_reverse
from panelwright.spec import PanelSpec

METRICS = ("weighted_mape", "bias_pct", "under_bias_pct", "over_bias_pct", "rmse", "mae", "n_samples", "n_skus")


def point_column(columns: list[str]) -> str:
    """The forecast column to score: the mean, else the median, else the first one."""
    return next((c for c in ("mean", "0.5", "q_0_5") if c in columns), columns[0])


def align(actuals: DataFrame, forecast: DataFrame, spec: PanelSpec, horizon: int = 14, how: str = "date",
          point: str | None = None) -> DataFrame:
    """``id, ts, actual, predicted`` (and ``promo_flag``) for scoring.

    ``date`` joins on series and day. ``position`` pairs the last ``horizon`` actual rows
    with the forecast rows in order, whatever their dates, and leaves out series whose
    two counts differ.
    """
    point = point or point_column([c for c in forecast.columns if c not in (spec.id, spec.ts)])
    promo = [F.col("promo_flag")] if "promo_flag" in actuals.columns else []
    actual = actuals.select(spec.id, spec.ts, F.col(spec.target).alias("actual"), *promo)
    predicted = forecast.select(spec.id, spec.ts, F.col(point).alias("predicted"))
    if how == "date":
        return actual.join(predicted, [spec.id, spec.ts])
    own = Window.partitionBy(spec.id)
    actual = actual.withColumns({"_back": F.row_number().over(in_reverse(spec))}).where(F.col("_back") <= horizon)
    actual = actual.withColumns({"_count": F.count(F.lit(1)).over(own)})
    actual = actual.withColumn("_place", F.col("_count") - F.col("_back") + 1)
    predicted = predicted.withColumns({"_place": F.row_number().over(in_order(spec)), "_count": F.count(F.lit(1)).over(own)})
    return actual.join(predicted.drop(spec.ts), [spec.id, "_place", "_count"]).drop("_place", "_count", "_back")


def mismatched(actuals: DataFrame, forecast: DataFrame, spec: PanelSpec, horizon: int = 14) -> DataFrame:
    """Series left out by positional alignment, with both row counts."""
    n_actual = actuals.groupBy(spec.id).agg(F.least(F.count(F.lit(1)), F.lit(horizon).cast("long")).alias("n_actual"))
    n_forecast = forecast.groupBy(spec.id).agg(F.count(F.lit(1)).alias("n_forecast"))
    both = n_actual.join(n_forecast, spec.id, "left").withColumn("n_forecast", F.coalesce("n_forecast", F.lit(0).cast("long")))
    return both.where(F.col("n_actual") != F.col("n_forecast"))


def unmatched(actuals: DataFrame, forecast: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row: actual days without a forecast that alignment by date leaves out, and the series they belong to.
    ``actuals`` holds the days to score."""
    left = actuals.select(spec.id, spec.ts).join(forecast.select(spec.id, spec.ts).distinct(), [spec.id, spec.ts], "left_anti")
    return left.agg(F.count(F.lit(1)).alias("n_unmatched"), F.countDistinct(spec.id).alias("n_unmatched_skus"))


def scored_rows(aligned: DataFrame) -> DataFrame:
    """Drop out-of-stock days (actual 0) and promotion days."""
    keep = F.col("actual") != 0
    if "promo_flag" in aligned.columns:
        keep = keep & (F.coalesce("promo_flag", F.lit(0)) != 1)
    return aligned.where(keep)


def _share(error: Column) -> Column:
    return F.try_divide(F.sum(error), F.sum("actual")) * 100


def metrics(aligned: DataFrame, n_series: DataFrame) -> DataFrame:
    """One row of business metrics. ``n_series`` is a one-value frame with the number of all
    series under test; without a scored row every metric is NULL and both counts are 0."""
    e, a, p = F.col("predicted") - F.col("actual"), F.col("actual"), F.col("predicted")
    ape = F.abs(F.try_divide(e, a))
    none = F.when(F.count(F.lit(1)) > 0, F.lit(0.0))
    return scored_rows(aligned).agg(
        (F.try_divide(F.sum(ape * a), F.sum("actual")) * 100).alias("weighted_mape"),
        _share(e).alias("bias_pct"),
        F.coalesce(_share(F.when(p < a, e)), none).alias("under_bias_pct"),
        F.coalesce(_share(F.when(p > a, e)), none).alias("over_bias_pct"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.count(F.lit(1)).alias("n_samples"),
    ).withColumn("n_skus", F.when(F.col("n_samples") > 0, n_series.scalar()).otherwise(0).cast("long"))


def count_series(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.agg(F.countDistinct(spec.id).alias("n"))


def residuals(aligned: DataFrame, spec: PanelSpec) -> DataFrame:
    """Residual per row (actual minus predicted) with the series' RMSE on each of its rows."""
    r = F.col("actual") - F.col("predicted")
    return aligned.withColumn("residual", r).withColumn(
        "rmse", F.sqrt(F.avg(F.col("residual") * F.col("residual")).over(Window.partitionBy(spec.id)))).select(
        spec.id, spec.ts, "residual", "rmse")


def series_errors(aligned: DataFrame, spec: PanelSpec) -> DataFrame:
    """MAE and MAPE (over non-zero actuals) per series."""
    e = F.abs(F.col("actual") - F.col("predicted"))
    return aligned.groupBy(spec.id).agg(
        F.avg(e).alias("mae"),
        (F.avg(F.when(F.col("actual") != 0, F.try_divide(e, F.abs(F.col("actual"))))) * 100).alias("mape"))


def _band(df: DataFrame) -> list[Column]:
    return [F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in ("q_0_1", "q_0_9")]


def holdout_chart(test: DataFrame, forecast: DataFrame, spec: PanelSpec, horizon: int = 14, history: int = 60) -> DataFrame:
    """Rows of an actual-against-forecast chart: ``id, ts, kind, value, lower, upper, cutoff``.
    The forecast is drawn on the days of the last ``horizon`` actual rows, in order."""
    rows = test.withColumn("_back", F.row_number().over(in_reverse(spec))).where(F.col("_back") <= horizon + history)
    cut = F.max(F.when(F.col("_back") > horizon, F.col(spec.ts))).over(Window.partitionBy(spec.id))
    first = F.min(spec.ts).over(Window.partitionBy(spec.id))
    rows = rows.withColumn("cutoff", F.coalesce(cut, first))
    nothing = F.lit(None).cast("double")
    kind = F.when(F.col("_back") > horizon, "history").otherwise("actual")
    observed = rows.select(spec.id, spec.ts, kind.alias("kind"), F.col(spec.target).alias("value"),
                           nothing.alias("lower"), nothing.alias("upper"), "cutoff")
    point = point_column([c for c in forecast.columns if c not in (spec.id, spec.ts)])
    lo, hi = _band(forecast)
    drawn = forecast.withColumn("_place", F.row_number().over(in_order(spec))).select(
        spec.id, "_place", F.lit("forecast").alias("kind"), F.col(point).alias("value"), lo.alias("lower"), hi.alias("upper"))
    own = Window.partitionBy(spec.id)
    days = rows.where(F.col("_back") <= horizon).withColumn("_place", F.count(F.lit(1)).over(own) - F.col("_back") + 1)
    drawn = drawn.join(days.select(spec.id, "_place", spec.ts, "cutoff"), [spec.id, "_place"])
    return observed.unionByName(drawn.select(*observed.columns))


def future_chart(history: DataFrame, forecast: DataFrame, spec: PanelSpec, rows: int = 90) -> DataFrame:
    """Rows of a future chart: the last ``rows`` of history, then the forecast with its band."""
    tail = history.withColumn("_back", F.row_number().over(in_reverse(spec))).where(F.col("_back") <= rows)
    nothing = F.lit(None).cast("double")
    past = tail.select(spec.id, spec.ts, F.lit("history").alias("kind"), F.col(spec.target).alias("value"),
                       nothing.alias("lower"), nothing.alias("upper"))
    point = point_column([c for c in forecast.columns if c not in (spec.id, spec.ts)])
    lo, hi = _band(forecast)
    ahead = forecast.select(spec.id, spec.ts, F.lit("forecast").alias("kind"), F.col(point).alias("value"),
                            lo.alias("lower"), hi.alias("upper"))
    return past.unionByName(ahead)
