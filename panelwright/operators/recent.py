"""Recent-state features: statistics of the last rows of a series, on all of its rows.

A missing value in the tail makes a statistic undefined rather than being skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import clip, in_order, whole, with_position
from panelwright.spec import PanelSpec


def _from_end(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add ``_rn``, 1 on the last row. Derived from the position, so no descending sort."""
    df = with_position(df, spec)
    return df.withColumn("_rn", F.col("_n") - F.col("_pos") + 1)


def decline(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``sales_decline_indicator`` (slope of the last 7 rows under -0.1),
    ``consecutive_decline_days`` (falling streak at the end, over 14 rows) and
    ``decline_magnitude`` (fall from the peak of the last 30 rows). 0 under 14 rows."""
    own, keep, x = whole(spec), df.columns, F.col(spec.target)
    df = _from_end(df, spec).withColumn("_falling", F.coalesce(x < F.lag(x).over(in_order(spec)), F.lit(False)))
    rn = F.col("_rn")
    week, month = rn <= 7, rn <= 30
    df = df.withColumns({
        "_slope": F.regr_slope(F.when(week, x), (-rn).cast("double")).over(own),
        "_sd": F.stddev_pop(F.when(week, x)).over(own), "_c7": F.count(F.when(week, x)).over(own),
        "_stop": F.min(F.when((rn <= 13) & ~F.col("_falling"), rn)).over(own),
        "_peak": F.max(F.when(month, x)).over(own), "_now": F.max(F.when(rn == 1, x)).over(own),
        "_gone": F.count(F.when(month & x.isNull(), 1)).over(own)})
    enough = F.col("_n") >= 14
    falling = (F.col("_c7") == 7) & (F.col("_sd") > 1e-6) & (F.col("_slope") < -0.1)
    fall = F.when(F.col("_gone") == 0, clip(F.try_divide(F.col("_peak") - F.col("_now"), F.col("_peak") + 1e-6), 0.0, 1.0))
    return df.withColumns({
        "sales_decline_indicator": F.coalesce((enough & falling).cast("int"), F.lit(0)),
        "consecutive_decline_days": F.when(enough, F.coalesce(F.col("_stop") - 1, F.lit(13))).otherwise(0).cast("int"),
        "decline_magnitude": F.when(enough, F.coalesce(fall, F.lit(0.0))).otherwise(0.0),
    }).select(*keep, "sales_decline_indicator", "consecutive_decline_days", "decline_magnitude")


def volatility(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``volatility_risk_score``: mean coefficient of variation of the last 7, 14 and 21 rows,
    within 0..5; 0 under 21 rows and NULL when the last 21 rows miss a value."""
    own, keep, x = whole(spec), df.columns, F.col(spec.target)
    df = _from_end(df, spec)
    stats = {"_c21": F.count(F.when(F.col("_rn") <= 21, x)).over(own)}
    for k in (7, 14, 21):
        tail = F.when(F.col("_rn") <= k, x)
        stats[f"_cv{k}"] = F.try_divide(F.stddev_pop(tail).over(own), F.avg(tail).over(own) + 1e-6)
    df = df.withColumns(stats)
    score = F.when(F.col("_c21") == 21, clip((F.col("_cv7") + F.col("_cv14") + F.col("_cv21")) / 3, 0.0, 5.0))
    return df.withColumn("volatility_risk_score", F.when(F.col("_n") < 21, 0.0).otherwise(score)).select(
        *keep, "volatility_risk_score")
