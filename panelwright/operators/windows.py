"""Per-series window features: lags, rolling statistics, EWM, trend, seasonality, promotion.

All of them partition by the series id only, so the whole module adds one
exchange to a plan. Frames include the current row unless stated otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright import scale
from panelwright.functions.numeric import CUR, UNB, clip, in_order, slope_at, whole, with_growth, with_position
from panelwright.spec import FeatureOptions, PanelSpec

# Smoothing windows and the row frames of a centred, same-length moving sum.
VELOCITY_FRAMES = {7: (-3, 3), 14: (-7, 6), 21: (-10, 10), 28: (-14, 13)}
MIN_TREND_ROWS = 28
MIN_CHANGE_ROWS = 21
BOUND = 1e6
NO_PROMO_YET = 999

_ROLLING = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def lags(df: DataFrame, spec: PanelSpec, opts: FeatureOptions = FeatureOptions()) -> DataFrame:
    w = in_order(spec)
    return df.withColumns({f"{c}_lag_{k}": F.lag(c, k).over(w)
                           for c, steps in opts.lags.items() if c in df.columns for k in steps})


def rolling(df: DataFrame, spec: PanelSpec, opts: FeatureOptions = FeatureOptions()) -> DataFrame:
    """Trailing mean / sample std / min / max over the last k rows, missing values skipped."""
    w = in_order(spec)
    return df.withColumns({
        f"{c}_rolling_{fn}_{k}": _ROLLING[fn](c).over(w.rowsBetween(1 - k, CUR))
        for c, (windows, fns) in opts.rolling.items() if c in df.columns for k in windows for fn in fns})


def ewm(df: DataFrame, spec: PanelSpec, opts: FeatureOptions = FeatureOptions()) -> DataFrame:
    """Recursive exponentially weighted mean, ``y = (w * y_prev + a * x) / (w + a)``.

    ``a = 2 / (span + 1)`` and ``w = (1 - a) ** k`` for an observation k rows after
    the previous one; a missing row repeats the last mean. The recursion is unrolled
    into running sums: with ``L`` the running log of the carry factors, ``y`` is
    ``exp(L) * sum(b * x * exp(-L))``. ``L`` is cut into blocks of e-80 so the
    exponentials stay in range; a block needs only itself and the one before, since
    anything older weighs less than e-80. Plain window sums, no Python worker.
    """
    keep, names = df.columns, []
    for column, spans in opts.ewm.items():
        if column in df.columns:
            df = _ewm(df, spec, column, {f"{column}_ewm_{span}": 2.0 / (span + 1) for span in spans})
            names += [f"{column}_ewm_{span}" for span in spans]
    return df.select(*keep, *names)


_BLOCK = 80.0


def _ewm(df: DataFrame, spec: PanelSpec, column: str, alphas: dict[str, float]) -> DataFrame:
    w, x = in_order(spec), F.col(column)
    observed = x.isNotNull()
    df = with_position(df, spec)
    df = df.withColumn("_seen", F.last(F.when(observed, F.col("_pos")), ignorenulls=True).over(w.rowsBetween(UNB, -1)))
    steps = {}
    for name, alpha in alphas.items():
        old = F.pow(F.lit(1.0 - alpha), (F.col("_pos") - F.col("_seen")).cast("double"))
        # a carry below e-60 cannot show in a double; the clamp keeps blocks contiguous
        steps[f"_step_{name}"] = F.when(observed & F.col("_seen").isNotNull(), F.greatest(
            F.lit(-60.0), F.log(old / (old + alpha)))).otherwise(0.0)
        steps[f"_gain_{name}"] = F.when(observed, F.when(F.col("_seen").isNull(), x).otherwise(
            x * alpha / (old + alpha))).otherwise(0.0)
    df = df.withColumns(steps)
    df = df.withColumns({f"_level_{n}": F.sum(f"_step_{n}").over(w.rowsBetween(UNB, CUR)) for n in alphas})
    for name in alphas:
        level = F.col(f"_level_{name}")
        df = df.withColumn("_block", F.floor(-level / _BLOCK).cast("int"))
        df = df.withColumn("_rel", level + F.col("_block") * F.lit(_BLOCK))
        df = df.withColumn("_part", F.col(f"_gain_{name}") * F.exp(-F.col("_rel")))
        # both windows run on the one order (series, block, day)
        df = df.withColumn("_here", F.sum("_part").over(in_order(spec, "_block").rowsBetween(UNB, CUR)))
        df = df.withColumn("_older", F.sum("_part").over(whole(spec).orderBy("_block").rangeBetween(-1, -1)))
        mean = F.exp("_rel") * (F.col("_here") + F.lit(math.exp(-_BLOCK)) * F.coalesce(F.col("_older"), F.lit(0.0)))
        df = df.withColumn(name, F.when(observed | F.col("_seen").isNotNull(), mean)).drop("_block", "_rel", "_part", "_here", "_older")
    return df


def trend(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``trend_strength``, ``sales_velocity_*d`` and ``sales_acceleration_*d``.

    Strength is the squared correlation of target and position over the series, 0
    when the series has a missing value or no variance. Velocity is the gradient
    smoothed by a centred zero-padded mean, acceleration its gradient; both look
    ahead by half a window. Series under 28 rows get 0 throughout.
    """
    w, own, keep, x = in_order(spec), whole(spec), df.columns, F.col(spec.target)
    df = with_position(df, spec).withColumns({"_before": F.lag(x).over(w), "_after": F.lead(x).over(w)})
    first, last = F.col("_pos") == 1, F.col("_pos") == F.col("_n")
    df = df.withColumn("_grad", F.coalesce(slope_at(F.col("_before"), x, F.col("_after"), first, last), F.lit(0.0)))
    df = df.withColumns({
        "_cov": F.covar_pop(x, F.col("_pos").cast("double")).over(own), "_vx": F.var_pop(x).over(own),
        "_vp": F.var_pop("_pos").over(own), "_seen": F.count(x).over(own),
        **{f"sales_velocity_{k}d": F.sum("_grad").over(w.rowsBetween(lo, hi)) / k
           for k, (lo, hi) in VELOCITY_FRAMES.items()}})
    long_enough = F.col("_n") >= MIN_TREND_ROWS
    full = (F.col("_seen") == F.col("_n")) & (F.sqrt("_vx") > 1e-6)
    strength = clip(F.try_divide(F.col("_cov") * F.col("_cov"), F.col("_vx") * F.col("_vp")), 0.0, 1.0)
    df = df.withColumns({
        "trend_strength": F.when(long_enough & full, F.coalesce(strength, F.lit(0.0))).otherwise(0.0),
        **{f"sales_velocity_{k}d": F.when(long_enough, clip(F.col(f"sales_velocity_{k}d"), -BOUND, BOUND)).otherwise(0.0)
           for k in VELOCITY_FRAMES}})
    accelerations = {}
    for k in VELOCITY_FRAMES:
        v = F.col(f"sales_velocity_{k}d")
        a = slope_at(F.lag(v).over(w), v, F.lead(v).over(w), first, last)
        accelerations[f"sales_acceleration_{k}d"] = F.when(
            long_enough, clip(F.coalesce(a, F.lit(0.0)), -BOUND, BOUND)).otherwise(0.0)
    df = df.withColumns(accelerations)
    return df.select(*keep, "trend_strength", *[f"sales_velocity_{k}d" for k in VELOCITY_FRAMES], *accelerations)


def change_points(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``change_point_score``: seven-row growth of the rolling seven-row variance.
    Can be infinite until cleanup; 0 where undefined and on series under 21 rows."""
    w, keep, x = in_order(spec), df.columns, F.col(spec.target)
    week = w.rowsBetween(-6, CUR)
    df = with_position(df, spec).withColumn("_var", F.when(F.count(x).over(week) == 7, F.var_samp(x).over(week)))
    df = with_growth(df, "_var", {"_change": 7}, w)
    score = F.when(F.col("_n") >= MIN_CHANGE_ROWS, F.coalesce("_change", F.lit(0.0))).otherwise(0.0)
    return df.withColumn("change_point_score", score).select(*keep, "change_point_score")


def seasonality_table(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per series: spread of its weekday and of its day-of-month means."""
    x = F.col(spec.target)
    # a row per series is all that leaves the map side: the mean of each weekday and day of month
    parts = {"_weekly": (F.weekday(spec.ts), range(7)), "_monthly": (F.dayofmonth(spec.ts), range(1, 32))}
    means = [F.array(*[F.avg(F.when(part == k, x)) for k in days]).alias(name) for name, (part, days) in parts.items()]
    both = df.groupBy(spec.id).agg(F.count(F.lit(1)).alias("_n"), F.avg(x).alias("_mean"), *means)

    def strength(name: str) -> Column:
        known = F.filter(name, lambda m: m.isNotNull())
        n = F.size(known)
        middle = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, m: a + m), n)
        variance = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, m: a + (m - middle) * (m - middle)), n)
        value = F.when(F.col("_mean") > 0, variance).otherwise(0.0)
        return F.when(F.col("_n") < 28, 0.0).otherwise(F.try_divide(value, F.col("_mean") + 1e-6))

    return both.select(spec.id, strength("_weekly").alias("weekly_seasonality"),
                       strength("_monthly").alias("monthly_seasonality"))


def seasonality(df: DataFrame, spec: PanelSpec, source: DataFrame | None = None, small: bool = False) -> DataFrame:
    """``weekly_seasonality`` and ``monthly_seasonality``: variance of the weekday (day of
    month) means relative to the series mean; 0 on series under 28 rows or without sales."""
    return scale.attach_series(df, seasonality_table(df if source is None else source, spec), spec.id, small=small)


def promo_effect(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``historical_promo_effectiveness``: relative lift of promotion days over other days,
    within +-10; 0 unless both kinds have more than five rows and a positive base."""
    own, keep, x, p = whole(spec), df.columns, F.col(spec.target), F.col("promo_flag")
    df = df.withColumns({
        "_n0": F.count(F.when(p == 0, 1)).over(own), "_n1": F.count(F.when(p == 1, 1)).over(own),
        "_m0": F.avg(F.when(p == 0, x)).over(own), "_m1": F.avg(F.when(p == 1, x)).over(own)})
    usable = (F.col("_n0") > 5) & (F.col("_n1") > 5) & (F.coalesce("_m0", F.lit(0.0)) > 1e-6)
    lift = clip(F.try_divide(F.col("_m1") - F.col("_m0"), F.col("_m0")), -10.0, 10.0)
    return df.withColumn("historical_promo_effectiveness", F.when(usable, lift).otherwise(0.0)).select(
        *keep, "historical_promo_effectiveness")


def promo_frequency(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.withColumn("promo_frequency_30d", F.avg("promo_flag").over(in_order(spec).rowsBetween(-29, CUR)))


def days_since_promo(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``days_since_last_promo``: rows since the last promotion row, 0 on it, 999 before the first."""
    w, keep = in_order(spec), df.columns
    df = with_position(df, spec)
    seen = F.last(F.when(F.col("promo_flag") == 1, F.col("_pos")), ignorenulls=True).over(w.rowsBetween(UNB, CUR))
    return df.withColumn("days_since_last_promo", F.coalesce(F.col("_pos") - seen, F.lit(NO_PROMO_YET))).select(
        *keep, "days_since_last_promo")


def discount_depth(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``discount_vs_historical_avg`` against the trailing 90 rows and ``is_deep_discount``
    (a promotion row in the series' top quarter of discounts)."""
    own, keep, x = whole(spec), df.columns, F.col("promo_discount")
    df = df.withColumns({"_avg": F.avg(x).over(in_order(spec).rowsBetween(-89, CUR)),
                         "_q75": F.percentile(x, F.lit(0.75)).over(own)})
    ratio = x / clip(F.col("_avg"), 1e-6)
    deep = (x >= F.col("_q75")) & (F.col("promo_flag") == 1)
    return df.withColumns({
        "discount_vs_historical_avg": clip(F.coalesce(ratio, F.lit(1.0)), 0.1, 10.0),
        "is_deep_discount": F.coalesce(deep.cast("int"), F.lit(0)),
    }).select(*keep, "discount_vs_historical_avg", "is_deep_discount")


def promo_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """All promotion features; none without ``promo_flag``, depth only with ``promo_discount``."""
    if "promo_flag" not in df.columns:
        return df
    df = days_since_promo(promo_frequency(promo_effect(df, spec), spec), spec)
    return discount_depth(df, spec) if "promo_discount" in df.columns else df
