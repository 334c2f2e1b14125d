"""Series preparation: keys, gap runs, imputation, outliers, history filter, densify.

Every operator keeps the rows of a series together on the series id, so a chain
of them shares one exchange. Positions are row positions within a series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import CUR, UNB, clip, in_order, in_reverse, whole
from panelwright.spec import PanelSpec, PrepOptions

BLEND = 0.7          # weight of the straight line against the weekday mean
DECAY = 0.95         # daily decay of a value carried into a long gap
SHORT_SERIES = 14    # rows up to which no weekday mean is used


def assert_unique_keys(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Fail with the offending keys when a series has two rows for one day."""
    repeated = df.groupBy(spec.id, spec.ts).count().where("count > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"duplicate ({spec.id}, {spec.ts}) keys: {[tuple(r)[:2] for r in repeated]}")
    return df


def duplicate_keys(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.groupBy(spec.id, spec.ts).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def gap_runs(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Describe the missing-value run each row sits in.

    Adds ``_pos, _n`` (position and length of the series), ``_prev, _next`` (position
    and value of the observed neighbours) and ``gap_run`` (run length, 0 on observed rows).
    The look-ahead uses a descending window: a shrinking forward frame would be quadratic.
    """
    w, back = in_order(spec), in_reverse(spec)
    df = df.withColumns({"_pos": F.row_number().over(w), "_n": F.count(F.lit(1)).over(whole(spec))})
    seen = F.when(F.col(spec.target).isNotNull(), F.struct(F.col("_pos").alias("pos"), F.col(spec.target).alias("value")))
    df = df.withColumns({
        "_prev": F.last(seen, ignorenulls=True).over(w.rowsBetween(UNB, CUR)),
        "_next": F.last(seen, ignorenulls=True).over(back.rowsBetween(UNB, CUR)),
    })
    before = F.coalesce(F.col("_prev.pos"), F.lit(0))
    after = F.coalesce(F.col("_next.pos"), F.col("_n") + 1)
    return df.withColumn("gap_run", F.when(F.col(spec.target).isNotNull(), 0).otherwise(after - before - 1).cast("int"))


def _straight_line() -> Column:
    """Value on the line between the observed neighbours; the last value after the final one."""
    prev, nxt = F.col("_prev"), F.col("_next")
    share = F.try_divide(F.col("_pos") - prev["pos"], nxt["pos"] - prev["pos"])
    return F.when(nxt.isNull(), prev["value"]).otherwise(prev["value"] + (nxt["value"] - prev["value"]) * share)


def impute_interpolate(df: DataFrame, spec: PanelSpec, limit: int = 7) -> DataFrame:
    """Fill short gaps by line and weekday mean, long gaps by a decaying last value.

    Series of at most 14 rows use the bare line, over the first ``limit`` rows of
    every gap, and only if they have a short gap. What is still missing at the
    start of a series with a long gap takes the next filled value.
    """
    x, keep, own = F.col(spec.target), df.columns, whole(spec)
    df = gap_runs(df, spec)
    weekday = F.weekday(spec.ts)
    df = df.withColumns({
        "_small": x.isNull() & (F.col("gap_run") <= limit),
        "_large": x.isNull() & (F.col("gap_run") > limit),
        "_since": F.col("_pos") - F.col("_prev.pos"),
        "_weekday_mean": F.element_at(F.array(*[F.avg(F.when(weekday == d, x)).over(own) for d in range(7)]), weekday + 1),
    })
    df = df.withColumns({
        "_any_small": F.max("_small").over(own), "_any_large": F.max("_large").over(own),
        "_line": _straight_line(),
        # value and line at the limit-th row of the gap, carried through the rest of a long gap
        "_line_end": F.when(F.col("_next").isNull(), F.col("_prev.value")).otherwise(
            F.col("_prev.value") + (F.col("_next.value") - F.col("_prev.value"))
            * F.try_divide(F.lit(limit), F.col("_next.pos") - F.col("_prev.pos"))),
    })
    long_series = F.col("_n") > SHORT_SERIES
    blended = BLEND * F.col("_line") + (1 - BLEND) * F.col("_weekday_mean")
    lined = ~long_series & F.col("_any_small")
    carried = (F.when(lined & (F.col("_since") <= limit), F.col("_line"))
               .when(lined, F.col("_line_end")).otherwise(F.col("_prev.value")))
    df = df.withColumn("_filled", (
        F.when(x.isNotNull(), x)
        .when(F.col("_small"), F.when(long_series, blended).otherwise(F.col("_line")))
        .otherwise(carried * F.pow(F.lit(DECAY), F.col("_since")))))
    ahead = F.last("_filled", ignorenulls=True).over(in_reverse(spec).rowsBetween(UNB, CUR))
    df = df.withColumn("_filled", F.coalesce("_filled", F.when(F.col("_any_large"), ahead)))
    return df.withColumn(spec.target, F.col("_filled")).select(*keep)


def impute_ffill(df: DataFrame, spec: PanelSpec, limit: int | None = None) -> DataFrame:
    """Carry the last value forward for up to ``limit`` rows, then the next value backward."""
    keep = df.columns
    df = gap_runs(df, spec)
    near = F.col("_prev.value") if limit is None else F.when(
        F.col("_pos") - F.col("_prev.pos") <= limit, F.col("_prev.value"))
    return df.withColumn(spec.target, F.coalesce(spec.target, near, F.col("_next.value"))).select(*keep)


def impute_zero(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.withColumn(spec.target, F.coalesce(spec.target, F.lit(0.0)))


def fill_remaining(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Last resort for what is still missing: the median of the series, then 0."""
    middle = F.percentile(spec.target, F.lit(0.5)).over(whole(spec))
    return df.withColumn(spec.target, F.coalesce(F.col(spec.target), middle, F.lit(0.0)))


def impute(df: DataFrame, spec: PanelSpec, opts: PrepOptions = PrepOptions()) -> DataFrame:
    if opts.missing == "interpolate":
        df = impute_interpolate(df, spec, opts.limit)
    elif opts.missing == "forward_fill":
        df = impute_ffill(df, spec, opts.limit)
    elif opts.missing == "zero_fill":
        df = impute_zero(df, spec)
    return fill_remaining(df, spec)


def _with_bounds(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add the series' clip bounds ``_lo, _hi`` and the promotion bound ``_hi_promo`` (else ``_hi``)."""
    x, own = F.col(spec.target), whole(spec)
    stats = {
        "_q1": F.percentile(x, F.lit(0.25)).over(own), "_q3": F.percentile(x, F.lit(0.75)).over(own),
        "_cv": F.try_divide(F.stddev_samp(x).over(own), F.avg(x).over(own) + 1e-6),
    }
    promo = "promo_flag" in df.columns
    if promo:
        px = F.when(F.col("promo_flag") == 1, x)
        stats |= {"_pq1": F.percentile(px, F.lit(0.25)).over(own), "_pq3": F.percentile(px, F.lit(0.75)).over(own),
                  "_pn": F.count(F.when(F.col("promo_flag") == 1, 1)).over(own)}
    df = df.withColumns(stats)
    width = F.when(F.col("_cv") > 1.5, 2.5).when(F.col("_cv") > 0.8, 2.0).otherwise(1.5) * (F.col("_q3") - F.col("_q1"))
    df = df.withColumns({"_lo": F.greatest(F.lit(0.0), F.col("_q1") - width), "_hi": F.col("_q3") + width})
    promo_hi = F.when(F.col("_pn") > 5, F.col("_pq3") + 1.5 * (F.col("_pq3") - F.col("_pq1"))).otherwise(
        F.col("_hi")) if promo else F.col("_hi")
    return df.withColumn("_hi_promo", promo_hi)


def _clipped(df: DataFrame, spec: PanelSpec) -> DataFrame:
    df = _with_bounds(df, spec)
    top = F.when(F.col("promo_flag") == 1, F.col("_hi_promo")).otherwise(F.col("_hi")) \
        if "promo_flag" in df.columns else F.col("_hi")
    return df.withColumn(spec.target, clip(F.col(spec.target), F.col("_lo"), top))


def clip_outliers(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Clip to quartile bounds whose width follows the series' variability; promotion days
    have their own upper bound once a series has more than five of them."""
    keep = df.columns
    return _clipped(df, spec).select(*keep)


def outlier_counts(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows per series that sit on a (non-promotion) bound after clipping."""
    x = F.col(spec.target)
    return _clipped(df, spec).groupBy(spec.id).agg(
        F.count_if((x == F.col("_lo")) | (x == F.col("_hi"))).alias("n_outliers"))


def remove_outliers(df: DataFrame, spec: PanelSpec, lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Keep the rows inside the series' own quantile band."""
    keep, own = df.columns, whole(spec)
    df = df.withColumns({"_lo": F.percentile(spec.target, F.lit(lower)).over(own),
                         "_hi": F.percentile(spec.target, F.lit(upper)).over(own)})
    return df.where(F.col(spec.target).between(F.col("_lo"), F.col("_hi"))).select(*keep)


def handle_outliers(df: DataFrame, spec: PanelSpec, opts: PrepOptions = PrepOptions()) -> DataFrame:
    if opts.outliers == "clip":
        return clip_outliers(df, spec)
    if opts.outliers == "remove":
        return remove_outliers(df, spec, opts.lower_quantile, opts.upper_quantile)
    return df


def min_history(df: DataFrame, spec: PanelSpec, rows: int = 60) -> DataFrame:
    """Keep series with at least ``rows`` rows. A window, so the series partitioning is reused."""
    return (df.withColumn("_n", F.count(F.lit(1)).over(whole(spec)))
            .where(F.col("_n") >= rows).drop("_n"))


def drop_zero_series(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Keep series that have any positive target."""
    return (df.withColumn("_top", F.max(spec.target).over(whole(spec)))
            .where(F.col("_top") > 0).drop("_top"))


def carry_static(df: DataFrame, spec: PanelSpec, columns: list[str] | None = None) -> DataFrame:
    """Fill missing static values from the previous, then the next known one of the series."""
    cols = [c for c in (columns or spec.static) if c in df.columns]
    w, back = in_order(spec), in_reverse(spec)
    return df.withColumns({c: F.coalesce(
        F.last(c, ignorenulls=True).over(w.rowsBetween(UNB, CUR)),
        F.last(c, ignorenulls=True).over(back.rowsBetween(UNB, CUR))) for c in cols})


def densify(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per series and day over the common date range; new rows are NULL except statics.

    Each observed row emits itself and the missing days up to the next one, so there
    is no series-by-day product to join with: one exchange, shared with the windows
    around it. The common range comes from a one-row scalar subquery. Two rows of a series
    for one day fail the query.
    """
    d, w = spec.ts, in_order(spec)
    statics = [c for c in spec.static if c in df.columns]
    span = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    twice = F.raise_error(F.concat(F.lit(f"two rows for one ({spec.id}, {d}): "), F.col(spec.id).cast("string"),
                                   F.lit(", "), F.col(d).cast("string"))).cast("date")
    rows = carry_static(df, spec, statics).withColumns({
        "_from": F.when(F.lag(d).over(w).isNull(), lo).when(F.lag(d).over(w) == F.col(d), twice).otherwise(F.col(d)),
        "_to": F.coalesce(F.date_sub(F.lead(d).over(w), 1), hi)})
    rows = rows.withColumn("_day", F.explode(F.sequence("_from", "_to")))
    own = F.col("_day") == F.col(d)
    rest = [c for c in df.columns if c not in (spec.id, d, *statics)]
    out = {c: F.col(c) for c in (spec.id, *statics)} | {d: F.col("_day")} | {c: F.when(own, F.col(c)) for c in rest}
    return rows.select(*[out[c].alias(c) for c in df.columns])


def quality_report(raw: DataFrame, imputed: DataFrame, prepared: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row: missing targets before and after imputation, series before and after filtering."""
    missing = F.count_if(F.col(spec.target).isNull())
    no_id = raw.agg(F.count_if(F.col(spec.id).isNull()).alias("n"))
    return raw.where(F.col(spec.id).isNotNull()).agg(
        missing.alias("initial_missing"), F.countDistinct(spec.id).alias("initial_series")).select(
        "initial_missing",
        imputed.agg(missing.alias("n")).scalar().alias("final_missing"),
        "initial_series",
        (F.col("initial_series") - prepared.agg(F.countDistinct(spec.id).alias("n")).scalar()).alias("removed_series"),
        no_id.scalar().alias("rows_without_id"))
