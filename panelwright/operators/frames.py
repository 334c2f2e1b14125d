"""Static tables, splits, validation windows and future covariate frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import calendar as cal
from panelwright.functions.numeric import in_reverse
from panelwright.spec import ForecastOptions, PanelSpec


def static_table(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per series with the first known value of every static column."""
    return df.groupBy(spec.id).agg(*[
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col(spec.ts))).alias(c) for c in spec.static if c in df.columns])


def without_static(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.drop(*[c for c in spec.static if c != spec.id])


def available(df: DataFrame, names: tuple[str, ...] | list[str]) -> list[str]:
    """The requested columns that exist, in the requested order."""
    have = set(df.columns)
    return [c for c in names if c in have]


def last_rows(df: DataFrame, spec: PanelSpec, k: int) -> DataFrame:
    """The last k rows of every series."""
    return df.withColumn("_rn", F.row_number().over(in_reverse(spec))).where(F.col("_rn") <= k).drop("_rn")


def last_days(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.groupBy(spec.id).agg(F.max(spec.ts).alias(f"last_{spec.ts}"))


def first_series(df: DataFrame, spec: PanelSpec, n: int) -> DataFrame:
    """Rows of the first n series by id (a plotting selection)."""
    chosen = df.select(spec.id).distinct().orderBy(spec.id).limit(n)
    return df.join(F.broadcast(chosen), spec.id, "left_semi")


def split_roles(df: DataFrame, spec: PanelSpec, h: int) -> DataFrame:
    """Add ``role``: ``holdout`` on the last h rows of each series, ``train`` before."""
    return (df.withColumn("_rn", F.row_number().over(in_reverse(spec)))
            .withColumn("role", F.when(F.col("_rn") > h, "train").otherwise("holdout")).drop("_rn"))


def train_test_split(df: DataFrame, spec: PanelSpec, h: int) -> tuple[DataFrame, DataFrame]:
    """Training rows (all but the last h of each series) and the test panel (all rows)."""
    return split_roles(df, spec, h).where("role = 'train'").drop("role"), df


def validation_windows(df: DataFrame, spec: PanelSpec, opts: ForecastOptions = ForecastOptions()) -> DataFrame:
    """Rolling-origin windows over a training panel.

    Adds ``window_no`` (0 is the latest cut), ``role`` (train / valid) and ``step``
    (1..horizon on valid rows). Cut i lies ``i * val_step`` rows before the end. A row
    is copied once per window it takes part in, a fixed small number.
    """
    rn = F.col("_rn")
    numbers = F.array(*[F.lit(i) for i in range(opts.val_windows)])
    df = df.withColumn("_rn", F.row_number().over(in_reverse(spec))).withColumn("window_no", F.explode(numbers))
    ahead = rn - F.col("window_no") * opts.val_step          # rows before this window's end, 1-based
    return (df.withColumn("_ahead", ahead).where(F.col("_ahead") >= 1)
            .withColumn("role", F.when(F.col("_ahead") <= opts.horizon, "valid").otherwise("train"))
            .withColumn("step", F.when(F.col("_ahead") <= opts.horizon, F.lit(opts.horizon + 1) - F.col("_ahead")))
            .drop("_rn", "_ahead"))


def future_days(df: DataFrame, spec: PanelSpec, horizon: int) -> DataFrame:
    """One row per series and future day: the ``horizon`` days after its last one, with ``step``."""
    last = df.groupBy(spec.id).agg(F.max(spec.ts).alias("_last"))
    steps = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.select(spec.id, F.date_add("_last", F.col("step")).alias(spec.ts), "step")


def with_planned_promo(frame: DataFrame, promo: DataFrame | None, spec: PanelSpec) -> DataFrame:
    """Planned promotions by series and day; days without a plan get no promotion."""
    defaults = {"promo_flag": F.lit(0), "promo_discount": F.lit(0.0), "special_event": F.lit(0)}
    if promo is None:
        return frame.withColumns(defaults)
    plan = promo.select(spec.id, spec.ts, *defaults)
    return frame.join(plan, [spec.id, spec.ts], "left").withColumns({
        c: F.coalesce(F.col(c), v) for c, v in defaults.items()})


def future_frame(df: DataFrame, spec: PanelSpec, horizon: int = 14, promo: DataFrame | None = None,
                 names: tuple[str, ...] | None = None) -> DataFrame:
    """Known covariates of the days after each series' last one."""
    frame = future_days(df, spec, horizon).drop("step")
    for step in (cal.calendar_parts, cal.cyclic_parts, cal.fourier_parts, cal.holiday_flag,
                 cal.horizon_holiday_distance, cal.holiday_neighbours):
        frame = step(frame, spec)
    frame = cal.interactions(with_planned_promo(frame, promo, spec), spec)
    return frame.select(spec.id, spec.ts, *available(frame, names or spec.known))
