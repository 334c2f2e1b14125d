"""Calendar, cyclic, Fourier, holiday-distance and event columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.holidays import is_us_holiday
from panelwright.functions.numeric import CUR, UNB, in_order
from panelwright.spec import PanelSpec

# Fourier period names and lengths in days.
FOURIER_PERIODS = {"weekly": 7.0, "monthly": 30.44, "quarterly": 91.31}

# Recurring sale windows as (month, first day, last day).
SALE_WINDOWS = ((1, 1, 7), (2, 12, 14), (3, 15, 17), (6, 1, 3), (8, 20, 25), (11, 24, 27), (12, 24, 26))
# Dated special events.
SPECIAL_EVENT_DATES = ("2022-11-25", "2023-11-24", "2022-12-26", "2023-12-26", "2022-07-04", "2023-07-04")
# Simplified holiday list used as an input flag.
SIMPLE_HOLIDAY_DATES = ("2022-01-01", "2022-07-04", "2022-11-24", "2022-12-25",
                        "2023-01-01", "2023-07-04", "2023-11-23", "2023-12-25")


def _turn(x: Column, period: float) -> Column:
    return F.lit(2 * math.pi) * x / F.lit(period)


def calendar_parts(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Date parts and band flags. ``day_of_week`` is 0 on Monday; weeks are ISO."""
    d = F.col(spec.ts)
    return df.withColumns({
        "day_of_week": F.weekday(d),
        "day_of_month": F.dayofmonth(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "week_of_year": F.weekofyear(d),
        "year": F.year(d),
        "day_of_year": F.dayofyear(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "is_month_start": (F.dayofmonth(d) <= 5).cast("int"),
        "is_month_end": (F.dayofmonth(d) >= 25).cast("int"),
    })


def cyclic_parts(df: DataFrame, spec: PanelSpec) -> DataFrame:
    d = F.col(spec.ts)
    week, year = _turn(F.weekday(d), 7.0), _turn(F.month(d), 12.0)
    return df.withColumns({
        "day_of_week_sin": F.sin(week), "day_of_week_cos": F.cos(week),
        "month_sin": F.sin(year), "month_cos": F.cos(year),
    })


def fourier_parts(df: DataFrame, spec: PanelSpec) -> DataFrame:
    doy = F.dayofyear(spec.ts)
    cols = {}
    for name, period in FOURIER_PERIODS.items():
        cols[f"day_of_year_sin_{name}"] = F.sin(_turn(doy, period))
        cols[f"day_of_year_cos_{name}"] = F.cos(_turn(doy, period))
    return df.withColumns(cols)


def holiday_flag(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``is_holiday``; replaces an input column of that name."""
    return df.withColumn("is_holiday", is_us_holiday(F.col(spec.ts)).cast("int"))


def _nearest(days: DataFrame, day: str, marked: Column) -> DataFrame:
    """Add the closest marked day before and after each row of a one-row-per-day table.

    The single window partition holds one row per calendar day, 366 a year at most.
    """
    forward, backward = Window.partitionBy(F.lit(0)).orderBy(day), Window.partitionBy(F.lit(0)).orderBy(F.desc(day))
    hit = F.when(marked, F.col(day))
    return days.withColumns({
        "_prev": F.last(hit, ignorenulls=True).over(forward.rowsBetween(UNB, CUR)),
        "_next": F.last(hit, ignorenulls=True).over(backward.rowsBetween(UNB, CUR)),
    })


def holiday_distance(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``days_to_holiday``: distance to the nearest holiday among the days present in the data.

    NULL on every row when the data contains no holiday. Works on the distinct
    days (map-side combined) and broadcasts that table back: it has one row per
    calendar day whatever the number of series.
    """
    d = spec.ts
    days = _nearest(df.select(d).where(F.col(d).isNotNull()).distinct(), d, is_us_holiday(F.col(d)))
    days = days.select(d, F.least(F.datediff(d, "_prev"), F.datediff("_next", d)).alias("days_to_holiday"))
    return df.drop("days_to_holiday").join(F.broadcast(days), d, "left")


def holiday_neighbours(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``is_pre_holiday`` on days at distance one; ``is_post_holiday`` is the next row's value."""
    df = df.withColumn("is_pre_holiday", F.coalesce((F.col("days_to_holiday") == 1).cast("int"), F.lit(0)))
    return df.withColumn("is_post_holiday", F.lead("is_pre_holiday", 1, 0).over(in_order(spec)))


def horizon_holiday_distance(df: DataFrame, spec: PanelSpec, margin: int = 30, far: int = 999) -> DataFrame:
    """``days_to_holiday`` for a future frame: holidays up to ``margin`` days around each
    series' own horizon count, ``far`` when there is none."""
    d = spec.ts
    span = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    days = span.select(F.explode(F.sequence(F.date_sub("lo", margin), F.date_add("hi", margin))).alias(d))
    days = _nearest(days, d, is_us_holiday(F.col(d)))
    own = Window.partitionBy(spec.id)
    df = df.join(F.broadcast(days), d, "left").withColumns({
        "_first": F.date_sub(F.min(d).over(own), margin), "_last": F.date_add(F.max(d).over(own), margin)})
    back = F.when(F.col("_prev") >= F.col("_first"), F.datediff(d, "_prev"))
    ahead = F.when(F.col("_next") <= F.col("_last"), F.datediff("_next", d))
    return (df.withColumn("days_to_holiday", F.coalesce(F.least(back, ahead), F.lit(far)))
            .drop("_prev", "_next", "_first", "_last"))


def date_in_list(d: Column, dates: tuple[str, ...]) -> Column:
    """1 on the listed ISO dates, else 0."""
    return d.isin(*[F.to_date(F.lit(v)) for v in dates]).cast("int")


def in_sale_window(d: Column) -> Column:
    """1 inside a recurring month/day sale window, else 0."""
    hit = F.lit(False)
    for month, lo, hi in SALE_WINDOWS:
        hit = hit | ((F.month(d) == month) & F.dayofmonth(d).between(lo, hi))
    return hit.cast("int")


def interactions(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Products of flags; promo and holiday terms only when their inputs exist."""
    cols = {"weekend_month_interaction": F.col("is_weekend") * F.col("month")}
    if "promo_flag" in df.columns:
        cols["promo_dow_interaction"] = F.col("promo_flag") * F.col("day_of_week")
        cols["promo_weekend_interaction"] = F.col("promo_flag") * F.col("is_weekend")
    if "is_holiday" in df.columns:
        cols["holiday_weekend_interaction"] = F.col("is_holiday") * F.col("is_weekend")
    return df.withColumns(cols)
