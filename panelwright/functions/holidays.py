"""United States federal holidays as plain date expressions.

``is_us_holiday`` needs no lookup table: it is a boolean expression of the date,
so it stays inside generated code and costs no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (month, day, first year) of holidays with a fixed date.
FIXED_DATE = ((1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0))
# Fixed values: (month, weekday with Monday = 0, first day, last day, first year).
NTH_WEEKDAY = (
    (1, 0, 15, 21, 1986),    # third Monday of January
    (2, 0, 15, 21, 0),       # third Monday of February
    (5, 0, 25, 31, 0),       # last Monday of May
    (9, 0, 1, 7, 0),         # first Monday of September
    (10, 0, 8, 14, 0),       # second Monday of October
    (11, 3, 22, 28, 0),      # fourth Thursday of November
)


def _on_fixed_date(d: Column) -> Column:
    hit = F.lit(False)
    for month, day, since in FIXED_DATE:
        hit = hit | ((F.month(d) == month) & (F.dayofmonth(d) == day) & (F.year(d) >= since))
    return hit


def is_us_holiday(d: Column) -> Column:
    """True on a holiday, or on the weekday that stands in for one falling on a weekend."""
    hit = _on_fixed_date(d)
    for month, weekday, lo, hi, since in NTH_WEEKDAY:
        hit = hit | ((F.month(d) == month) & (F.weekday(d) == weekday)
                     & F.dayofmonth(d).between(lo, hi) & (F.year(d) >= since))
    friday_before = (F.weekday(d) == 4) & _on_fixed_date(F.date_add(d, 1))
    monday_after = (F.weekday(d) == 0) & _on_fixed_date(F.date_sub(d, 1))
    return hit | friday_before | monday_after


def holiday_days(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Holiday dimension (one ``day`` column) for a range of years."""
    first, last = F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), F.make_date(F.lit(last_year), F.lit(12), F.lit(31))
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("day"))
    return days.where(is_us_holiday(F.col("day")))
