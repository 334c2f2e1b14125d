"""Calendar, Fourier, holiday and event columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog.base import R, SPEC, dense, panel, r, register, rounded
from panelwright.functions import calendar as cal
from panelwright.functions.holidays import is_us_holiday

KEY = ["sku", "date"]
PI2 = "(2 * pi())"


def _int(expr: str, name: str) -> str:
    return f"CAST({expr} AS INTEGER) AS {name}"


@register("calendar_parts", f"""
SELECT sku, date, {_int('isodow(date) - 1', 'day_of_week')}, {_int('day(date)', 'day_of_month')}, {_int('month(date)', 'month')},
       {_int('quarter(date)', 'quarter')}, {_int('week(date)', 'week_of_year')}, {_int('year(date)', 'year')},
       {_int('dayofyear(date)', 'day_of_year')}, {_int('isodow(date) >= 6', 'is_weekend')},
       {_int('day(date) <= 5', 'is_month_start')}, {_int('day(date) >= 25', 'is_month_end')} FROM panel""")
def calendar_parts(spark, sf):
    return cal.calendar_parts(panel(spark, sf).select(*KEY), SPEC)


@register("cyclic_parts", f"""
SELECT sku, date, {R(f'sin({PI2} * (isodow(date) - 1) / 7)')} AS day_of_week_sin, {R(f'cos({PI2} * (isodow(date) - 1) / 7)')} AS day_of_week_cos,
       {R(f'sin({PI2} * month(date) / 12)')} AS month_sin, {R(f'cos({PI2} * month(date) / 12)')} AS month_cos FROM panel""")
def cyclic_parts(spark, sf):
    df = cal.cyclic_parts(panel(spark, sf).select(*KEY), SPEC)
    return df.select(*KEY, *[r(c) for c in df.columns if c not in KEY])


_FOURIER = ", ".join(f"{R(f'{fn}({PI2} * dayofyear(date) / {p})')} AS day_of_year_{fn}_{n}"
                     for n, p in cal.FOURIER_PERIODS.items() for fn in ("sin", "cos"))


@register("fourier_parts", f"SELECT sku, date, {_FOURIER} FROM panel")
def fourier_parts(spark, sf):
    df = cal.fourier_parts(panel(spark, sf).select(*KEY), SPEC)
    return df.select(*KEY, *[r(c) for c in df.columns if c not in KEY])


# Holidays by construction: each rule picks a day per year, weekend dates add their stand-in.
HOLIDAYS_SQL = """
years AS (SELECT unnest(generate_series(1990, 2030)) AS y),
fixed AS (SELECT make_date(y, m, d) AS day FROM years, (VALUES (1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0)) v(m, d, since)
          WHERE y >= since),
nth AS (SELECT make_date(y, m, 1) + CAST((wd - isodow(make_date(y, m, 1)) + 7) % 7 + 7 * (k - 1) AS INTEGER) AS day
        FROM years, (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) v(m, wd, k)),
memorial AS (SELECT make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) AS day FROM years),
holidays AS (SELECT day FROM fixed UNION SELECT day FROM nth UNION SELECT day FROM memorial
             UNION SELECT day - 1 FROM fixed WHERE isodow(day) = 6 UNION SELECT day + 1 FROM fixed WHERE isodow(day) = 7)"""


@register("holiday_flag", f"""
WITH {HOLIDAYS_SQL} SELECT sku, date, CAST(date IN (SELECT day FROM holidays) AS INTEGER) AS is_holiday FROM panel""")
def holiday_flag(spark, sf):
    return cal.holiday_flag(panel(spark, sf).select(*KEY), SPEC)


@register("holiday_days", f"""
WITH {HOLIDAYS_SQL} SELECT DISTINCT date FROM dense WHERE date IN (SELECT day FROM holidays)""")
def holiday_days(spark, sf):
    return dense(spark, sf).select("date").distinct().where(is_us_holiday(F.col("date")))


_DISTANCE = f"""{HOLIDAYS_SQL},
present AS (SELECT DISTINCT date AS day FROM panel WHERE date IN (SELECT day FROM holidays)),
nearest AS (SELECT d.date, CAST(min(abs(date_diff('day', d.date, p.day))) AS INTEGER) AS days_to_holiday
            FROM (SELECT DISTINCT date FROM panel) d, present p GROUP BY d.date)"""


@register("holiday_distance", f"""
WITH {_DISTANCE} SELECT sku, p.date, days_to_holiday FROM panel p JOIN nearest n ON n.date = p.date""")
def holiday_distance(spark, sf):
    return cal.holiday_distance(panel(spark, sf).select(*KEY), SPEC)


@register("holiday_neighbours", f"""
WITH {_DISTANCE}, pre AS (SELECT sku, p.date, CAST(days_to_holiday = 1 AS INTEGER) AS is_pre_holiday
                          FROM panel p JOIN nearest n ON n.date = p.date)
SELECT sku, date, is_pre_holiday, lead(is_pre_holiday, 1, 0) OVER (PARTITION BY sku ORDER BY date) AS is_post_holiday FROM pre""")
def holiday_neighbours(spark, sf):
    return cal.holiday_neighbours(cal.holiday_distance(panel(spark, sf).select(*KEY), SPEC), SPEC).drop("days_to_holiday")


@register("date_list_flag", """
SELECT sku, date, CAST(strftime(date, '%Y-%m-%d') IN ('1996-07-04', '1997-12-25', '2000-01-01') AS INTEGER) AS listed,
       CAST(strftime(date, '%Y-%m-%d') IN ('2022-01-01', '2022-07-04', '2022-11-24', '2022-12-25',
            '2023-01-01', '2023-07-04', '2023-11-23', '2023-12-25') AS INTEGER) AS simple_holiday FROM panel""")
def date_list_flag(spark, sf):
    d = F.col("date")
    return panel(spark, sf).select(*KEY, cal.date_in_list(d, ("1996-07-04", "1997-12-25", "2000-01-01")).alias("listed"),
                                   cal.date_in_list(d, cal.SIMPLE_HOLIDAY_DATES).alias("simple_holiday"))


@register("sale_window_flag", "SELECT sku, date, special_event FROM panel")
def sale_window_flag(spark, sf):
    return panel(spark, sf).select(*KEY, cal.in_sale_window(F.col("date")).alias("special_event"))


@register("special_event_flag", """
SELECT event_id, CAST(strftime(ts + INTERVAL 541 DAY - INTERVAL 1096 DAY, '%Y-%m-%d')
  IN ('2022-11-25', '2023-11-24', '2022-12-26', '2023-12-26', '2022-07-04', '2023-07-04') AS INTEGER) AS special_event FROM events""")
def special_event_flag(spark, sf):
    """Events moved back 555 days, into the span of the dated event list."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    day = F.date_sub(F.col("ts").cast("date"), 555)
    return events.select("event_id", cal.date_in_list(day, cal.SPECIAL_EVENT_DATES).alias("special_event"))


@register("interactions", f"""
SELECT sku, date, {_int('(isodow(date) >= 6)::INT * month(date)', 'weekend_month_interaction')},
       {_int('promo_flag * (isodow(date) - 1)', 'promo_dow_interaction')},
       {_int('promo_flag * (isodow(date) >= 6)::INT', 'promo_weekend_interaction')},
       {_int('special_event * (isodow(date) >= 6)::INT', 'holiday_weekend_interaction')} FROM panel""")
def interactions(spark, sf):
    df = panel(spark, sf).select(*KEY, "promo_flag", F.col("special_event").alias("is_holiday"))
    df = cal.interactions(cal.calendar_parts(df, SPEC), SPEC)
    return df.select(*KEY, *[c for c in df.columns if c.endswith("_interaction")])
