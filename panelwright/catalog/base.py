"""Registry of runnable queries over the given tables, with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.calendar import SALE_WINDOWS
from panelwright.operators import prepare as prep
from panelwright.sources.retail import daily_panel
from panelwright.spec import PanelSpec

Query = Callable[[SparkSession, str], DataFrame]

SPEC = PanelSpec()
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
BODIES: dict[str, str] = {}      # SQL before the panel is put in front


def register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            BODIES[name], ORACLES[name] = sql, with_panel(sql)
        return fn
    return add


def r(x: Column | str, name: str | None = None, digits: int = 6) -> Column:
    """Round for comparison; the small shift keeps exact decimal ties from splitting engines."""
    c = F.col(x) if isinstance(x, str) else x
    out = F.round(c.cast("double") + 1e-9, digits) + F.lit(0.0)
    return out.alias(name or x) if name or isinstance(x, str) else out


def R(expr: str, digits: int = 6) -> str:
    return f"(round(CAST(({expr}) AS DOUBLE) + 1e-9, {digits}) + 0.0)"


def rounded(*names: str) -> str:
    return ", ".join(f"{R(n)} AS {n}" for n in names)


_SALE = " OR ".join(f"(month(date) = {m} AND day(date) BETWEEN {a} AND {b})" for m, a, b in SALE_WINDOWS)

_PANEL_SQL = f"""
days AS (
  SELECT p_brand AS brand, p_type AS category, CAST(l_shipdate AS DATE) AS date,
         CAST(sum(l_quantity) AS DOUBLE) AS sales, sum(l_extendedprice) / sum(l_quantity) AS price,
         max(l_discount) AS top_discount, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS bn
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
panel AS (
  SELECT brand || '~' || category AS sku, date, sales, category, 'G' || (bn % 5) AS subcategory, brand,
         category || '_' || 'G' || (bn % 5) AS product_group,
         CAST(top_discount >= 0.08 AS INTEGER) AS promo_flag,
         CASE WHEN top_discount >= 0.08 THEN top_discount ELSE 0.0 END AS promo_discount,
         CAST({_SALE} AS INTEGER) AS special_event, price, bn
  FROM days),
gappy AS (
  SELECT * REPLACE (CASE WHEN (date_diff('day', DATE '1970-01-01', date) + bn) % 11 <> 0 THEN sales END AS sales)
  FROM panel),
span AS (SELECT min(date) AS lo, max(date) AS hi FROM panel),
grid AS (
  SELECT sku, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT DISTINCT sku FROM panel), span),
statics AS (SELECT DISTINCT sku, category, subcategory, brand, product_group FROM panel),
dense AS (
  SELECT g.sku, g.date, p.sales, s.category, s.subcategory, s.brand, s.product_group,
         p.promo_flag, p.promo_discount, p.special_event, p.price
  FROM grid g JOIN statics s ON s.sku = g.sku LEFT JOIN gappy p ON p.sku = g.sku AND p.date = g.date)"""


def with_panel(sql: str) -> str:
    """Prefix the shared panel definition; ``sql`` may start with its own ``WITH``."""
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {_PANEL_SQL},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {_PANEL_SQL},\n{body[5:]}"
    return f"WITH {_PANEL_SQL}\n{body}"


def panel(spark: SparkSession, sf: str) -> DataFrame:
    return daily_panel(spark, sf)


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    return daily_panel(spark, sf, gappy=True)


def dense(spark: SparkSession, sf: str) -> DataFrame:
    return prep.densify(gappy(spark, sf), SPEC)
