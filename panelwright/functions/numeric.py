"""Null-safe numeric expressions and the two window specs every operator uses.

NULL is the only missing marker in a panel; NaN and infinities are turned into
NULL at ingest, and only growth rates may carry an infinity until cleanup.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.spec import PanelSpec

UNB, CUR = Window.unboundedPreceding, Window.currentRow


def in_order(spec: PanelSpec, *extra: str):
    """Rows of one series by day. A series holds at most one row per calendar day."""
    return Window.partitionBy(spec.id, *extra).orderBy(spec.ts)


def in_reverse(spec: PanelSpec, *extra: str):
    return Window.partitionBy(spec.id, *extra).orderBy(F.desc(spec.ts))


def whole(spec: PanelSpec, *extra: str):
    return Window.partitionBy(spec.id, *extra)


def clip(x: Column, lo: float | Column | None = None, hi: float | Column | None = None) -> Column:
    """Bound ``x``; NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    y = x
    if lo is not None:
        y = F.greatest(y, F.lit(lo) if not isinstance(lo, Column) else lo)
    if hi is not None:
        y = F.least(y, F.lit(hi) if not isinstance(hi, Column) else hi)
    return F.when(x.isNotNull(), y)


def finite_or_null(x: Column) -> Column:
    return F.when(F.abs(x) < F.lit(math.inf), x)      # NaN orders above infinity


def ratio_change(now: Column, then: Column) -> Column:
    """``now / then - 1`` with 0/0 as NULL and x/0 as a signed infinity."""
    return (F.when(then == 0, F.when(now > 0, F.lit(math.inf)).when(now < 0, F.lit(-math.inf)))
            .otherwise(F.try_divide(now, then) - 1))


def with_growth(df: DataFrame, source: str, steps: dict[str, int], window) -> DataFrame:
    """Add ``{name: relative change over n rows}``; missing values are padded forward first."""
    pad = f"_{source}_padded"
    df = df.withColumn(pad, F.last(source, ignorenulls=True).over(window.rowsBetween(UNB, CUR)))
    return df.withColumns({
        name: ratio_change(F.col(pad), F.lag(pad, n).over(window)) for name, n in steps.items()
    }).drop(pad)


def slope_at(before: Column, x: Column, after: Column, first: Column, last: Column) -> Column:
    """Numerical gradient of a sequence: central inside, one-sided at both ends."""
    return (F.when(first, after - x).when(last, x - before).otherwise((after - before) / 2))


def with_position(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add ``_pos`` (1-based row position) and ``_n`` (rows) of each series, unless present."""
    if "_pos" in df.columns and "_n" in df.columns:
        return df
    return df.withColumns({"_pos": F.row_number().over(in_order(spec)), "_n": F.count(F.lit(1)).over(whole(spec))})
