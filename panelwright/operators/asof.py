"""Full-history statistics as they stood on a day, for feature tables that must not know what came later."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright import scale
from panelwright.operators import cross, recent, windows
from panelwright.spec import PanelSpec

SERIES = ("trend_strength", "historical_promo_effectiveness", "sales_decline_indicator", "consecutive_decline_days",
          "decline_magnitude", "volatility_risk_score")
SEASONS = ("weekly_seasonality", "monthly_seasonality")


def past(df: DataFrame, spec: PanelSpec, asof: dt.date) -> DataFrame:
    return df.where(F.col(spec.ts) <= F.lit(asof))


def series_state(df: DataFrame, spec: PanelSpec, asof: dt.date) -> DataFrame:
    """One row per series with rows up to ``asof``: trend strength, seasonality, promotion effect, decline and volatility."""
    rows = past(df, spec, asof)
    seasons = windows.seasonality_table(rows, spec)
    rows = recent.volatility(recent.decline(windows.trend(rows, spec), spec), spec)
    if "promo_flag" in df.columns:
        rows = windows.promo_effect(rows, spec)
    names = [c for c in SERIES if c in rows.columns]
    last = rows.groupBy(spec.id).agg(F.max_by(F.struct(*names), spec.ts).alias("_s")).select(spec.id, "_s.*")
    return last.join(seasons, spec.id)


def with_state(df: DataFrame, spec: PanelSpec, asof: dt.date, source: DataFrame) -> DataFrame:
    """``df`` with its full-history columns replaced by their values of ``asof``. Series that begin later get 0,
    groups that do 0.5."""
    given, rows = df.columns, past(source, spec, asof)
    state = series_state(source, spec, asof)
    plain = [c for c in state.columns if c != spec.id]
    df = scale.attach_series(df.drop(*plain), state, spec.id).fillna(0, subset=plain)
    for key, table in (("category", cross.category_state_table), ("subcategory", cross.fragmentation_table)):
        if key in source.columns and (key == "category" or "category" in source.columns):
            stats = table(rows, spec)
            names = [c for c in stats.columns if c != key]
            df = scale.attach(df.drop(*names), stats, [key]).fillna(0.5, subset=names)
    return df.select(*given)
