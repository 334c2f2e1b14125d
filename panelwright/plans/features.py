"""The full feature build."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from panelwright import scale
from panelwright.functions import calendar as cal
from panelwright.functions.numeric import with_position
from panelwright.operators import asof as asof_state
from panelwright.operators import cleanup, cross, recent, windows
from panelwright.spec import FeatureOptions, PanelSpec


def raw_features(df: DataFrame, spec: PanelSpec, opts: FeatureOptions = FeatureOptions(),
                 asof: dt.date | None = None) -> DataFrame:
    """All feature columns before cleanup. With ``asof``, statistics of a whole history (trend strength, seasonality,
    promotion effect, decline, volatility, category and subcategory state) see only the days up to it.

    Price ranks and category totals come first, then every per-series window behind one
    exchange on the series id while rows are still narrow, then the remaining group-day
    joins (no exchange when their tables may be broadcast) and the calendar expressions.
    ``df`` is also read once per group-day aggregate, each time with the few columns it
    needs: pass a stored panel when it is expensive to derive.
    """
    source, given = df, df.columns
    tables = cross.peer_tables(source, spec)
    df = cross.peer_inputs(df, spec, source, tables)
    df = with_position(df, spec)
    if "category" in given:
        df = cross.category_dynamics(df, spec)
    df = windows.ewm(df, spec, opts)
    df = windows.change_points(windows.trend(df, spec), spec)
    df = windows.promo_features(df, spec)
    df = recent.volatility(recent.decline(df, spec), spec)
    df = windows.rolling(windows.lags(df, spec, opts), spec, opts)
    df = cal.holiday_neighbours(cal.holiday_distance(df, spec), spec)
    df = cross.peer_joins(df, spec, source, tables)
    # fewer group-days than the limit means fewer groups, too
    df = cross.market_state(windows.seasonality(df, spec, source), spec, source, tables)
    df = cal.fourier_parts(cal.cyclic_parts(cal.calendar_parts(df, spec), spec), spec)
    df = cal.interactions(cal.holiday_flag(df, spec), spec)
    df = df.drop(*[c for c in df.columns if c.startswith("_") and c not in given])
    return df if asof is None else asof_state.with_state(df, spec, asof, source)


def build_features(df: DataFrame, spec: PanelSpec, opts: FeatureOptions = FeatureOptions(),
                   rules: cleanup.CleanupRules | None = None, asof: dt.date | None = None,
                   medians: str = "exact") -> tuple[DataFrame, cleanup.CleanupRules]:
    """Features after cleanup, with the rules used. Without ``rules`` they are fitted here,
    on features written once to the checkpoint folder instead of recomputed per pass; ``medians`` says how, see ``cleanup.fit``."""
    raw = raw_features(df, spec, opts, asof)
    if rules is None:
        raw = scale.written(raw)
        rules = cleanup.fit(raw, spec, medians)
    return cleanup.apply(raw, spec, rules), rules
