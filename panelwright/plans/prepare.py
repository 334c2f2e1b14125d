"""The preparation chain in its fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelwright.operators import prepare as prep
from panelwright.spec import PanelSpec, PrepOptions


def prepare_panel(df: DataFrame, spec: PanelSpec, opts: PrepOptions = PrepOptions()) -> DataFrame:
    """Impute, treat outliers, drop short (and all-zero) series, fill the calendar.

    Targets of days added by the last step stay missing until feature cleanup. With
    ``densify_first`` the calendar is filled before imputation instead.
    """
    if opts.densify_first:
        df = prep.densify(df, spec)
    df = prep.handle_outliers(prep.impute(df, spec, opts), spec, opts)
    df = prep.min_history(df, spec, opts.min_history)
    if opts.drop_zero_series:
        df = prep.drop_zero_series(df, spec)
    return df if opts.densify_first else prep.densify(df, spec)
