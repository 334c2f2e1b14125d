"""All registered queries and their SQL twins."""

from panelwright.catalog import (asof, calendars, cross_series, evaluation, forecasts, preparation, regressions,  # noqa: F401
                                 series_windows)
from panelwright.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
