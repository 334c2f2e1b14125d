"""Demand-series analytics on Spark: preparation, features, backtests, evaluation."""

from panelwright.spec import (FeatureOptions, ForecastOptions, PanelSpec, PrepOptions, Settings)

__all__ = ["FeatureOptions", "ForecastOptions", "PanelSpec", "PrepOptions", "Settings"]
