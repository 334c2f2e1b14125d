"""Typed settings: which columns play which role, and how each stage behaves."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

# Column names of the public data contract, in contract order.
KNOWN_COVARIATES = (
    "day_of_week", "day_of_month", "month", "quarter", "week_of_year", "year",
    "day_of_year", "is_weekend", "is_month_start", "is_month_end",
    "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos",
    "is_holiday", "days_to_holiday", "is_pre_holiday", "is_post_holiday",
    "weekend_month_interaction", "holiday_weekend_interaction",
    "promo_flag", "promo_discount", "special_event",
    "promo_dow_interaction", "promo_weekend_interaction",
    "day_of_year_sin_weekly", "day_of_year_cos_weekly",
    "day_of_year_sin_monthly", "day_of_year_cos_monthly",
    "day_of_year_sin_quarterly", "day_of_year_cos_quarterly",
)
STATIC_COLUMNS = ("category", "subcategory", "brand", "product_group")

# strftime directives that can occur in a day-grain format, as Spark pattern letters
_STRFTIME = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%b": "MMM",
             "%B": "MMMM", "%j": "DDD", "%H": "HH", "%M": "mm", "%S": "ss"}


def spark_pattern(fmt: str | None) -> str | None:
    """Translate a strftime format such as ``%Y-%m-%d`` into a Spark date pattern."""
    if fmt is None:
        return None
    for directive, letters in _STRFTIME.items():
        fmt = fmt.replace(directive, letters)
    if "%" in fmt:
        raise ValueError(f"unsupported date directive in {fmt!r}")
    return fmt


@dataclass(frozen=True)
class PanelSpec:
    """Column roles of a long panel: one row per series (``id``) and day (``ts``)."""

    id: str = "sku"
    ts: str = "date"
    target: str = "sales"
    static: tuple[str, ...] = STATIC_COLUMNS
    known: tuple[str, ...] = KNOWN_COVARIATES
    date_pattern: str | None = "yyyy-MM-dd"


@dataclass(frozen=True)
class PrepOptions:
    missing: str = "interpolate"          # interpolate | forward_fill | zero_fill
    limit: int | None = 7
    outliers: str = "clip"                # clip | remove
    lower_quantile: float = 0.01
    upper_quantile: float = 0.99
    min_history: int = 60
    drop_zero_series: bool = False
    densify_first: bool = False           # fill calendar gaps before imputation
    cleanup_medians: str = "exact"        # exact | sketch (one scan, stated error)


@dataclass(frozen=True)
class FeatureOptions:
    lags: dict[str, tuple[int, ...]] = field(default_factory=lambda: {"sales": (1, 7, 14, 30)})
    rolling: dict[str, tuple[tuple[int, ...], tuple[str, ...]]] = field(
        default_factory=lambda: {"sales": ((7, 14, 30), ("mean", "std", "min", "max"))})
    ewm: dict[str, tuple[int, ...]] = field(default_factory=lambda: {"sales": (7, 14)})


@dataclass(frozen=True)
class ForecastOptions:
    horizon: int = 14
    test_size: int = 14
    val_windows: int = 2
    val_step: int = 14
    quantiles: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9)
    over_penalty: float = 1.5
    under_penalty: float = 1.0
    ensemble: bool = True
    ensemble_method: str = "selection"    # selection (greedy, with replacement) or inverse_error
    ensemble_rounds: int = 20
    eval_metric: str = "mae"              # what models are ranked by: mae, rmse, wape or cost
    use_cost: bool = False                # publish the level that costs least instead of the mean
    global_model: bool = True             # fit the regression over all series, too


@dataclass(frozen=True)
class Settings:
    panel: PanelSpec = PanelSpec()
    prep: PrepOptions = PrepOptions()
    features: FeatureOptions = FeatureOptions()
    forecast: ForecastOptions = ForecastOptions()
    paths: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def from_json(path: str) -> "Settings":
        with open(path) as handle:
            return Settings.from_dict(json.load(handle))

    @staticmethod
    def from_dict(cfg: dict) -> "Settings":
        """Build settings from a nested options mapping; absent keys keep their defaults."""
        data, feats = cfg.get("data", {}), cfg.get("features", {})
        prep, model = cfg.get("preprocessing", {}), cfg.get("model", {})
        missing, outliers = prep.get("handle_missing", {}), prep.get("handle_outliers", {})
        penalty = model.get("asymmetric_loss", {})
        d_panel, d_prep, d_fc, d_feat = PanelSpec(), PrepOptions(), ForecastOptions(), FeatureOptions()

        panel = PanelSpec(
            id=data.get("id_column", d_panel.id),
            ts=data.get("timestamp_column", d_panel.ts),
            target=data.get("target_column", d_panel.target),
            static=tuple(feats.get("static_features", d_panel.static)),
            known=tuple(feats.get("known_covariates", d_panel.known)),
            date_pattern=spark_pattern(data.get("datetime_format")),
        )
        options = PrepOptions(
            missing=missing.get("method", d_prep.missing),
            limit=missing.get("limit", 7 if missing.get("method") != "forward_fill" else None),
            outliers=outliers.get("method", d_prep.outliers),
            lower_quantile=outliers.get("lower_quantile", d_prep.lower_quantile),
            upper_quantile=outliers.get("upper_quantile", d_prep.upper_quantile),
            min_history=prep.get("min_history_length", d_prep.min_history),
            drop_zero_series=prep.get("remove_zero_sales_skus", d_prep.drop_zero_series),
            cleanup_medians=prep.get("cleanup_medians", d_prep.cleanup_medians),
        )
        features = FeatureOptions(
            lags={c: tuple(v) for c, v in feats.get("lag_features", d_feat.lags).items()},
            rolling={c: (tuple(v["windows"]), tuple(v["functions"]))
                     for c, v in feats["rolling_features"].items()}
            if "rolling_features" in feats else d_feat.rolling,
            ewm={c: tuple(v["spans"]) for c, v in feats["ewm_features"].items()}
            if "ewm_features" in feats else d_feat.ewm,
        )
        horizon = model.get("prediction_length", d_fc.horizon)
        forecast = ForecastOptions(
            horizon=horizon,
            test_size=data.get("test_size", horizon),
            val_windows=model.get("num_val_windows", 1),
            val_step=model.get("val_step_size", 1),
            quantiles=tuple(model.get("quantile_levels") or d_fc.quantiles),
            over_penalty=penalty.get("over_penalty_factor", d_fc.over_penalty),
            under_penalty=penalty.get("under_penalty_factor", d_fc.under_penalty),
            ensemble=model.get("enable_ensemble", True),
            ensemble_method=model.get("ensemble_method", d_fc.ensemble_method),
            ensemble_rounds=model.get("ensemble_rounds", d_fc.ensemble_rounds),
            eval_metric="cost" if penalty.get("enabled", bool(penalty)) else str(model.get("eval_metric", d_fc.eval_metric)).lower(),
            use_cost=penalty.get("enabled", bool(penalty)),
            global_model=model.get("global_model", d_fc.global_model),
        )
        paths = {k: v for k, v in {
            "train": data.get("train_path"), "future_promo": data.get("future_promo_path"),
            "model": model.get("save_path"), **cfg.get("output", {})}.items() if v}
        return Settings(panel, options, features, forecast, paths)

    def with_prep(self, **changes) -> "Settings":
        return replace(self, prep=replace(self.prep, **changes))
