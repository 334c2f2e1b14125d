"""Train, predict, and train-then-evaluate over a panel."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright import scale
from panelwright.functions.numeric import in_order
from panelwright.operators import cleanup, evaluate, forecast, frames, prepare, regression, report
from panelwright.operators.regression import GlobalModel
from panelwright.plans import state
from panelwright.plans.features import build_features
from panelwright.plans.prepare import prepare_panel
from panelwright.sources import tables
from panelwright.spec import Settings


@dataclass(frozen=True)
class Trained:
    """What prediction needs: cleanup rules, model weights and residual quantiles."""

    rules: cleanup.CleanupRules
    scores: dict[str, float]
    weights: DataFrame
    offsets: DataFrame
    regression: GlobalModel | None = None

    @property
    def models(self) -> tuple[str, ...]:
        return forecast.MODELS + ((regression.NAME,) if self.regression else ())


def cleaned_history(raw: DataFrame, settings: Settings, rules: cleanup.CleanupRules | None = None,
                    panel: DataFrame | None = None) -> tuple[DataFrame, cleanup.CleanupRules]:
    """Prepared and cleaned panel with the columns that forecasting and scoring read: target, planned
    promotions and statics. The other known covariates follow from the date. ``panel`` is the
    prepared panel, where it is at hand.
    """
    spec = settings.panel
    panel = prepare_panel(raw, spec, settings.prep) if panel is None else panel
    needed = [c for c in dict.fromkeys((spec.id, spec.ts, spec.target, *regression.PLANNED, *spec.static)) if c in raw.columns]
    panel = scale.written(panel.select(*needed))
    rules = rules or cleanup.fit(panel, spec, settings.prep.cleanup_medians)
    return scale.written(cleanup.apply(panel, spec, rules)), rules


def train(raw: DataFrame, settings: Settings, panel: DataFrame | None = None) -> Trained:
    """Fit cleanup, score the models on rolling-origin cuts, derive weights and quantiles."""
    history, rules = cleaned_history(raw, settings, panel=panel)
    return _train(history, rules, settings)


def _train(cleaned: DataFrame, rules: cleanup.CleanupRules, settings: Settings) -> Trained:
    spec, opts = settings.panel, settings.forecast
    history, _ = frames.train_test_split(cleaned, spec, opts.test_size)
    history = scale.written(history)
    tested, models, fitted = forecast.backtest(history.select(spec.id, spec.ts, spec.target), spec, opts), forecast.MODELS, None
    if opts.global_model:
        fitted, ahead = regression.fit_and_backtest(history, spec, opts)
        models = (*models, regression.NAME)
        tested = tested.join(ahead, [spec.id, "window_no", spec.ts], "left")
    tested = scale.written(tested)
    scores = scale.written(forecast.leaderboard(tested, models, opts))
    if not opts.ensemble:      # all weight on the best model
        best = scores.orderBy(F.desc("score_val"), "model").limit(1).select("model")
        names = scores.select("model")
        weights = names.join(best.withColumn("weight", F.lit(1.0)), "model", "left").fillna(0.0)
    elif opts.ensemble_method == "selection":
        chosen = forecast.selected_weights(forecast.select_ensemble(tested, models, opts, opts.ensemble_rounds), models)
        weights = tested.sparkSession.createDataFrame(sorted(chosen.items()), "model string, weight double")
    elif opts.ensemble_method == "inverse_error":
        weights = forecast.ensemble_weights(scores)
    else:
        raise ValueError(f"unknown ensemble_method {opts.ensemble_method!r}: selection or inverse_error")
    weights = scale.written(weights)
    blended = forecast.combine(tested, weights, models)
    levels = opts.quantiles + ((forecast.optimal_level(opts),) if opts.use_cost else ())
    offsets = scale.written(forecast.residual_quantiles(blended, ("ensemble",), tuple(dict.fromkeys(levels))))
    return Trained(rules, {r["model"]: r["score_val"] for r in scores.collect()}, weights, offsets, fitted)


def _forecast(history: DataFrame, trained: Trained, settings: Settings, promo: DataFrame | None = None) -> DataFrame:
    spec, opts = settings.panel, settings.forecast
    wide = forecast.point_forecasts(history, spec, opts.horizon)
    if trained.regression:
        ahead = regression.predict_global(trained.regression, history, spec, promo)
        wide = wide.join(ahead.select(spec.id, spec.ts, F.col("mean").alias(regression.NAME)), [spec.id, spec.ts], "left")
    return _blended(wide, trained, settings)


def _blended(wide: DataFrame, trained: Trained, settings: Settings) -> DataFrame:
    """Point forecast and quantiles. Where errors have prices, the point is the quantile that costs least."""
    spec, opts = settings.panel, settings.forecast
    wide = forecast.combine(wide, trained.weights, trained.models)
    long = forecast.to_long(wide.drop(*trained.models), ("ensemble",))
    names = [forecast.quantile_name(q) for q in sorted(opts.quantiles)]
    out = forecast.with_quantiles(long, trained.offsets.select("model", "step", *names), opts.quantiles)
    if opts.use_cost:
        least = trained.offsets.select("model", "step", F.col(forecast.quantile_name(forecast.optimal_level(opts))).alias("_shift"))
        out = out.join(F.broadcast(least), ["model", "step"], "left").withColumn("mean", F.col("mean") + F.coalesce("_shift", F.lit(0.0)))
    return out.select(spec.id, spec.ts, "mean", *names)


def predict(raw: DataFrame, trained: Trained, settings: Settings, promo: DataFrame | None = None) -> DataFrame:
    """Forecast the days after the panel, cleaned with the statistics of training."""
    cleaned, _ = cleaned_history(raw, settings, trained.rules)
    return _forecast(cleaned, trained, settings, promo)


def series_state(cleaned: DataFrame, settings: Settings) -> DataFrame:
    """One row per series of a cleaned history: all that ``predict_from_state`` reads."""
    keep = regression.reach(settings.forecast.horizon) if settings.forecast.global_model else state.TAIL_ROWS
    return state.series_state(cleaned, settings.panel, max(keep, state.TAIL_ROWS))


def advance(held: DataFrame, days: DataFrame, trained: Trained, settings: Settings) -> DataFrame:
    """The state after new days. They are cleaned by the rules of training; bounds and gaps of a series are not fitted anew."""
    keep = regression.reach(settings.forecast.horizon) if settings.forecast.global_model else state.TAIL_ROWS
    return state.merged(held, cleanup.apply(days, settings.panel, trained.rules), settings.panel, max(keep, state.TAIL_ROWS))


def predict_from_state(held: DataFrame, trained: Trained, settings: Settings, promo: DataFrame | None = None) -> DataFrame:
    """Forecast the days after each series' last one from its state, without its history."""
    return _blended(state.forecasts(held, settings.panel, settings.forecast.horizon, trained.regression, promo), trained, settings)


def train_predict(raw: DataFrame, settings: Settings, alignment: str = "date", panel: DataFrame | None = None,
                  promo: DataFrame | None = None) -> dict:
    """Train, forecast and score.

    By ``date``, the held-out days are forecast from the training cut and matched by day, with the promotions
    that were planned for them.
    By ``position``, the forecast continues the whole history and is scored against the
    last held-out rows in order. Returns ``forecast``, ``metrics``, ``report``, ``leaderboard``, the ``aligned``
    rows, chart rows, and what was ``trained``.
    """
    spec, opts = settings.panel, settings.forecast
    cleaned, rules = cleaned_history(raw, settings, panel=panel)
    trained = _train(cleaned, rules, settings)
    held = frames.split_roles(cleaned, spec, opts.test_size)
    history, tests = held.where("role = 'train'").drop("role"), held.where("role = 'holdout'").drop("role")
    planned = [c for c in regression.PLANNED if c in cleaned.columns]
    if alignment == "date" and len(planned) == len(regression.PLANNED):
        promo = tests.select(spec.id, spec.ts, *planned)
    predicted = scale.written(_forecast(history if alignment == "date" else cleaned, trained, settings, promo))
    aligned = evaluate.align(cleaned, predicted, spec, opts.horizon, how=alignment)
    scored = evaluate.metrics(aligned, evaluate.count_series(cleaned, spec))
    if alignment == "date":
        days = tests.withColumn("_rn", F.row_number().over(in_order(spec))).where(F.col("_rn") <= opts.horizon)
        scored = scored.crossJoin(evaluate.unmatched(days, predicted, spec))     # one row beside one row
    spark = raw.sparkSession
    board = spark.createDataFrame(sorted(trained.scores.items()), "model string, score_val double")
    return {"forecast": predicted, "metrics": scored, "leaderboard": board, "aligned": aligned, "trained": trained,
            "holdout_chart": evaluate.holdout_chart(cleaned, predicted, spec, opts.horizon),
            "future_chart": evaluate.future_chart(history, predicted, spec),
            "report": report.metrics_report(scored, trained.models, opts.horizon)}


def save(trained: Trained, spark: SparkSession, path: str) -> None:
    cleanup.save(trained.rules, spark, f"{path}/rules")
    trained.weights.write.mode("overwrite").parquet(f"{path}/weights")
    trained.offsets.write.mode("overwrite").parquet(f"{path}/offsets")
    if trained.regression:
        regression.save_model(trained.regression, f"{path}/regression")
    spark.createDataFrame([(json.dumps(trained.scores),)], "scores string").write.mode("overwrite").text(f"{path}/scores")


def load(spark: SparkSession, path: str) -> Trained:
    scores = json.loads(spark.read.text(f"{path}/scores", wholetext=True).first()[0])
    return Trained(cleanup.load(spark, f"{path}/rules"), scores, spark.read.parquet(f"{path}/weights"),
                   spark.read.parquet(f"{path}/offsets"),
                   regression.load_model(f"{path}/regression") if regression.NAME in scores else None)


def run(spark: SparkSession, settings: Settings, mode: str = "train_predict") -> dict[str, DataFrame]:
    """The three modes over the paths of the settings; writes the artefacts each one produces.

    Both training modes save the model and, where ``state_path`` is given, the state of every series; ``predict`` then reads this state
    and of the panel only the days behind it, and stores the state it has come to. Beside forecast, metrics and report, ``train_predict`` writes the leaderboard, the
    inputs' importance and the chart tables next to the predictions. What is returned is read from what was written.
    """
    if mode not in ("train", "predict", "train_predict"):
        raise ValueError(f"unknown mode {mode!r}")
    with scale.work_tables(spark):
        return _run(spark, settings, mode)


def _run(spark: SparkSession, settings: Settings, mode: str) -> dict[str, DataFrame]:
    paths, spec, panel = settings.paths, settings.panel, None
    raw = tables.read_panel(spark, paths["train"], spec)
    prepare.assert_unique_keys(raw, spec)
    promo = tables.read_future_promo(spark, paths.get("future_promo"), spec)
    if "features_path" in paths:
        panel = scale.written(prepare_panel(raw, spec, settings.prep))
        featured, _ = build_features(panel, spec, settings.features, medians=settings.prep.cleanup_medians)
        tables.write_features(featured, paths["features_path"], spec)
    if mode != "predict" and "state_path" in paths:
        cleaned, _ = cleaned_history(raw, settings, panel=panel)
        _store_state(series_state(cleaned, settings), settings)
    if mode == "train":
        save(train(raw, settings, panel), spark, paths["model"])
        return {}
    if mode == "predict" and "state_path" in paths:
        trained = load(spark, paths["model"])
        held = scale.written(advance(state.stored(spark, paths["state_path"]), raw, trained, settings))
        out = {"forecast": predict_from_state(held, trained, settings, promo)}
        _store_state(held, settings)
    elif mode == "predict":
        out = {"forecast": predict(raw, load(spark, paths["model"]), settings, promo)}
    else:
        out = train_predict(raw, settings, panel=panel, promo=promo)
        trained = out.pop("trained")
        if "model" in paths:
            save(trained, spark, paths["model"])
        metrics_path = paths.get("metrics_path", f"{_stem(paths['predictions_path'])}_metrics.json")
        tables.write_metrics(out["metrics"], metrics_path)
        tables.write_report(out["report"], f"{_stem(metrics_path)}_report.txt")
        beside = {k: out[k] for k in ("leaderboard", "holdout_chart", "future_chart")}
        if trained.regression:
            beside["importance"] = regression.feature_importance(trained.regression)
        for name, table in beside.items():
            tables.write_forecast(table, paths.get(f"{name}_path", f"{_stem(paths['predictions_path'])}_{name}"))
    stored = out["forecast"].schema
    tables.write_forecast(out["forecast"], paths["predictions_path"])
    return {"forecast": spark.read.schema(stored).option("header", True).csv(paths["predictions_path"])}


def _store_state(held: DataFrame, settings: Settings) -> None:
    """In buckets of some ten thousand series."""
    state.store(held, settings.paths["state_path"], settings.panel.id, [], max(1, -(-held.count() // 10_000)))


def _stem(path: str) -> str:
    """A path without the ending of its last part."""
    head, slash, tail = path.rstrip("/").rpartition("/")
    return f"{head}{slash}{tail.rpartition('.')[0] or tail}"
