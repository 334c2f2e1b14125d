"""Forecasts as Spark jobs: closed forms per series, rolling-origin backtests, ensembles.

Each closed form needs a handful of sums per series, so fitting all of them for all
validation cuts is one aggregation behind one exchange on the series id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright import scale
from panelwright.functions.numeric import in_reverse
from panelwright.spec import ForecastOptions, PanelSpec

MODELS = ("seasonal_naive", "moving_average", "drift", "trend_weekday")
SEASON = 7
AVERAGE_ROWS = 28


def quantile_name(q: float) -> str:
    return "q_" + f"{q:g}".replace(".", "_")


def _fits(df: DataFrame, spec: PanelSpec, keys: list[str], *more: Column) -> DataFrame:
    """One row of sufficient statistics per key, and the aggregates ``more``. ``_rn`` counts back from 1 on the last
    fitted row; rows with ``_rn`` under 1 lie ahead of it and are not used."""
    rn, x = F.col("_rn"), F.when(F.col("_rn") >= 1, F.col(spec.target))
    t = F.when(rn >= 1, (1 - rn).cast("double"))          # 0 on the last row, so step s is t = s
    weekday = F.weekday(spec.ts)
    aggs = [F.max(F.when(rn == 1, F.col(spec.ts))).alias("_last"),
            F.avg(F.when(rn <= AVERAGE_ROWS, x)).alias("_mean"),
            F.regr_slope(x, t).alias("_b"), F.regr_intercept(x, t).alias("_a")]
    aggs += [F.max(F.when(rn == k, x)).alias(f"_l{k}") for k in range(1, SEASON + 1)]
    for d in range(7):
        on = (weekday == d) & x.isNotNull()
        aggs += [F.avg(F.when(on, x)).alias(f"_x{d}"), F.avg(F.when(on, t)).alias(f"_t{d}")]
    return df.groupBy(*keys).agg(*aggs, *more)


def _predictions() -> dict[str, Column]:
    """Point forecasts at ``step`` from the statistics of :func:`_fits`."""
    step = F.col("step")
    recent = F.array(*[F.col(f"_l{k}") for k in range(SEASON, 0, -1)])
    line = F.col("_a") + F.col("_b") * step
    weekday = F.weekday(F.date_add("_last", step)) + 1
    level = F.element_at(F.array(*[F.col(f"_x{d}") for d in range(7)]), weekday)
    when = F.element_at(F.array(*[F.col(f"_t{d}") for d in range(7)]), weekday)
    return {
        "seasonal_naive": F.coalesce(F.element_at(recent, (step - 1) % SEASON + 1), F.col("_mean")),
        "moving_average": F.col("_mean"),
        "drift": F.coalesce(line, F.col("_mean")),
        # line plus the weekday's mean distance from the line
        "trend_weekday": F.coalesce(line + level - (F.col("_a") + F.col("_b") * when), line, F.col("_mean")),
    }


def point_forecasts(df: DataFrame, spec: PanelSpec, horizon: int = 14) -> DataFrame:
    """``id, ts, step`` and one column per model for the days after each series' last one."""
    fits = _fits(df.withColumn("_rn", F.row_number().over(in_reverse(spec))), spec, [spec.id])
    steps = fits.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.select(spec.id, F.date_add("_last", F.col("step")).alias(spec.ts), "step",
                        *[c.alias(m) for m, c in _predictions().items()])


def to_long(wide: DataFrame, models: tuple[str, ...] = MODELS) -> DataFrame:
    """One row per model: the other columns, ``model`` and ``mean``."""
    others = [c for c in wide.columns if c not in models]
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("mean")) for m in models]))
    return wide.select(*others, pairs.alias("_p")).select(*others, "_p.model", "_p.mean")


def backtest(train: DataFrame, spec: PanelSpec, opts: ForecastOptions = ForecastOptions()) -> DataFrame:
    """Forecasts at every rolling-origin cut next to the actual values.

    ``id, window_no, ts, step, actual`` and one column per model. Rows ahead of a cut
    are matched to steps by row position; every cut reuses the exchange on the series.
    """
    h, numbers = opts.horizon, F.array(*[F.lit(i) for i in range(opts.val_windows)])
    rows = train.withColumn("_back", F.row_number().over(in_reverse(spec))).withColumn("window_no", F.explode(numbers))
    rows = rows.withColumn("_rn", F.col("_back") - F.col("window_no") * opts.val_step - h).where(F.col("_rn") > -h)
    keys = [spec.id, "window_no"]
    ahead = F.collect_list(F.when(F.col("_rn") < 1, F.struct(
        (1 - F.col("_rn")).alias("step"), F.col(spec.ts).alias("day"), F.col(spec.target).alias("actual")))).alias("_ahead")
    fits = _fits(rows, spec, keys, ahead).where(F.col("_last").isNotNull())
    steps = fits.withColumn("_a1", F.explode("_ahead")).withColumn("step", F.col("_a1.step"))
    return steps.select(*keys, F.col("_a1.day").alias(spec.ts), "step", F.col("_a1.actual").alias("actual"),
                        *[c.alias(m) for m, c in _predictions().items()])


def _scored(predicted: Column, actual: Column, opts: ForecastOptions) -> Column:
    """The validation error of a column of forecasts by ``opts.eval_metric``, as an aggregate."""
    error = predicted - actual
    errors = {"mae": F.avg(F.abs(error)), "rmse": F.sqrt(F.avg(error * error)),
              "wape": F.try_divide(F.sum(F.abs(error)), F.sum(F.when(error.isNotNull(), F.abs(actual)))),
              "cost": F.avg(asymmetric_cost(predicted, actual, opts))}
    if opts.eval_metric not in errors:
        raise ValueError(f"unknown eval_metric {opts.eval_metric!r}: one of {', '.join(errors)}")
    return errors[opts.eval_metric]


def leaderboard(tested: DataFrame, models: tuple[str, ...] = MODELS, opts: ForecastOptions = ForecastOptions()) -> DataFrame:
    """``model, score_val``: the negative validation error by ``opts.eval_metric``."""
    return to_long(tested, models).groupBy("model").agg((-_scored(F.col("mean"), F.col("actual"), opts)).alias("score_val"))


def ensemble_weights(scores: DataFrame) -> DataFrame:
    """``model, weight`` inversely proportional to the validation error, summing to 1."""
    raw = F.try_divide(F.lit(1.0), F.greatest(-F.col("score_val"), F.lit(1e-9)))
    total = scores.agg(F.sum(raw).alias("t"))
    return scores.select("model", (raw / total.scalar()).alias("weight"))


def select_ensemble(tested: DataFrame, models: tuple[str, ...] = MODELS, opts: ForecastOptions = ForecastOptions(),
                    rounds: int = 20) -> list[tuple[str, float]]:
    """Greedy forward selection with replacement over stored validation rows: the model chosen in each round and the
    error of the mean of all chosen so far.

    A round tries every model beside those chosen, all in one aggregate, and the driver gets one number for each. Equal errors go to
    the model listed first. Rows where a model has no forecast or no actual value take no part, so that all mixtures are compared on the same rows;
    without such rows nothing is chosen.
    """
    whole = [F.col(m).isNotNull() for m in models]
    rows = tested.where(F.col("actual").isNotNull())
    for w in whole:
        rows = rows.where(w)
    chosen: list[tuple[str, float]] = []
    for k in range(1, rounds + 1):
        held = sum((F.lit(float(n)) * F.col(m) for m in models if (n := [c for c, _ in chosen].count(m))), F.lit(0.0))
        errors = rows.agg(*[_scored((held + F.col(m)) / k, F.col("actual"), opts).alias(m) for m in models]).first()
        known = [(errors[m], i, m) for i, m in enumerate(models) if errors[m] is not None]
        if not known:
            break
        error, _, best = min(known)
        chosen.append((best, float(error)))
    return chosen


def selected_weights(chosen: list[tuple[str, float]], models: tuple[str, ...] = MODELS) -> dict[str, float]:
    """Weights of the selection up to its best round, the earliest of equal ones, so never worse than its first, the best single model."""
    if not chosen:
        return {m: 1.0 / len(models) for m in models}
    upto = min(range(len(chosen)), key=lambda k: chosen[k][1]) + 1
    names = [m for m, _ in chosen[:upto]]
    return {m: names.count(m) / upto for m in models}


def combine(wide: DataFrame, weights: DataFrame, models: tuple[str, ...] = MODELS, name: str = "ensemble") -> DataFrame:
    """Add the weighted mean of the model columns. The weights travel as one small map."""
    table = weights.agg(F.map_from_entries(F.collect_list(F.struct("model", "weight"))).alias("w"))
    wide = wide.withColumn("_w", table.scalar())
    parts = [F.element_at("_w", F.lit(m)) for m in models]
    total = sum((w * F.col(m) for w, m in zip(parts, models)), F.lit(0.0))
    return wide.withColumn(name, total / sum(parts, F.lit(0.0))).drop("_w")


def residual_quantiles(tested: DataFrame, models: tuple[str, ...], quantiles: tuple[float, ...]) -> DataFrame:
    """Quantiles of ``actual - forecast`` per model and step, over all series and cuts."""
    errors = to_long(tested, models).select("model", "step", (F.col("actual") - F.col("mean")).alias("residual"))
    return scale.group_quantiles(errors, ["model", "step"], "residual", {quantile_name(q): q for q in quantiles})


def with_quantiles(forecast: DataFrame, offsets: DataFrame, quantiles: tuple[float, ...]) -> DataFrame:
    """Add one column per quantile: point forecast plus the residual quantile of its model and
    step, sorted so that levels never cross. ``offsets`` has one row per model and step."""
    names = [quantile_name(q) for q in sorted(quantiles)]
    joined = forecast.join(F.broadcast(offsets), ["model", "step"], "left")
    joined = joined.withColumn("_q", F.array_sort(F.array(*[F.col("mean") + F.col(n) for n in names])))
    return joined.select(*forecast.columns, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def asymmetric_cost(predicted: Column, actual: Column, opts: ForecastOptions = ForecastOptions()) -> Column:
    """Cost of a forecast error with separate prices for over- and under-forecasting."""
    return F.greatest(opts.over_penalty * (predicted - actual), opts.under_penalty * (actual - predicted))


def optimal_level(opts: ForecastOptions = ForecastOptions()) -> float:
    """The quantile that minimises the expected asymmetric cost."""
    return opts.under_penalty / (opts.over_penalty + opts.under_penalty)


def cost_board(tested: DataFrame, models: tuple[str, ...] = MODELS, opts: ForecastOptions = ForecastOptions()) -> DataFrame:
    """Mean asymmetric cost per model."""
    return to_long(tested, models).groupBy("model").agg(
        F.avg(asymmetric_cost(F.col("mean"), F.col("actual"), opts)).alias("mean_cost"))
