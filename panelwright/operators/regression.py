"""One regression over all series on lagged, calendar, promotion and static columns: ridge from mergeable sums, or boosted trees.

All lags reach back at least the horizon, so the same fitted model serves every step. A missing
lag is filled and flagged, so that every series gets its whole horizon. Inputs do not depend on the cut
between past and future, so one pass over the rows gives the sums for the final fit and for
every backtest cut; what does depend on it, the overall mean and the statics' levels, is put in afterwards.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright import scale
from panelwright.functions import calendar as cal
from panelwright.functions.numeric import in_order, in_reverse
from panelwright.operators.frames import future_days, last_rows, with_planned_promo
from panelwright.operators.least_squares import cross_sums, ridge
from panelwright.spec import ForecastOptions, PanelSpec

NAME = "global_regression"
PLANNED = ("promo_flag", "promo_discount", "special_event")
# Rows of a category that count as much as the mean of all rows.
PRIOR_ROWS = 20
# Weight of the squared coefficients of standardised inputs.
PENALTY = 0.001


@dataclass(frozen=True)
class GlobalModel:
    """``coefficients`` by input and the intercept, or fitted ``stages`` of trees; the mean target by value of each static
    column (``small``: few enough to broadcast), the mean of all, and the horizon."""

    encodings: dict[str, DataFrame]
    overall: float
    horizon: int
    small: bool = False
    coefficients: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0
    stages: PipelineModel | None = None


def reach(horizon: int) -> int:
    """Rows before a day that its inputs are made from."""
    return 2 * horizon + 28


def lag_names(horizon: int) -> list[str]:
    return [*[f"back_{k}" for k in (horizon, horizon + 7, horizon + 14)], "mean_7", "mean_28"]


def lagged_inputs(df: DataFrame, spec: PanelSpec, horizon: int, overall: float | None = None) -> tuple[DataFrame, list[str]]:
    """Add regression inputs; returns the frame and the input names.

    With ``overall``, a missing lag or mean becomes the series' mean over the rows in reach or,
    without any (``no_history``), ``overall``; ``<lag>_missing`` marks it.
    """
    w, x = in_order(spec), F.col(spec.target)
    lags = {f"back_{k}": F.lag(x, k).over(w) for k in (horizon, horizon + 7, horizon + 14)}
    lags |= {f"mean_{n}": F.avg(x).over(w.rowsBetween(-horizon - n + 1, -horizon)) for n in (7, 28)}
    df = df.withColumns(lags | {"_level": F.avg(x).over(w.rowsBetween(-reach(horizon), -horizon))})
    names = list(lags)
    if overall is not None:
        filled = {c: F.coalesce(c, "_level", F.lit(overall)) for c in lags}
        df = df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in lags} | {"no_history": F.col("_level").isNull().cast("int")}).withColumns(filled)
        names += [f"{c}_missing" for c in lags]
    for step in (cal.calendar_parts, cal.cyclic_parts, cal.fourier_parts, cal.holiday_flag):
        df = step(df, spec)
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) if c in df.columns else F.lit(0) for c in PLANNED})
    df = cal.interactions(df, spec).drop("_level")
    known = [c for c in spec.known if c in df.columns and c not in names]
    return df, [*names, *dict.fromkeys([*known, *PLANNED])]


def _encode(df: DataFrame, encodings: dict[str, DataFrame], overall: float, small: bool = False) -> tuple[DataFrame, list[str]]:
    for c, table in encodings.items():
        df = scale.attach(df, table, [c], small=small).withColumn(f"{c}_level", F.coalesce(f"{c}_level", F.lit(overall)))
    return df, [f"{c}_level" for c in encodings]


def _levels(sums: DataFrame, statics: list[str], overall: list[float]) -> tuple[list[dict[str, DataFrame]], bool]:
    """Mean target by value of each static column, drawn to the overall mean where the value is rare: a table by column for each cut,
    and whether all of them are small. ``sums`` has the statics, ``_cut``, rows ``_n`` and the target's sum ``_y``."""
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in statics])).alias("one")
    mean = F.element_at(F.array(*[F.lit(m) for m in overall]), F.col("_cut") + 1)
    table = scale.written(sums.select("_cut", "_n", "_y", one).select("_cut", "_n", "_y", "one.*").where("value IS NOT NULL").groupBy("_cut", "column", "value").agg(
        F.sum("_n").alias("_n"), F.sum("_y").alias("_y")).select("_cut", "column", "value", ((F.col("_y") + PRIOR_ROWS * mean) / (F.col("_n") + PRIOR_ROWS)).alias("level")))
    small = table.count() <= scale.BROADCAST_ROWS
    return [{c: table.where((F.col("_cut") == k) & (F.col("column") == c)).select(F.col("value").cast(sums.schema[c].dataType).alias(c), F.col("level").alias(f"{c}_level"))
             for c in statics} for k in range(len(overall))], small


def inputs_table(train: DataFrame, spec: PanelSpec, horizon: int) -> tuple[DataFrame, list[str]]:
    """Inputs of all rows, written, with ``_back`` (1 on a series' last row); a lag without history is 0 where ``no_history`` is 1."""
    rows, names = lagged_inputs(train.withColumn("_back", F.row_number().over(in_reverse(spec))), spec, horizon, 0.0)
    statics = [c for c in spec.static if c in train.columns]
    return scale.written(rows.select(*dict.fromkeys([spec.id, spec.ts, *statics, spec.target, "_back", *names, "no_history"]))), names


def fit_cuts(table: DataFrame, names: list[str], spec: PanelSpec, horizon: int, cuts: list[int]) -> list[GlobalModel]:
    """One ridge regression for each cut, on the rows more than ``cut`` rows before the end of their series. ``cuts`` ascend."""
    y, statics = spec.target, [c for c in spec.static if c in table.columns]
    segment = sum(((F.col("_back") > c).cast("int") for c in cuts), F.lit(0))
    rows = table.where(F.col(y).isNotNull()).withColumns({"_segment": segment, "_one": F.lit(1.0)}).where("_segment > 0")
    base = ["_one", *names, "no_history", y]
    sums = cross_sums(rows, base, base, "_segment")
    seen = [sum((m for s, m in sums.items() if s > k), np.zeros((len(base), len(base)))) for k in range(len(cuts))]
    overall = [float(m[0, -1] / m[0, 0]) if m[0, 0] else 0.0 for m in seen]
    # columns of 1, inputs, target: a lag without history takes the overall mean
    turns = [np.delete(np.eye(len(base)), len(base) - 2, axis=1) for _ in cuts]
    for mean, turn in zip(overall, turns, strict=True):
        turn[len(base) - 2, [base.index(c) for c in lag_names(horizon)]] = mean
    moments = [t.T @ m @ t for m, t in zip(seen, turns, strict=True)]
    levels, encodings, small = [], [{} for _ in cuts], True
    if statics:
        # sums by the tuple of statics, which levels are multiplied with once they are known
        groups = scale.written(rows.groupBy(*statics, "_segment").agg(*[F.sum(F.col(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(base)]))
        by_cut = groups.withColumn("_cut", F.explode(F.sequence(F.lit(0), F.col("_segment") - 1)))
        encodings, small = _levels(by_cut.select(*statics, "_cut", F.col("_s0").alias("_n"), F.col(f"_s{len(base) - 1}").alias("_y")), statics, overall)
        placed = None
        for k in range(len(cuts)):
            part, levels = _encode(by_cut.where(F.col("_cut") == k), encodings[k], overall[k], small)
            placed = part if placed is None else placed.unionByName(part)
        placed = placed.withColumns({f"_n_{c}": F.col(c) * F.col("_s0") for c in levels})
        beside = cross_sums(placed, levels, [*[f"_s{i}" for i in range(len(base))], *[f"_n_{c}" for c in levels]], "_cut")
        none = np.zeros((len(levels), len(base) + len(levels)))
        for k, turn in enumerate(turns):
            with_base, among = np.split(beside.get(k, none), [len(base)], axis=1)
            with_base = with_base @ turn
            m = moments[k]
            moments[k] = np.block([[m[:-1, :-1], with_base[:, :-1].T, m[:-1, -1:]], [with_base[:, :-1], among, with_base[:, -1:]],
                                   [m[-1:, :-1], with_base[:, -1:].T, m[-1:, -1:]]])
    models = []
    for k in range(len(cuts)):
        intercept, found = ridge(moments[k], PENALTY)
        models.append(GlobalModel(encodings[k], overall[k], horizon, small, dict(zip([*names, *levels], found.tolist(), strict=True)), intercept))
    return models


def _fit_trees(train: DataFrame, spec: PanelSpec, horizon: int, cut: int) -> GlobalModel:
    rows = train.withColumn("_back", F.row_number().over(in_reverse(spec)))
    usable = (F.col("_back") > cut) & F.col(spec.target).isNotNull()
    overall = rows.where(usable).agg(F.avg(spec.target)).first()[0] or 0.0
    statics = [c for c in spec.static if c in train.columns]
    encodings, small = {}, True
    if statics:
        sums = rows.where(usable).select(*statics, F.lit(0).alias("_cut"), F.lit(1).alias("_n"), F.col(spec.target).alias("_y"))
        (encodings,), small = _levels(sums, statics, [float(overall)])
    rows, inputs = lagged_inputs(rows, spec, horizon, overall)
    rows, levels = _encode(rows.where(usable), encodings, overall, small)
    vector = VectorAssembler(inputCols=[*inputs, *levels], outputCol="inputs")
    last = GBTRegressor(maxIter=10, maxDepth=4, seed=7, featuresCol="inputs", labelCol=spec.target, predictionCol="mean")
    model = last.fit(vector.transform(rows).select("inputs", spec.target))
    return GlobalModel(encodings, float(overall), horizon, small, stages=PipelineModel([vector, model]))


def fit_global(train: DataFrame, spec: PanelSpec, horizon: int = 14, kind: str = "linear", cut: int = 0) -> GlobalModel:
    """Fit ``linear`` or ``trees`` on the rows that have a target and lie more than ``cut`` rows before the end of their series."""
    if kind == "trees":
        return _fit_trees(train, spec, horizon, cut)
    if kind != "linear":
        raise ValueError(f"unknown kind {kind!r}: linear or trees")
    table, names = inputs_table(train, spec, horizon)
    return fit_cuts(table, names, spec, horizon, [cut])[0]


def _mean(model: GlobalModel) -> Column:
    """The linear model's value. Levels and filled lags must be there."""
    return sum((F.lit(b) * F.col(c) for c, b in model.coefficients.items() if b), F.lit(model.intercept))


def encoded_inputs(model: GlobalModel, rows: DataFrame, filled: bool = True) -> DataFrame:
    """``rows`` of ``lagged_inputs`` with the model's levels; lags that were filled with 0 take its overall mean."""
    if not filled:
        rows = rows.withColumns({c: F.col(c) + F.lit(model.overall) * F.col("no_history") for c in lag_names(model.horizon)})
    return _encode(rows, model.encodings, model.overall, model.small)[0]


def _valued(model: GlobalModel, rows: DataFrame) -> DataFrame:
    """Add ``mean`` to encoded inputs."""
    return model.stages.transform(rows) if model.stages else rows.withColumn("mean", _mean(model))


def future_rows(df: DataFrame, spec: PanelSpec, horizon: int, promo: DataFrame | None = None) -> DataFrame:
    """The tail of each series that the inputs reach, and below it the future days with their ``step``."""
    statics = [c for c in spec.static if c in df.columns]
    tail = last_rows(df, spec, reach(horizon))
    planned = [c for c in PLANNED if c in df.columns]
    known = tail.groupBy(spec.id).agg(F.count(F.lit(1)).alias("_n"), *[F.max_by(c, spec.ts).alias(c) for c in statics]).drop("_n")
    ahead = with_planned_promo(future_days(tail, spec, horizon), promo, spec)
    return tail.select(spec.id, spec.ts, spec.target, *planned).unionByName(
        ahead.select(spec.id, spec.ts, "step", *PLANNED), allowMissingColumns=True).join(known, spec.id)


def predict_global(model: GlobalModel, df: DataFrame, spec: PanelSpec, promo: DataFrame | None = None) -> DataFrame:
    """Forecast the days after each series' last one: ``id, ts, step, mean``, ``horizon`` rows for every series."""
    rows, _ = lagged_inputs(future_rows(df, spec, model.horizon, promo), spec, model.horizon, model.overall)
    return _valued(model, encoded_inputs(model, rows.where(F.col("step").isNotNull()))).select(spec.id, spec.ts, "step", "mean")


def _windows(models: list[GlobalModel], table: DataFrame, spec: PanelSpec, opts: ForecastOptions) -> DataFrame:
    out = None
    for k, model in enumerate(models):
        end = k * opts.val_step
        rows = table.where(F.col("_back").between(end + 1, end + opts.horizon))
        ahead = _valued(model, encoded_inputs(model, rows, filled=False)).select(spec.id, F.lit(k).alias("window_no"), spec.ts, F.col("mean").alias(NAME))
        out = ahead if out is None else out.unionByName(ahead)
    return out


def fit_and_backtest(train: DataFrame, spec: PanelSpec, opts: ForecastOptions = ForecastOptions(), kind: str = "linear") -> tuple[GlobalModel, DataFrame]:
    """The model of all rows, and ``id, window_no, ts`` with the forecast ahead of every rolling-origin cut, each by a model
    of the rows up to its cut. Lags of at least the horizon never look past a cut."""
    table, names = inputs_table(train, spec, opts.horizon)
    cuts = [k * opts.val_step + opts.horizon for k in range(opts.val_windows)]
    if kind == "trees":     # trees have no mergeable sums: the few cuts are fitted one after the other
        models = [_fit_trees(train, spec, opts.horizon, cut) for cut in [0, *cuts]]
    else:
        models = fit_cuts(table, names, spec, opts.horizon, [0, *cuts])
    return models[0], _windows(models[1:], table, spec, opts)


def backtest_global(train: DataFrame, spec: PanelSpec, opts: ForecastOptions = ForecastOptions(), kind: str = "linear") -> DataFrame:
    """The backtest of ``fit_and_backtest``."""
    return fit_and_backtest(train, spec, opts, kind)[1]


def permutation_importance(model: GlobalModel, df: DataFrame, spec: PanelSpec, top: int | None = 20, rows: int | None = None, seed: int = 7) -> DataFrame:
    """``feature, importance``: by how much the mean absolute error over the last ``rows`` rows (default: the horizon) of every series
    grows when the input's values are dealt anew, largest first.

    All rows are put in the order of a hash of seed, series and day, and each takes the values of the next one, the last one those of
    the first: a random permutation that does not depend on the partitioning. Every input is permuted alone, and all of them are scored in one
    pass. Rows without a target are left out; without rows there is no importance.
    """
    table, _ = inputs_table(df, spec, model.horizon)
    wanted = table.where((F.col("_back") <= (model.horizon if rows is None else rows)) & F.col(spec.target).isNotNull())
    chosen = _valued(model, encoded_inputs(model, wanted, filled=False))
    names = model.stages.stages[0].getInputCols() if model.stages else list(model.coefficients)
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(spec.id).cast("string"), F.col(spec.ts).cast("string")))
    placed = scale.numbered(chosen.select(key.alias("_key"), spec.id, spec.ts, F.col(spec.target).alias("_y"), "mean", *names), ["_key", spec.id, spec.ts], "_place")
    n = placed.count()
    other = placed.select(F.pmod(F.col("_place") - 1, F.lit(max(1, n))).alias("_place"), *[F.col(c).alias(f"_other_{i}") for i, c in enumerate(names)])
    both = placed.join(other, "_place")
    error = F.abs(F.col("_y") - F.col("mean"))
    if model.stages:
        both = both.withColumn("_f", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1)))).withColumnRenamed("mean", "_base")
        swapped = both.select("_f", "_y", "_base", *[F.when(F.col("_f") == i, F.col(f"_other_{i}")).otherwise(F.col(c)).alias(c) for i, c in enumerate(names)])
        grown = F.avg(F.abs(F.col("_y") - F.col("mean")) - F.abs(F.col("_y") - F.col("_base")))
        feature = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("_f") + 1)
        out = model.stages.transform(swapped).groupBy("_f").agg(grown.alias("importance")).select(feature.alias("feature"), "importance")
    else:
        grown = [F.avg(F.abs(F.col("_y") - F.col("mean") - F.lit(model.coefficients[c]) * (F.col(f"_other_{i}") - F.col(c))) - error) for i, c in enumerate(names)]
        one = both.agg(F.array(*[F.struct(F.lit(c).alias("feature"), g.alias("importance")) for c, g in zip(names, grown)]).alias("all"))
        out = one.select(F.explode("all").alias("one")).select("one.feature", "one.importance").where("importance IS NOT NULL")
    out = out.orderBy(F.desc("importance"), "feature")
    return out if top is None else out.limit(top)


def feature_importance(model: GlobalModel, top: int = 20) -> DataFrame:
    """``feature, importance`` without data: the share of splits' gain in a tree model, absolute coefficients of a linear one."""
    if model.stages:
        vector, last = model.stages.stages
        scores = dict(zip(vector.getInputCols(), last.featureImportances.toArray()))
    else:
        scores = {c: abs(b) for c, b in model.coefficients.items()}
    rows = [(name, float(score)) for name, score in scores.items()]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(top)


def save_model(model: GlobalModel, path: str) -> None:
    if model.stages:
        model.stages.write().overwrite().save(f"{path}/stages")
    for c, table in model.encodings.items():
        table.write.mode("overwrite").parquet(f"{path}/levels-{c}")
    about = json.dumps({"statics": list(model.encodings), "overall": model.overall, "horizon": model.horizon, "small": model.small, "trees": model.stages is not None,
                        "coefficients": model.coefficients, "intercept": model.intercept})
    SparkSession.active().createDataFrame([(about,)], "about string").write.mode("overwrite").text(f"{path}/about")


def load_model(path: str) -> GlobalModel:
    spark = SparkSession.active()
    about = json.loads(spark.read.text(f"{path}/about", wholetext=True).first()[0])
    return GlobalModel({c: spark.read.parquet(f"{path}/levels-{c}") for c in about["statics"]}, about["overall"], about["horizon"],
                       about["small"], about["coefficients"], about["intercept"], PipelineModel.load(f"{path}/stages") if about["trees"] else None)
