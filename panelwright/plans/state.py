"""What forecasting needs of a series' history in one row, and panels stored so that no window over a series shuffles.

The closed forms need sums, the regression the last rows. Both are kept for each series, new days are merged into
them, and a forecast reads these rows alone, however long the history is.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.numeric import in_order, in_reverse
from panelwright.operators import forecast, regression
from panelwright.operators.frames import with_planned_promo
from panelwright.spec import PanelSpec

# Rows kept of a series where no regression asks for more: the season and the average of the closed forms need this many.
TAIL_ROWS = 28
_SUMS = ("n_x", "s_k", "s_kk", "s_x", "s_kx")
_BY_WEEKDAY = ("w_n", "w_x", "w_k")


def store(df: DataFrame, path: str, key: str, order: list[str], buckets: int) -> None:
    """Write ``df`` as parquet in ``buckets`` by ``key``, each sorted by key and ``order``, with a note of how."""
    spark, name = df.sparkSession, f"stored_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", f"{path}/rows")
     .bucketBy(buckets, key).sortBy(key, *order).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")     # the files stay where they are
    about = json.dumps({"key": key, "order": order, "buckets": buckets, "schema": df.schema.jsonValue()})
    spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``store``, in this or another session; joins, groups and windows by its key need no exchange."""
    about = json.loads(spark.read.text(f"{path}/about", wholetext=True).first()[0])
    name, columns = f"stored_{uuid.uuid4().hex}", spark.read.parquet(f"{path}/rows").schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    by = ", ".join(f"`{c}`" for c in [about["key"], *about["order"]])
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY (`{about['key']}`) SORTED BY ({by}) INTO {about['buckets']} BUCKETS LOCATION '{path}/rows'")
    return spark.table(name)


def _aggregates(spec: PanelSpec, planned: list[str], statics: list[str], keep: int) -> list[Column]:
    """Of rows with their position ``_k`` from the series' first row and ``_back`` from its last."""
    x, k = F.col(spec.target).cast("double"), F.when(F.col(spec.target).isNotNull(), F.col("_k").cast("double"))
    on = [F.weekday(spec.ts) == d for d in range(7)]
    one = F.struct(F.col(spec.ts), x.alias(spec.target), *planned)
    zero = F.lit(0.0)
    return [F.max(spec.ts).alias("last"), F.count(F.lit(1)).alias("n"), F.count(x).cast("double").alias("n_x"), F.coalesce(F.sum(k), zero).alias("s_k"),
            F.coalesce(F.sum(k * k), zero).alias("s_kk"), F.coalesce(F.sum(x), zero).alias("s_x"), F.coalesce(F.sum(k * x), zero).alias("s_kx"),
            F.array(*[F.count(F.when(d, x)).cast("double") for d in on]).alias("w_n"), F.array(*[F.coalesce(F.sum(F.when(d, x)), zero) for d in on]).alias("w_x"),
            F.array(*[F.coalesce(F.sum(F.when(d, k)), zero) for d in on]).alias("w_k"),
            F.sort_array(F.collect_list(F.when(F.col("_back") <= keep, one))).alias("tail"), *[F.max_by(c, spec.ts).alias(c) for c in statics]]


def series_state(history: DataFrame, spec: PanelSpec, keep: int = TAIL_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """One row per series: its last day and number of rows, sums over rows and by weekday, its last ``keep`` rows as ``tail``, and its statics.
    ``counted`` has ``id, n``: rows of the series that went before."""
    planned = [c for c in regression.PLANNED if c in history.columns]
    statics = [c for c in spec.static if c in history.columns]
    rows = history.withColumns({"_k": F.row_number().over(in_order(spec)) - 1, "_back": F.row_number().over(in_reverse(spec))})
    if counted is not None:
        rows = rows.join(counted.select(spec.id, F.col("n").alias("_n")), spec.id, "left").withColumn("_k", F.col("_k") + F.coalesce("_n", F.lit(0)))
    return rows.groupBy(spec.id).agg(*_aggregates(spec, planned, statics, keep))


def merged(state: DataFrame, days: DataFrame, spec: PanelSpec, keep: int = TAIL_ROWS) -> DataFrame:
    """The state after ``days``: only those behind a series' last day count, and only they are shuffled. New series are added."""
    known = state.select(spec.id, F.col("last").alias("_last"))
    later = days.join(known, spec.id, "left").where(F.col("_last").isNull() | (F.col(spec.ts) > F.col("_last"))).drop("_last")
    fresh = series_state(later, spec, keep, state)
    both = state.select(spec.id, F.struct(*[c for c in state.columns if c != spec.id]).alias("a")).join(
        fresh.select(spec.id, F.struct(*[c for c in fresh.columns if c != spec.id]).alias("b")), spec.id, "full")

    def added(c: str) -> Column:
        return F.coalesce(F.col(f"a.{c}"), F.lit(0)) + F.coalesce(F.col(f"b.{c}"), F.lit(0))

    def summed(c: str) -> Column:
        return F.when(F.col("a").isNull(), F.col(f"b.{c}")).when(F.col("b").isNull(), F.col(f"a.{c}")).otherwise(
            F.zip_with(f"a.{c}", f"b.{c}", lambda x, y: x + y))
    tail = F.concat(*[F.coalesce(F.col(f"{s}.tail"), F.filter(F.col(f"{o}.tail"), lambda _: F.lit(False))) for s, o in (("a", "b"), ("b", "a"))])
    rest = [c for c in state.columns if c not in (spec.id, "last", "n", "tail", *_SUMS, *_BY_WEEKDAY)]
    return both.select(spec.id, F.coalesce("b.last", "a.last").alias("last"), added("n").alias("n"), *[added(c).alias(c) for c in _SUMS], *[summed(c).alias(c) for c in _BY_WEEKDAY],
                       F.slice(tail, F.greatest(F.size(tail) - keep + 1, F.lit(1)), keep).alias("tail"), *[F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in rest])


def _fits(spec: PanelSpec) -> dict[str, Column]:
    """What the closed forms read, from the sums. Positions count from the first row there, from the last one here."""
    n, end = F.col("n_x"), F.col("n") - 1
    slope = F.try_divide(n * F.col("s_kx") - F.col("s_k") * F.col("s_x"), n * F.col("s_kk") - F.col("s_k") * F.col("s_k"))
    recent = F.slice("tail", F.greatest(F.size("tail") - forecast.AVERAGE_ROWS + 1, F.lit(1)), forecast.AVERAGE_ROWS)
    values = F.filter(F.transform(recent, lambda r: r[spec.target]), lambda v: v.isNotNull())
    out = {"_last": F.col("last"), "_mean": F.try_divide(F.aggregate(values, F.lit(0.0), lambda s, v: s + v), F.size(values)), "_b": slope,
           "_a": F.try_divide(F.col("s_x"), n) - slope * (F.try_divide(F.col("s_k"), n) - end)}
    out |= {f"_l{k}": F.when(F.size("tail") >= k, F.get("tail", F.size("tail") - k)[spec.target]) for k in range(1, forecast.SEASON + 1)}
    for d in range(7):
        many = F.get("w_n", F.lit(d))
        out |= {f"_x{d}": F.try_divide(F.get("w_x", F.lit(d)), many), f"_t{d}": F.try_divide(F.get("w_k", F.lit(d)), many) - end}
    return out


def forecasts(state: DataFrame, spec: PanelSpec, horizon: int = 14, model: regression.GlobalModel | None = None,
              promo: DataFrame | None = None) -> DataFrame:
    """``id, ts, step``, a column for each closed form and, with ``model``, one for the regression: the days after each series' last one.

    Every series is worked out from its own row; a window over its tail and the days ahead stays where the row is.
    """
    fits = state.withColumns(_fits(spec))
    steps = F.sequence(F.lit(1), F.lit(horizon))
    if model is None:
        ahead = fits.withColumn("step", F.explode(steps))
        return ahead.select(spec.id, F.date_add("last", F.col("step")).alias(spec.ts), "step", *[c.alias(m) for m, c in forecast._predictions().items()])
    fields = {f.name: f.dataType for f in state.schema["tail"].dataType.elementType.fields}
    empty = [F.lit(None).cast(fields[c]).alias(c) for c in fields if c != spec.ts]
    past = F.transform("tail", lambda r: F.struct(F.lit(None).cast("int").alias("step"), *[r[c].alias(c) for c in fields]))
    future = F.transform(steps, lambda s: F.struct(s.alias("step"), F.date_add("last", s).alias(spec.ts), *empty))
    rows = fits.withColumn("_row", F.explode(F.concat(past, future))).select("*", "_row.*").drop("_row", "tail")
    if promo is not None:
        planned = with_planned_promo(rows.select(spec.id, spec.ts, "step").where("step IS NOT NULL"), promo, spec)
        rows = rows.drop(*[c for c in regression.PLANNED if c in fields]).join(
            planned.select(spec.id, spec.ts, *regression.PLANNED).unionByName(
                rows.where("step IS NULL").select(spec.id, spec.ts, *[c for c in regression.PLANNED if c in fields]), allowMissingColumns=True), [spec.id, spec.ts], "left")
    rows, _ = regression.lagged_inputs(rows, spec, model.horizon, model.overall)
    valued = regression._valued(model, regression.encoded_inputs(model, rows.where(F.col("step").isNotNull())))
    return valued.select(spec.id, spec.ts, "step", *[c.alias(m) for m, c in forecast._predictions().items()], F.col("mean").alias(regression.NAME))
