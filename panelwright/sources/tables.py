"""Readers and writers of panels, future promotions, forecasts and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.numeric import finite_or_null
from panelwright.spec import PanelSpec

_FLAGS = ("promo_flag", "special_event", "is_holiday")


def panel_schema(spec: PanelSpec) -> dict[str, T.DataType]:
    """Types of the known panel columns; the date is parsed in a second step."""
    kinds: dict[str, T.DataType] = {spec.id: T.StringType(), spec.ts: T.StringType(), spec.target: T.DoubleType()}
    kinds |= {c: T.StringType() for c in spec.static}
    kinds |= {c: T.DoubleType() for c in _FLAGS}     # written as 1.0 once a flag has gaps
    return kinds | {"promo_discount": T.DoubleType(), "price": T.DoubleType()}


def parse_time(df: DataFrame, column: str, pattern: str | None = "yyyy-MM-dd", lenient: bool = False) -> DataFrame:
    """Turn a text column into a date. A bad value fails the query, or becomes NULL when ``lenient``.
    Timestamps are cut to their day."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.StringType):
        return df.withColumn(column, F.col(column).cast("date"))
    if pattern is None:
        return df.withColumn(column, F.col(column).try_cast("date") if lenient else F.col(column).cast("date"))
    parsed = F.try_to_timestamp(F.col(column), F.lit(pattern)).cast("date") if lenient else F.to_date(column, pattern)
    return df.withColumn(column, parsed)


def normalise(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Drop rows without series id, use NULL as the only missing marker, and a double target."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cols = {c: finite_or_null(F.col(c)) for c in floating}
    cols[spec.target] = finite_or_null(F.col(spec.target).cast("double"))
    return df.where(F.col(spec.id).isNotNull()).withColumns(cols)


def whole_flags(df: DataFrame) -> DataFrame:
    """Flags as integers. NULL and NaN are missing; a value that is no whole number fails the query."""
    def flag(c: str) -> Column:
        x = finite_or_null(F.col(c).cast("double"))
        return F.when(x == F.floor(x), x.cast("int")).when(x.isNotNull(), F.raise_error(
            F.concat(F.lit(f"{c} is no flag: "), x.cast("string"))).cast("int"))
    return df.withColumns({c: flag(c) for c in _FLAGS if c in df.columns})


def read_panel(spark: SparkSession, path: str, spec: PanelSpec, fmt: str = "csv", lenient: bool = False) -> DataFrame:
    """Read a panel. CSV columns get their types from the contract, in header order; others are inferred from the whole file."""
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).columns
        kinds = panel_schema(spec)
        if set(header) - set(kinds):
            seen = spark.read.option("header", True).option("inferSchema", True).csv(path).schema
            kinds |= {f.name: f.dataType for f in seen.fields if f.name not in kinds}
        schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])
        df = spark.read.schema(schema).option("header", True).option("enforceSchema", False) \
            .option("mode", "FAILFAST").csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return normalise(whole_flags(parse_time(df, spec.ts, spec.date_pattern, lenient)), spec)


def read_future_promo(spark: SparkSession, path: str | None, spec: PanelSpec, fmt: str = "csv") -> DataFrame | None:
    """Planned promotions per series and day, or None when no path is configured."""
    if not path:
        return None
    if fmt == "csv":
        df = spark.read.option("header", True).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return whole_flags(parse_time(df, spec.ts, spec.date_pattern)).select(
        F.col(spec.id).cast("string").alias(spec.id), spec.ts, "promo_flag",
        F.col("promo_discount").cast("double"), "special_event")


def write_forecast(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv if fmt == "csv" else writer.format(fmt).save)(path)


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_report(lines: DataFrame, path: str) -> None:
    """Write ``(line_no, text)`` as a text file; a report is a fixed handful of lines."""
    lines.orderBy("line_no").select("text").coalesce(1).write.mode("overwrite").text(path)


def write_features(df: DataFrame, path: str, spec: PanelSpec) -> None:
    """Feature table as parquet, partitioned by month so that later date filters prune files."""
    month = F.date_format(spec.ts, "yyyy-MM")
    df.withColumn("ts_month", month).write.mode("overwrite").partitionBy("ts_month").parquet(path)
