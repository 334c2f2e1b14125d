"""Final cleanup of numeric columns, as statistics plus a pure projection.

``fit`` scans the features for the columns that miss values and their medians;
``apply`` is one lazy select. Keep the fitted rules with a model so that
prediction data is cleaned with the training statistics.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright import scale
from panelwright.functions.numeric import finite_or_null
from panelwright.spec import PanelSpec

LIMIT = 1e6


@dataclass(frozen=True)
class CleanupRules:
    """Numeric columns, and the fill value of those that have missing or infinite values."""

    numeric: tuple[str, ...]
    fill: dict[str, float]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def fill_kind(column: str) -> str:
    """Which fill rule a column name selects; the first match wins."""
    if column.endswith("_flag") or column.startswith("is_"):
        return "flag"
    if any(part in column for part in ("rank", "share", "index")):
        return "proportion"
    if any(part in column for part in ("growth", "effectiveness")):
        return "growth"
    return "general"


def _finite(df: DataFrame, columns: list[str]) -> DataFrame:
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns({c: finite_or_null(F.col(c)) for c in columns if c in floating})


def fit(df: DataFrame, spec: PanelSpec, medians: str = "exact") -> CleanupRules:
    """One count pass over all numeric columns, then medians of the columns that need one. With ``medians="sketch"`` a single
    job counts and sketches all columns, and a median's rank is off by a ten-thousandth of the rows at most."""
    columns = [c for c in numeric_columns(df) if c not in (spec.id, spec.ts)]
    finite = _finite(df.select(*columns), columns)
    if medians == "sketch":
        counts, middle = scale.sketched_medians(finite, columns)
        return CleanupRules(tuple(columns), {c: float(middle[c] or 0.0) if fill_kind(c) == "general" else 0.0 for c in columns if counts[c] < counts[""]})
    if medians != "exact":
        raise ValueError(f"unknown medians {medians!r}: exact or sketch")
    counts = finite.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns]).first().asDict()
    missing = [c for c in columns if counts[c] < counts["_rows"]]
    general = [c for c in missing if fill_kind(c) == "general"]
    middle = scale.column_medians(finite, general, counts=counts)
    return CleanupRules(tuple(columns), {c: float(middle.get(c) or 0.0) for c in missing})


def _within(x: Column, lo: float, hi: float) -> Column:
    """Bound a plain value; comparisons with NULL fall through, so NULL stays NULL."""
    return F.when(x > hi, hi).when(x < lo, lo).otherwise(x)


def _clean(column: str, value: Column, rules: CleanupRules, target: str) -> Column:
    if column in rules.fill:
        kind = fill_kind(column)
        value = F.coalesce(value, F.lit(rules.fill[column]))
        if kind == "flag":
            return value.cast("int")
        if kind == "proportion":
            return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))
        if kind == "growth":
            return F.least(F.greatest(value, F.lit(-10.0)), F.lit(10.0))
        return value if column == target else F.least(F.greatest(value, F.lit(-LIMIT)), F.lit(LIMIT))
    return value if column == target else _within(value, -LIMIT, LIMIT)


def apply(df: DataFrame, spec: PanelSpec, rules: CleanupRules) -> DataFrame:
    """Fill and bound every numeric column. Only columns that missed values when the rules
    were fitted get the tighter bounds of their kind."""
    present = [c for c in rules.numeric if c in df.columns]
    finite = _finite(df, present)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c not in present:
            out.append(F.col(c))
            continue
        kind = T.IntegerType() if c in rules.fill and fill_kind(c) == "flag" else kinds[c]
        # an integer column with gaps becomes fractional when its median is
        if isinstance(kind, T.IntegralType) and c in rules.fill and fill_kind(c) != "flag":
            kind = T.DoubleType()
        out.append(_clean(c, F.col(c), rules, spec.target).cast(kind).alias(c))
    return finite.select(*out)


def leftovers(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row with the missing and infinite values left in numeric columns."""
    columns = [c for c in numeric_columns(df) if c != spec.id]
    missing = sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0))
    infinite = sum((F.count_if(F.abs(F.col(c)) == float("inf")) for c in columns), F.lit(0))
    return df.agg(infinite.alias("infinite_values"), missing.alias("missing_values"))


def save(rules: CleanupRules, spark: SparkSession, path: str) -> None:
    spark.createDataFrame([(json.dumps(asdict(rules)),)], "rules string").write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> CleanupRules:
    raw = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return CleanupRules(tuple(raw["numeric"]), raw["fill"])
