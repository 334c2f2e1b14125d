"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import jaccard_regions, line_spread, mixing, quality, string_tiling
from panelwright.scale import written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents it rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: boilerplate lines go, no document does."""
    out = line_spread.remove_boilerplate(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of every group of near duplicates the document with the smallest id stays."""
    return jaccard_regions.keep_first(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold half of a benchmark item go."""
    return string_tiling.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: a row for each copy that the mix takes."""
    return mixing.mix(docs)


STAGES = [("quality", good), ("line_dedup", lines), ("jaccard_join", distinct), ("decontamination", uncontaminated), ("mixing", mixed)]
# The quality score, the sets behind the Jaccard join and the tiles aren't SQL; tests check each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
