"""The daily demand panel derived from order lines: one series per brand and part type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.calendar import in_sale_window


def daily_panel(spark: SparkSession, sf_dir: str, gappy: bool = False) -> DataFrame:
    """Aggregate ``lineitem`` joined with ``part`` to series and days.

    Lines are first summed per part and day, map-side, so that the join and the final
    aggregation see one row per part and day even when one part holds most lines.
    ``gappy`` blanks a regular pattern of targets to exercise missing values.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(
        "l_partkey", F.col("l_shipdate").cast("date").alias("date")).agg(
        F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("amount"), F.max("l_discount").alias("top_discount"))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand", "p_type")
    days = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "p_type", "date").agg(
        F.sum("qty").alias("sales"), F.sum("amount").alias("amount"), F.max("top_discount").alias("top_discount"))
    number = F.substring_index("p_brand", "#", -1).cast("int")
    promo = F.col("top_discount") >= 0.08
    sub = F.concat(F.lit("G"), number % 5)
    target = F.col("sales")
    if gappy:
        target = F.when((F.unix_date("date") + number) % 11 != 0, target)
    return days.select(
        F.concat_ws("~", "p_brand", "p_type").alias("sku"), "date", target.alias("sales"),
        F.col("p_type").alias("category"), sub.alias("subcategory"), F.col("p_brand").alias("brand"),
        F.concat_ws("_", "p_type", sub).alias("product_group"),
        promo.cast("int").alias("promo_flag"), F.when(promo, F.col("top_discount")).otherwise(0.0).alias("promo_discount"),
        in_sale_window(F.col("date")).alias("special_event"),
        (F.col("amount") / F.col("sales")).alias("price"))

