"""Cross-series features: group-day aggregates joined back onto the panel.

A category on one day spans any number of series, so nothing here windows over
such a group. Aggregates are combined map-side to one row per group and day and
attached with a size-checked broadcast; price ranks go through exact positions
of distinct prices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright import scale
from panelwright.functions.numeric import CUR, UNB, clip, in_order, ratio_change, with_growth
from panelwright.spec import PanelSpec

# Rows that growth and spread of a category look back, and rows of a chunk where they run over all series of the category.
LOOK_BACK = 7
CHUNK_ROWS = 65_536


def _group_day(df: DataFrame, spec: PanelSpec, keys: list[str], **aggs) -> DataFrame:
    return df.groupBy(*keys, spec.ts).agg(*[a.alias(n) for n, a in aggs.items()])


def _total(spec: PanelSpec):
    return F.coalesce(F.sum(spec.target), F.lit(0.0))


def _category_day(df: DataFrame, spec: PanelSpec, source: DataFrame, small: bool) -> DataFrame:
    """Add ``_cat_day``, the category's sales that day, unless it is already there."""
    if "_cat_day" in df.columns:
        return df
    return scale.attach(df, _group_day(source, spec, ["category"], _cat_day=_total(spec)),
                        ["category", spec.ts], small=small)


def category_total(df: DataFrame, spec: PanelSpec, source: DataFrame | None = None, small: bool = False) -> DataFrame:
    """``category_total_sales``: sales of the rest of the category that day, at least 0."""
    keep = df.columns
    df = _category_day(df, spec, df if source is None else source, small)
    return df.withColumn("category_total_sales", clip(F.col("_cat_day") - F.col(spec.target), 0.0)).select(
        *keep, "category_total_sales")


def category_dynamics(df: DataFrame, spec: PanelSpec, compat: bool = False) -> DataFrame:
    """``category_growth_rate`` (7 rows, +-10) and ``category_volatility`` (7-row std) of the
    category total, along each series.

    With ``compat``, along the rows of the whole category in order of series and day, so that the first rows of a series
    look back on the series before it.
    """
    keep = df.columns
    if compat:
        df, w = _category_rows(df, spec)
    else:
        w = in_order(spec)
        df = df.withColumn("_padded", F.last("category_total_sales", ignorenulls=True).over(w.rowsBetween(UNB, CUR)))
    df = df.withColumns({"_growth": ratio_change(F.col("_padded"), F.lag("_padded", LOOK_BACK).over(w)),
                         "_spread": F.stddev_samp("category_total_sales").over(w.rowsBetween(-LOOK_BACK + 1, CUR))})
    if compat:      # the context rows have served
        df = df.where("_own")
    return df.withColumns({
        "category_growth_rate": clip(F.coalesce("_growth", F.lit(0.0)), -10.0, 10.0),
        "category_volatility": clip(F.coalesce("_spread", F.lit(0.0)), 0.0, 1e6),
    }).select(*keep, "category_growth_rate", "category_volatility")


def _category_rows(df: DataFrame, spec: PanelSpec):
    """Rows numbered along (category, series, day) and cut into equal chunks, each with the last ``LOOK_BACK`` rows of the chunk before it
    (``_own`` is false there), the padded totals, and the window to use. No task holds a category.

    A missing total takes the last known one of the category (rows without a category have none); where a chunk begins with missing ones, this comes from
    a table with the last known total of each category and chunk.
    """
    placed = scale.numbered(df, ["category", spec.id, spec.ts], "_place").withColumn("_chunk", F.floor(F.col("_place") / CHUNK_ROWS))
    known = F.col("category_total_sales").isNotNull()
    # all chunks of a category, with what it knew last before each of them
    last = placed.groupBy("category", "_chunk").agg(F.max_by(F.when(known, F.col("category_total_sales")), F.when(known, F.col("_place"))).alias("_last"))
    by_chunk = Window.partitionBy("category").orderBy("_chunk")
    carried = last.select("category", "_chunk", F.last("_last", ignorenulls=True).over(by_chunk.rowsBetween(UNB, -1)).alias("_carried"))
    inside = Window.partitionBy("_chunk", "category").orderBy("_place")
    placed = scale.attach(placed, scale.written(carried), ["category", "_chunk"])
    placed = placed.withColumn("_padded", F.coalesce(F.last("category_total_sales", ignorenulls=True).over(inside.rowsBetween(UNB, CUR)), "_carried"))
    edge = F.col("_place") % CHUNK_ROWS >= CHUNK_ROWS - LOOK_BACK
    lent = F.when(edge, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spread = (placed.withColumn("_by", F.explode(lent)).withColumn("_chunk", F.col("_chunk") + F.col("_by")).withColumn("_own", F.col("_by") == 0)
              .drop("_by", "_carried"))
    return spread, inside


def brand_share(df: DataFrame, spec: PanelSpec, source: DataFrame | None = None, small: bool = False) -> DataFrame:
    """``brand_market_share``: the brand's part of its category's sales that day."""
    keep, source = df.columns, df if source is None else source
    brand = _group_day(source, spec, ["brand", "category"], _brand_day=_total(spec))
    df = scale.attach(df, brand, ["brand", "category", spec.ts], small=small)
    df = _category_day(df, spec, source, small)
    share = F.col("_brand_day") / clip(F.col("_cat_day"), 1e-6)
    return df.withColumn("brand_market_share", clip(F.coalesce(share, F.lit(0.0)), 0.0, 1.0)).select(
        *keep, "brand_market_share")


def brand_popularity(df: DataFrame, spec: PanelSpec, source: DataFrame | None = None, small: bool = False) -> DataFrame:
    """``brand_popularity_index``: selling series over all series of the brand that day;
    0 on rows that sell nothing themselves."""
    stats = _group_day(df if source is None else source, spec, ["brand"],
                       _active=F.count_if(F.col(spec.target) > 0), _all=F.count(spec.id))
    df = scale.attach(df, stats, ["brand", spec.ts], small=small)
    share = F.when(F.col(spec.target) > 0, F.try_divide("_active", "_all"))
    return df.withColumn("brand_popularity_index", clip(F.coalesce(share, F.lit(0.0)), 0.0, 1.0)).drop("_active", "_all")


def subcategory_peers(df: DataFrame, spec: PanelSpec, source: DataFrame | None = None, small: bool = False) -> DataFrame:
    """``subcategory_competition`` (series count, 1..1000) and ``similar_products_avg``
    (mean sales of the other series of the subcategory)."""
    stats = _group_day(df if source is None else source, spec, ["subcategory"], _sum=_total(spec), _peers=F.count(spec.id))
    df = scale.attach(df, stats, ["subcategory", spec.ts], small=small)
    others = (F.col("_sum") - F.col(spec.target)) / F.greatest(F.col("_peers") - 1, F.lit(1))
    return df.withColumns({
        "subcategory_competition": clip(F.col("_peers"), F.lit(1).cast("long"), F.lit(1000).cast("long")),
        "similar_products_avg": clip(F.coalesce(others, F.lit(0.0)), 0.0, 1e6),
    }).drop("_sum", "_peers")


def price_position(df: DataFrame, spec: PanelSpec, source: DataFrame | None = None) -> DataFrame:
    """``price_rank_in_category`` (average rank over the number of prices) and
    ``price_vs_category_median`` (within 0.01..100, 1 when unknown), per category and day.

    Category-days of bounded size are ordered by a window. Beyond that, positions come from distinct prices in
    slices and are attached by price; a price shared by very many rows is split by its size.
    """
    keys, keep, source = ["category", spec.ts], df.columns, df if source is None else source
    if scale.biggest_group(source, keys) <= scale.GROUP_ROWS:
        group = Window.partitionBy(*keys)
        df = df.withColumns({
            "_total": F.count("price").over(group), "_median": F.percentile("price", F.lit(0.5)).over(group),
            "_before": F.rank().over(group.orderBy(F.col("price").asc_nulls_last())) - 1,
            "_cnt": F.count(F.lit(1)).over(group.orderBy("price").rangeBetween(0, 0))})
    else:
        places = scale.value_positions(source, keys, "price")
        medians = scale.group_quantiles(source, keys, "price", {"_median": 0.5})
        df = scale.attach(scale.attach(df, places, [*keys, "price"]), medians, keys)
    rank = (F.col("_before") + (F.col("_cnt") + 1) / 2) / F.col("_total")
    ratio = F.col("price") / clip(F.col("_median"), 1e-6)
    return df.withColumns({
        "price_rank_in_category": F.when(F.col("price").isNotNull(), rank),
        "price_vs_category_median": clip(F.coalesce(ratio, F.lit(1.0)), 0.01, 100.0),
    }).select(*keep, "price_rank_in_category", "price_vs_category_median")


def instability_table(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``(category, category_instability_index)`` from 7, 30 and 90-day growth of daily totals."""
    days = _group_day(df.where(F.col("category").isNotNull()), spec, ["category"], _sum=_total(spec))
    by_day = Window.partitionBy("category").orderBy(spec.ts)
    days = with_growth(days, "_sum", {"_g7": 7, "_g30": 30, "_g90": 90}, by_day)
    days = days.withColumns({g: F.coalesce(g, F.lit(0.0)) for g in ("_g7", "_g30", "_g90")})
    return days.groupBy("category").agg(*_instability()).select("category", _instability_score())


def _instability() -> list[Column]:
    # an infinite growth leaves the spread undefined
    return [*[F.when(F.max(F.abs(F.col(g))) < float("inf"), fn(g)).alias(g)
              for g, fn in (("_g7", F.stddev_samp), ("_g30", F.stddev_samp))], F.avg("_g90").alias("_g90")]


def _instability_score() -> Column:
    score = F.col("_g7") * 0.4 + F.col("_g30") * 0.3 + F.greatest(F.lit(0.0), -F.col("_g90")) * 0.3
    return F.coalesce(clip(score, 0.0, 2.0), F.lit(0.5)).alias("category_instability_index")


def _concentration() -> Column:
    index = F.when(F.col("_sum") <= 0, 0.5).otherwise(clip(F.try_divide(F.col("_sq"), F.col("_sum") * F.col("_sum")), 0.0, 1.0))
    return F.avg(index).alias("portfolio_concentration_risk")


def category_state_table(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Instability and concentration by category, from one table of category-days."""
    x = F.col(spec.target)
    days = _group_day(df.where(F.col("category").isNotNull()), spec, ["category"], _sum=_total(spec), _sq=F.sum(x * x))
    days = with_growth(days, "_sum", {"_g7": 7, "_g30": 30, "_g90": 90}, Window.partitionBy("category").orderBy(spec.ts))
    days = days.withColumns({g: F.coalesce(g, F.lit(0.0)) for g in ("_g7", "_g30", "_g90")})
    return days.groupBy("category").agg(*_instability(), _concentration()).select(
        "category", _instability_score(), "portfolio_concentration_risk")


def fragmentation_table(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``(subcategory, market_fragmentation_score)``: mean over days of std over mean sales."""
    x = F.col(spec.target)
    days = _group_day(df.where(F.col("subcategory").isNotNull()), spec, ["subcategory"],
                      _sum=_total(spec), _sd=F.stddev_samp(x), _n=F.count(x))
    mean = F.try_divide("_sum", "_n") + 1e-6
    score = clip(F.coalesce(F.try_divide(F.col("_sd"), mean), F.lit(0.0)), 0.0, 3.0)
    return days.groupBy("subcategory").agg(F.avg(score).alias("market_fragmentation_score"))


def concentration_table(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``(category, portfolio_concentration_risk)``: mean over days of the squared sales shares;
    0.5 on days without sales."""
    x = F.col(spec.target)
    days = _group_day(df.where(F.col("category").isNotNull()), spec, ["category"], _sum=_total(spec), _sq=F.sum(x * x))
    return days.groupBy("category").agg(_concentration())


def headwind_table(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``(ts, market_headwind)``: 1 when total sales fell by over 2% against seven days earlier.
    One row per calendar day, so its single ordered partition is small."""
    days = df.groupBy(spec.ts).agg(_total(spec).alias("_sum"))
    days = with_growth(days, "_sum", {"_trend": 7}, Window.partitionBy(F.lit(0)).orderBy(spec.ts))
    return days.select(spec.ts, F.coalesce((F.col("_trend") < -0.02).cast("int"), F.lit(0)).alias("market_headwind"))


def market_state(df: DataFrame, spec: PanelSpec, source: DataFrame | None = None, small: bool = False) -> DataFrame:
    """Category instability, subcategory fragmentation, concentration and market headwind.
    The first three are 0.5 where the panel has no such grouping."""
    has, source = set(df.columns), df if source is None else source
    names = ("category_instability_index", "market_fragmentation_score", "portfolio_concentration_risk")
    if "category" in has:
        df = scale.attach(df, category_state_table(source, spec), ["category"], small=small)
    if {"category", "subcategory"} <= has:
        df = scale.attach(df, fragmentation_table(source, spec), ["subcategory"], small=small)
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0.5)) if c in df.columns else F.lit(0.5) for c in names})
    df = df.join(F.broadcast(headwind_table(source, spec)), spec.ts, "left")
    return df.withColumn("market_headwind", F.coalesce("market_headwind", F.lit(0)))


def peer_tables(source: DataFrame, spec: PanelSpec) -> bool:
    """Whether every group-day table is small: one count of the finest grouping bounds them all."""
    finest = [c for c in ("category", "brand", "subcategory") if c in source.columns]
    return scale.at_most(source.select(*finest, spec.ts).distinct(), scale.BROADCAST_ROWS)


def peer_inputs(df: DataFrame, spec: PanelSpec, source: DataFrame, small: bool) -> DataFrame:
    """What must precede the per-series windows: price positions and category totals."""
    if {"category", "price"} <= set(source.columns):
        df = price_position(df, spec, source)
    if "category" in source.columns:
        df = category_total(_category_day(df, spec, source, small), spec, source, small)
    return df


def peer_joins(df: DataFrame, spec: PanelSpec, source: DataFrame, small: bool) -> DataFrame:
    """Brand and subcategory features, as far as their columns exist."""
    has = set(source.columns)
    if "brand" in has:
        if "category" in has:
            df = brand_share(df, spec, source, small)
        df = brand_popularity(df, spec, source, small)
    if {"category", "subcategory"} <= has:
        df = subcategory_peers(df, spec, source, small)
    return df


def peer_features(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """All category, brand, subcategory and price features of a panel."""
    source, given = df, df.columns
    small = peer_tables(source, spec)
    df = peer_inputs(df, spec, source, small)
    if "category" in given:
        df = category_dynamics(df, spec)
    df = peer_joins(df, spec, source, small)
    return df.drop(*[c for c in df.columns if c.startswith("_") and c not in given])
