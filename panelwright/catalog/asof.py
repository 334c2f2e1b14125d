"""Full-history statistics cut at a day; the SQL is that of the uncut queries over the earlier rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelwright import scale
from panelwright.catalog import cross_series, series_windows  # noqa: F401  their SQL is used below
from panelwright.catalog.base import BODIES, SPEC, gappy, r, register
from panelwright.operators import asof, cross

CUT = dt.date(1999, 6, 30)
_PAST = f"WITH past AS (SELECT * FROM gappy WHERE date <= DATE '{CUT}')"
_SERIES = {"trend_strength_with_gaps": ("trend_strength",), "seasonality": asof.SEASONS,
           "promo_effectiveness": ("historical_promo_effectiveness",), "decline_indicator": ("sales_decline_indicator",),
           "consecutive_decline": ("consecutive_decline_days",), "decline_magnitude": ("decline_magnitude",)}
_DOUBLES = ("trend_strength", *asof.SEASONS, "historical_promo_effectiveness", "decline_magnitude")


def _over_past(query: str) -> str:
    sql = BODIES[query]
    for rows in ("gappy", "dense", "panel"):
        sql = sql.replace(f"FROM {rows}", "FROM past")
    return sql


@register("asof_series_state", f"""{_PAST},
{', '.join(f"{q}_ AS (SELECT DISTINCT sku, {', '.join(c)} FROM ({_over_past(q)}))" for q, c in _SERIES.items())}
SELECT * FROM {' JOIN '.join(f'{q}_' + (' USING (sku)' if k else '') for k, q in enumerate(_SERIES))}""")
def asof_series_state(spark, sf):
    state = asof.series_state(gappy(spark, sf), SPEC, CUT)
    return state.select("sku", *[r(c) for c in _DOUBLES], "sales_decline_indicator", "consecutive_decline_days")


@register("asof_market_state", f"""{_PAST}
SELECT 'category' AS kind, category AS name, portfolio_concentration_risk AS value FROM ({_over_past('portfolio_concentration')})
UNION ALL SELECT 'subcategory', subcategory, market_fragmentation_score FROM ({_over_past('market_fragmentation')})
UNION ALL SELECT DISTINCT 'instability', split_part(sku, '~', 2), category_instability_index FROM ({_over_past('category_instability')})""")
def asof_market_state(spark, sf):
    rows = scale.written(asof.past(gappy(spark, sf), SPEC, CUT))
    state = cross.category_state_table(rows, SPEC)
    return (state.select(F.lit("category").alias("kind"), F.col("category").alias("name"), r("portfolio_concentration_risk", "value"))
            .unionAll(cross.fragmentation_table(rows, SPEC).select(F.lit("subcategory"), "subcategory", r("market_fragmentation_score")))
            .unionAll(state.select(F.lit("instability"), "category", r("category_instability_index"))))
