"""Removal of boilerplate lines by the number of distinct sites they stand on.

A HyperLogLog sketch per line hash counts sites and merges by aggregation. Lines whose
estimate lies near the threshold get an exact distinct count. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.scale import attach, written

# Sites from which on a line is boilerplate.
MIN_SITES = 6
# Boilerplate lines up to which their keys (24 bytes each) are broadcast.
SPREAD_ROWS = 200_000
# Size of a sketch (2**LG_K registers) and the part of the threshold, on either side, within which sites are counted.
LG_K = 9
NEAR = 0.25


def line_key(line: Column) -> Column:
    """Two independent 64-bit hashes of a line without the blanks around it; a blank line has none."""
    bare = F.trim(line)
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("line"), bare).alias("b")))


def _lines(docs: DataFrame) -> DataFrame:
    """The distinct lines of every document: ``doc_id, site, key``."""
    keys = F.transform(F.split(F.col("text"), "\n"), line_key)
    return (docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("site"),
                        F.explode(F.array_distinct(keys)).alias("key")).where(F.col("key").isNotNull()))


def line_spread(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Boilerplate lines: ``key, first_doc`` of every line on at least ``min_sites`` sites."""
    lines = _lines(docs)
    # a document has a line on one site, so fewer documents than sites asked for settle a line without a sketch
    often = written(lines.groupBy("key").agg(
        F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc"))
        .where(F.col("docs") >= min_sites)
        .select("key", "first_doc", F.hll_sketch_estimate("sketch").alias("sites")))
    low, high = min_sites * (1 - NEAR), min_sites * (1 + NEAR)
    near = often.where(F.col("sites").between(F.floor(F.lit(low)), F.ceil(F.lit(high)))).select("key")
    exact = (lines.select("key", "site").join(near, "key", "left_semi").distinct()
             .groupBy("key").agg(F.count(F.lit(1)).alias("exact")))
    return (often.join(exact, "key", "left")
            .where(F.coalesce(F.col("exact"), F.col("sites")) >= min_sites).select("key", "first_doc"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``n_lines, n_removed`` (long) added.

    A line is compared without the spaces around it; blank lines stay. A line counts as boilerplate when it
    stands on at least ``min_sites`` values of ``source`` (NULL is the empty name). The document with
    the smallest id that has the line keeps it, so that one copy of every text stays whole. NULL text stays
    NULL with 0 lines; a text of boilerplate only becomes empty; rows that repeat an id are treated alike, and rows
    without an id neither keep a line as the first nor lose one. Columns named ``n_lines`` and ``n_removed`` are replaced.
    """
    spread = written(line_spread(docs, min_sites))
    touched = (attach(_lines(docs).where(F.col("doc_id").isNotNull()), spread, ["key"], limit=SPREAD_ROWS)
               .where(F.col("first_doc") < F.col("doc_id"))
               .groupBy("doc_id").agg(F.collect_set("key").alias("_drop")))
    lines = F.split(F.col("text"), "\n")
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("_drop"), line_key(x)), F.lit(False)))
    given = [F.col(c) for c in docs.columns if c not in ("n_lines", "n_removed", "text")]
    place = docs.columns.index("text")
    joined = docs.join(touched, "doc_id", "left")
    held = joined.withColumn("_kept", F.when(F.col("_drop").isNotNull() & F.col("text").isNotNull(), kept))
    n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    text = F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.concat_ws("\n", "_kept")).alias("text")
    removed = F.when(F.col("_kept").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size("_kept")).cast("long")
    return held.select(*given[:place], text, *given[place:], F.when(F.col("text").isNull(), F.lit(0)).otherwise(n).cast("long").alias("n_lines"),
                       removed.alias("n_removed"))
