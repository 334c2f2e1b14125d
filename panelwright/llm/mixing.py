"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, read up to twice. A
document's virtual finish time is the cumulative size of its queue divided by the
source's target; all copies are range-sorted by it and cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.text import word_array
from panelwright.scale import attach, numbered, written

ROUNDS = 2
# Parts of a queue at whose ends the finish time of ``mix`` is exact.
KNOT_BITS = 4
KNOTS = 1 << KNOT_BITS


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Sources by code point, NULL last, take ``weights`` in turn. They share ``share`` times all
    sizes; none gets more than ``most`` times its own size, and what that leaves is shared again
    by weight. The final level is found directly: in order of ``size / weight``, a source is
    capped as long as its cap lies below what the rest would get per weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    total = Window.partitionBy()
    filling = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    out = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
           .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
           .withColumn("_budget", F.sum("source_size").over(total) * F.lit(float(share)))
           .withColumn("_left", F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
           .withColumn("_weights", F.sum("_w").over(total) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
           .withColumn("_level", F.col("_left") / F.col("_weights"))
           .withColumn("_capped", F.col("_cap") <= F.col("_level") * F.col("_w")))
    # the level is at its highest where the first source isn't capped, and holds for all that follow
    return out.withColumn("_open", F.max(F.when(~F.col("_capped"), F.col("_level"))).over(total)).select(
        "source", "source_size",
        F.when(F.col("_capped"), F.col("_cap")).otherwise(F.col("_open") * F.col("_w")).alias("target"))


def _cumulative(df: DataFrame, keys: list[str], order: list[str], value: str, bucket: str, name: str) -> DataFrame:
    """Running sum of ``value`` within ``keys`` along ``bucket`` and, inside it, ``order``; no task holds a whole key."""
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    along = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    # keys are compared NULL-safe: a missing source is a queue too
    starts = sums.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(bucket).alias("_b"),
                         F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col(bucket) == F.col("_b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return (df.withColumn("_in", F.sum(value).over(inside)).join(starts, same)
            .withColumn(name, F.col("_in") + F.col("_start")).drop("_in", "_start", "_b", *[f"_k_{k}" for k in keys]))


def mix(docs: DataFrame, seed: int = 7, **shares) -> DataFrame:
    """The mix: one row per taken copy, with all columns of ``docs`` and ``size, source_size, target, round,
    virtual_finish``, by which it is to be ordered. Columns of these names in ``docs`` are replaced. See ``allotments``.

    What a source gives is a prefix of its queue, so one cut for each source, found on rows without texts, decides every
    copy, and texts are filtered where they are read. ``virtual_finish`` is exact at the ends of ``KNOTS`` equal parts of the
    queue and follows the shuffled order in between.
    """
    keyed = _keyed(docs, seed).drop("_uid").withColumn("_queue", _queue(F.col("source")))
    slim = written(_keyed(docs, seed).select("_uid", "source", "_size", "_row"))
    targets = source_targets(slim.select("source", F.col("_size").alias("size")), **shares)
    cuts = written(_cuts(slim, targets, _taken(slim, targets, shares)))
    given = [c for c in docs.columns if c not in ("size", "source_size", "target", "round", "virtual_finish")]
    rows = attach(keyed.where(F.col("_size") > 0), cuts, ["_queue"]).where("_cut_round IS NOT NULL")
    at_cut = F.col("_row") == F.col("_cut_row")
    whole = (F.col("_row") < F.col("_cut_row")) | at_cut & (F.col("_n") == F.col("_many"))
    last = F.when(whole, F.col("_cut_round")).otherwise(F.col("_cut_round") - 1)
    copies = rows.where(last >= 0).withColumn("round", F.explode(F.sequence(F.lit(0), last)))
    # equal rows of which the cut takes some: any of them will do, as many as it takes
    if not cuts.where("_n < _many").isEmpty():
        equal = numbered(rows.where(at_cut & (F.col("_n") < F.col("_many"))), ["_queue", "_row"], "_place")
        first = equal.groupBy("_queue").agg(F.min("_place").alias("_first"))
        some = attach(equal, written(first), ["_queue"]).where(F.col("_place") - F.col("_first") < F.col("_n"))
        copies = copies.unionByName(some.drop("_place", "_first").withColumn("round", F.col("_cut_round")))
    part = F.shiftright("_row", 63 - KNOT_BITS).cast("int")
    inside = (F.col("_row") - F.shiftleft(part.cast("long"), 63 - KNOT_BITS)) / F.lit(float(1 << (63 - KNOT_BITS)))
    before = F.aggregate(F.slice("_knots", 1, part), F.lit(0).cast("long"), lambda a, x: a + x)
    reached = before + F.element_at("_knots", part + 1) * inside + F.col("round") * F.col("source_size")
    return copies.select(*given, F.col("_size").alias("size"), "source_size", "target", "round", (reached / F.col("target")).alias("virtual_finish"))


def _queue(source: Column) -> Column:
    """A key of its own for every source, NULL too."""
    return F.coalesce(F.concat(F.lit("v"), source), F.lit("n"))


def _cuts(slim: DataFrame, targets: DataFrame, taken: DataFrame) -> DataFrame:
    """One row per source that gives something: ``_queue``, its target, the last ``_cut_round`` and ``_cut_row`` taken, how many rows of this
    last key are taken (``_n``) and exist (``_many``), and the sizes of the queue's parts in ``_knots``."""
    last = F.struct("_round", "_row")
    by_key = taken.groupBy(_queue(F.col("source")).alias("_queue"), "_round", "_row").agg(F.count(F.lit(1)).alias("_n"))
    ends = written(by_key.groupBy("_queue").agg(F.max(last).alias("_last"), F.max_by("_n", last).alias("_n")).select(
        "_queue", F.col("_last._round").alias("_cut_round"), F.col("_last._row").alias("_cut_row"), "_n"))
    queued = slim.where(F.col("_size") > 0).select(_queue(F.col("source")).alias("_queue"), "_size", "_row")
    part = F.shiftright("_row", 63 - KNOT_BITS)
    about = attach(queued, ends, ["_queue"]).groupBy("_queue").agg(
        F.count_if(F.col("_row") == F.col("_cut_row")).alias("_many"),
        F.array(*[F.coalesce(F.sum(F.when(part == k, F.col("_size"))), F.lit(0)) for k in range(KNOTS)]).alias("_knots"))
    return ends.join(about, "_queue").join(targets.select(_queue(F.col("source")).alias("_queue"), "source_size", "target"), "_queue")


def allotments(docs: DataFrame, seed: int = 7, **shares) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    ``taken`` is the document's size times the copies the mix has of it, 0 to 2. NULL or empty text
    has size 0 and takes nothing; a NULL source is a source, the last; NULL and repeated ids and
    repeated rows each count as they stand; equal finish times are ordered by the source, the
    shuffle's hash and the row. A table without words has targets of 0, an empty table no rows.
    """
    slim = written(_keyed(docs, seed).select("_uid", "doc_id", "source", "_size", "_row"))
    targets = source_targets(slim.select("source", F.col("_size").alias("size")), **shares)
    taken = _taken(slim, targets, shares).groupBy("_uid").agg(F.count(F.lit(1)).alias("_copies"))
    return (slim.join(taken, "_uid", "left")
            .join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                    (F.col("_size") * F.coalesce(F.col("_copies"), F.lit(0))).alias("taken")))


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """With size, shuffle key (a hash of id and text, the same in every run) and a row number that tells equal rows apart."""
    key = F.xxhash64(F.lit(seed), F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.col("text"))
    return docs.withColumns({"_size": F.size(word_array(docs["text"])).cast("long"),
                             "_row": F.shiftrightunsigned(key, 1), "_uid": F.monotonically_increasing_id()})


def _taken(slim: DataFrame, targets: DataFrame, shares: dict) -> DataFrame:
    """The copies that fit the budget, with their virtual finish time."""
    slim = slim.select("_uid", "source", "_size", "_row").where(F.col("_size") > 0)
    # buckets of a queue grow as the square root of the table: neither what one task orders nor the list of starts gets long
    bits = max(1, (int(slim.count() ** 0.5) // 8).bit_length())
    slim = slim.withColumn("_bucket", F.shiftright("_row", 63 - bits))
    queued = _cumulative(slim, ["source"], ["_row", "_uid"], "_size", "_bucket", "_cum").drop("_bucket")
    copies = (queued.withColumn("_round", F.explode(F.array(*[F.lit(i) for i in range(ROUNDS)])))
              .join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
              .withColumn("_until", F.col("_cum") + F.col("_round") * F.col("source_size"))
              # what begins beyond the target is never taken, so a long document leaves its budget to no other source
              .where(F.col("_until") - F.col("_size") < F.col("target"))
              .withColumn("_finish", F.col("_until") / F.col("target")).drop("_until"))
    order = ["_finish", "source", "_round", "_row", "_uid"]
    # range-sorted and written once, so that the ranges are the same for every later pass
    ranged = written(copies.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    placed = _cumulative(ranged, [], order, "_size", "_range", "_total")
    budget = slim.agg((F.sum("_size") * F.lit(float(shares.get("share", 1.5)))).alias("_budget"))
    return placed.join(F.broadcast(budget), F.col("_total") <= F.col("_budget"))  # one row
