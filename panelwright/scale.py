"""Size-checked joins and exact order statistics that do not gather a hot group.

A series is bounded by the calendar (one row per day), so per-series windows are
safe. Groups that cut across series (a category on one day, a forecast step over
all series, a whole column) are not bounded, and go through the helpers here.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows up to which a table may be broadcast. The check counts at most this many rows plus one.
BROADCAST_ROWS = 1_000_000
# Rows of one group up to which a single task may order the group directly.
GROUP_ROWS = 1_000_000
# Values of a column up to which an exact percentile may hold them all in one task.
EXACT_VALUES = 50_000
# Slices of a larger group for each multiple of the limit.
SLICES_PER_LIMIT = 4
# Rows of one key that a join by shuffle leaves together, and the spread of rows without a key.
HOT_ROWS = 100_000
SALTS = 32


def at_most(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has no more than ``limit`` rows; stops counting just above it."""
    return df.limit(limit + 1).count() <= limit


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the session names. Where it names none, a temporary one, but only if all runs on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master!r})")
        base = tempfile.mkdtemp(prefix="panelwright-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet into the checkpoint folder and read it back.

    Cuts the lineage in a way that survives lost executors, and lets later passes
    read only the columns they need.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/panel-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for held in _open_work:
        held.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_open_work: list[list[str]] = []


@contextmanager
def work_tables(spark: SparkSession):
    """Remove, at the end, all tables that ``written`` made meanwhile. Results must have been stored by then."""
    held: list[str] = []
    _open_work.append(held)
    try:
        yield
    finally:
        _open_work.remove(held)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in held:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def attach(df: DataFrame, stats: DataFrame, keys: list[str], limit: int | None = None,
           small: bool = False) -> DataFrame:
    """Left-join one-row-per-key ``stats`` onto ``df``.

    The table is broadcast after its row count has been checked, so ``df`` is not
    shuffled. A larger table is joined by shuffle. Keys with more than ``HOT_ROWS`` rows in ``df`` are counted first; only
    these get a salt, of as many values as their size needs, and only their rows of ``stats`` are copied. Rows with a NULL
    key match nothing and are spread. ``small`` skips the count when the caller has already bounded the table.
    """
    limit = BROADCAST_ROWS if limit is None else limit
    if small or at_most(stats.select(*keys), limit):
        return df.join(F.broadcast(stats), keys, "left")
    hot = written(df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS)
                  .select(*keys, F.ceil(F.col("_n") / HOT_ROWS).cast("int").alias("_salts")))
    # fewer than rows / HOT_ROWS of them; still checked
    hot = F.broadcast(hot) if at_most(hot, BROADCAST_ROWS) else hot
    one = F.coalesce("_salts", F.lit(1))
    copied = stats.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1))).drop("_salts")
    missing = F.greatest(*[F.col(k).isNull().cast("int") for k in [*keys, keys[0]]]) == 1
    dealt = F.xxhash64(*df.columns)
    spread = df.join(hot, keys, "left").withColumn("_salt", F.pmod(dealt, F.when(missing, F.lit(SALTS)).otherwise(one)).cast("int")).drop("_salts")
    return spread.join(copied.hint("merge"), [*keys, "_salt"], "left").drop("_salt")


def attach_series(df: DataFrame, stats: DataFrame, key: str, limit: int | None = None, small: bool = False) -> DataFrame:
    """Left-join one row per series. Broadcast after a row count (``small``: the caller's); otherwise a plain join on the
    series id, whose rows are bounded by the calendar and which the windows hash by as well."""
    small = small or at_most(stats.select(key), BROADCAST_ROWS if limit is None else limit)
    return df.join(F.broadcast(stats) if small else stats, key, "left")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name``, the place of each row along ``order`` from 0, without a task that holds all rows; written.

    Rows are range-sorted and counted by range. Ranges grow as the square root of the table, which keeps both their rows and the list
    of their starts moderate. Rows that agree in ``order`` are numbered in no particular order.
    """
    held = written(df.withColumn("_uid", F.monotonically_increasing_id()))
    ranges = max(1, int(held.count() ** 0.5) // 32)
    ranged = written(held.repartitionByRange(ranges, *order, "_uid").sortWithinPartitions(*order, "_uid")
                     .withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)).drop("_uid"))
    starts = ranged.groupBy("_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_many"))
    before = F.sum("_many").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = written(starts.select("_range", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift")))
    return written(ranged.join(F.broadcast(starts), "_range").withColumn(name, F.col("_at") + F.col("_shift")).drop("_range", "_at", "_shift"))


def biggest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest group (a map-side combined count, one number to the driver)."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if keys else df.agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.max("n")).first()[0] or 0


def value_positions(df: DataFrame, keys: list[str], value: str, limit: int | None = None) -> DataFrame:
    """Exact order positions of the distinct non-null values within each group.

    Returns ``keys, value, _cnt, _before, _total``: how often the value occurs,
    how many rows of the group are smaller, and the group's non-null row count.
    Rows are first reduced to distinct values. When a group still exceeds
    ``limit``, its values are cut into slices at sketched quantiles, positions
    are taken inside each slice and shifted by the size of the slices before it.
    The sketch only balances the slices; the positions are exact whatever it says.
    """
    limit = GROUP_ROWS if limit is None else limit
    seen = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_cnt"))
    ordered = Window.partitionBy(*keys).orderBy(value)
    up_to = Window.unboundedPreceding
    biggest = biggest_group(seen, keys)
    if biggest <= limit:
        return seen.withColumns({
            "_before": F.coalesce(F.sum("_cnt").over(ordered.rowsBetween(up_to, -1)), F.lit(0)),
            "_total": F.sum("_cnt").over(Window.partitionBy(*keys))})
    slices = SLICES_PER_LIMIT * -(-biggest // limit)
    cuts = [F.lit(i / slices) for i in range(1, slices)]
    fences = seen.groupBy(*keys).agg(F.percentile_approx(value, F.array(*cuts), F.lit(1000)).alias("_fences"))
    sliced = attach(seen, fences, keys).withColumn(
        "_slice", F.size(F.filter("_fences", lambda f: f < F.col(value)))).drop("_fences")
    offsets = sliced.groupBy(*keys, "_slice").agg(F.sum("_cnt").alias("_slice_cnt"))
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    offsets = offsets.select(
        *keys, "_slice",
        F.coalesce(F.sum("_slice_cnt").over(by_slice.rowsBetween(up_to, -1)), F.lit(0)).alias("_offset"),
        F.sum("_slice_cnt").over(Window.partitionBy(*keys)).alias("_total"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(value)
    placed = sliced.withColumn("_in", F.coalesce(F.sum("_cnt").over(inside.rowsBetween(up_to, -1)), F.lit(0)))
    return (attach(placed, offsets, [*keys, "_slice"])
            .withColumn("_before", F.col("_in") + F.col("_offset"))
            .select(*keys, value, "_cnt", "_before", "_total"))


def group_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                    limit: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles per group as ``{name: probability}`` columns."""
    limit = GROUP_ROWS if limit is None else limit
    if biggest_group(df, keys) <= limit:
        return df.groupBy(*keys).agg(*[F.percentile(value, F.lit(p)).alias(n) for n, p in probs.items()])
    placed = value_positions(df, keys, value, limit)

    def at(rank: Column) -> Column:
        inside = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_cnt"))
        return F.max(F.when(inside, F.col(value)))

    out = []
    for name, p in probs.items():
        rank = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = at(F.floor(rank)), at(F.ceil(rank))
        part = F.max(rank - F.floor(rank))
        out.append((low + (high - low) * part).alias(name))
    return placed.groupBy(*keys).agg(*out)


def column_medians(df: DataFrame, columns: list[str], limit: int | None = None,
                   counts: dict[str, int] | None = None) -> dict[str, float | None]:
    """Exact median of each column (NULL skipped), for tables of any size.

    An exact percentile keeps every distinct value in one task, so it is used only
    where the distinct values fit ``limit``. Otherwise sketched quantiles give a narrow
    bracket around the middle ranks, an exact count of the rows below and inside
    proves it, and the loop goes on inside the bracket. Every pass is one scan for
    all columns and returns a few numbers per column. ``counts`` are the non-null rows, where known.
    """
    limit = EXACT_VALUES if limit is None else limit
    if not columns:
        return {}
    n = counts or df.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    result: dict[str, float | None] = {c: None for c in columns}
    # middle ranks (0-based) still open, values found for the others, rows below the bracket,
    # rows inside it, distinct values inside it, and the bracket as a condition
    state = {c: {"ranks": sorted({(n[c] - 1) // 2, n[c] // 2}), "found": [], "below": 0, "held": n[c],
                 "distinct": n[c], "slack": 0.002, "in": F.col(c).isNotNull()} for c in columns if n[c]}
    while state:
        ready = [c for c, s in state.items() if s["distinct"] <= limit]
        if ready:
            held = df.select(*[F.when(state[c]["in"], F.col(c)).alias(c) for c in ready])
            row = held.agg(*[_nth(c, state[c], rank).alias(f"{c}:{rank}") for c in ready for rank in state[c]["ranks"]]).first()
            for c in ready:
                s = state.pop(c)
                found = s["found"] + [float(row[f"{c}:{rank}"]) for rank in s["ranks"]]
                result[c] = sum(found) / len(found)
        if not state:
            break
        edges = df.agg(*[F.percentile_approx(F.when(s["in"], F.col(c)), F.array(
            F.lit(max(0.0, (s["ranks"][0] - s["below"]) / s["held"] - s["slack"])),
            F.lit(min(1.0, (s["ranks"][-1] - s["below"]) / s["held"] + s["slack"]))), F.lit(1000)).alias(c)
            for c, s in state.items()]).first()
        inner = {c: s["in"] & (F.col(c) > F.lit(edges[c][0])) & (F.col(c) < F.lit(edges[c][1])) for c, s in state.items()}
        row = df.agg(*[x for c, s in state.items() for x in (
            F.count(F.when(s["in"] & (F.col(c) < F.lit(edges[c][0])), 1)).alias(f"b_{c}"),
            F.count(F.when(s["in"] & (F.col(c) == F.lit(edges[c][0])), 1)).alias(f"l_{c}"),
            F.count(F.when(inner[c], 1)).alias(f"i_{c}"),
            F.count(F.when(s["in"] & (F.col(c) == F.lit(edges[c][1])), 1)).alias(f"h_{c}"),
            F.approx_count_distinct(F.when(inner[c], F.col(c))).alias(f"d_{c}"))]).first()
        for c, s in list(state.items()):
            start = s["below"] + row[f"b_{c}"]                  # first rank on the lower edge
            inside = start + row[f"l_{c}"]                      # first rank above it
            upper = inside + row[f"i_{c}"]                      # first rank on the upper edge
            end = inside if edges[c][0] == edges[c][1] else upper + row[f"h_{c}"]
            if s["ranks"][0] < start or s["ranks"][-1] >= end:
                s["slack"] *= 4    # the sketch missed a middle rank: widen and look again
                continue
            # ranks on an edge are settled, so the bracket loses its edges in every pass
            for rank in list(s["ranks"]):
                if not inside <= rank < upper:
                    s["found"].append(float(edges[c][0 if rank < inside else 1]))
                    s["ranks"].remove(rank)
            if s["ranks"]:
                s.update({"below": inside, "held": row[f"i_{c}"], "distinct": row[f"d_{c}"], "in": inner[c]})
            else:
                result[c] = sum(s["found"]) / len(s["found"])
                del state[c]
    return result


def sketched_medians(df: DataFrame, columns: list[str], accuracy: int = 10_000) -> tuple[dict[str, int], dict[str, float | None]]:
    """Rows with a value, with the table's row count under ``""``, and an approximate median of each column, from one scan.

    Quantile sketches of all columns are merged like counts. The median given is a value whose rank is off by ``1 / accuracy`` of the
    column's rows at most.
    """
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
                 *[F.percentile_approx(c, F.lit(0.5), F.lit(accuracy)).alias(f"m_{i}") for i, c in enumerate(columns)]).first()
    medians = {c: None if row[f"m_{i}"] is None else float(row[f"m_{i}"]) for i, c in enumerate(columns)}
    return {"": row["_rows"]} | {c: row[f"n_{i}"] for i, c in enumerate(columns)}, medians


def _nth(column: str, state: dict, rank: int) -> Column:
    """The value at a 0-based rank of the whole column, read inside its bracket."""
    level = (rank - state["below"] + 0.5) / state["held"]
    return F.expr(f"percentile_disc({level!r}D) WITHIN GROUP (ORDER BY `{column}`)")
