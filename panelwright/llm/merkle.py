"""Merkle manifest of a table of documents, with an octopus multiproof for the leaves of each partition.

Every document is a leaf, every ``lang`` a tree over its leaves in order of ``doc_id``, and the
trees' roots are the leaves of one last tree. Trees grow in rounds of aligned blocks. For a proof,
a partition of leaves names the nodes that it cannot derive from its own leaves (the minimal
union over all its paths), these are fetched in one join, and the proofs of its leaves
are expanded from them and the shared interior nodes inside the task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.scale import BROADCAST_ROWS, at_most, attach, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# A block of a growing tree and a partition of leaves hold 2**BITS nodes at most.
BITS = 10
# The tree over the trees' roots. A tree's key is "n" for NULL and "v" before any other value, so that keys sort like values.
TOP = "t"

_NODES = "tree string, level int, pos long, n long, h string"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: ``doc_id, tree, leaf, tampered, pos, n``; ``nodes``: ``tree, level, pos, n, h``, all levels above the leaves;
    ``trees``: ``tree, subroot, tree_pos, n_trees``; ``root``: NULL for an empty table."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: str | None


def joined_hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(values: dict[str, Column]) -> Column:
    """Hash of the fields: ``-`` for NULL, else the UTF-8 length, ``:`` and the value."""
    out = []
    for name in FIELDS:
        text = values[name].cast("string")
        out.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return joined_hash(*out)


def leaf_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, leaf, tampered, _uid``, written. ``tampered`` is the leaf with ``n_chars`` raised by one
    where 7 divides the checksum of the id, else NULL."""
    given = {c: F.col(c) for c in FIELDS}
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return written(docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.concat(F.lit("v"), "lang"), F.lit("n")).alias("tree"),
        leaf_hash(given).alias("leaf"), F.when(hit, leaf_hash(given | {"n_chars": more})).alias("tampered"),
        F.monotonically_increasing_id().alias("_uid")))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, the place of a row in its ``tree`` along ``order``, and ``n``, the tree's rows; written.

    Rows are range-sorted, so a tree with most of the rows lies in many ranges. Ranges grow as the square root
    of the table, which keeps both their rows and the list of their starts moderate.
    """
    ranges = max(1, int(rows.count() ** 0.5) // 32)
    ranged = written(rows.repartitionByRange(ranges, "tree", *order).sortWithinPartitions("tree", *order)
                     .withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)))
    starts = ranged.groupBy("tree", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_many"))
    whole = Window.partitionBy("tree")
    before = F.sum("_many").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select("tree", "_range", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
                           F.sum("_many").over(whole).alias("n"))
    out = attach(ranged, written(starts), ["tree", "_range"])
    return written(out.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift"))


def _above(hashes: list[str]) -> list[str]:
    return [hashlib.sha256("".join(hashes[i:i + 2]).encode()).hexdigest() for i in range(0, len(hashes), 2)]


def _grow_block(part: pd.DataFrame, levels: int) -> pd.DataFrame:
    """The nodes of so many levels above one aligned block, or up to the tree's root."""
    part = part.sort_values("pos")
    tree, level, first, n = part["tree"].iloc[0], int(part["level"].iloc[0]), int(part["pos"].iloc[0]), int(part["n"].iloc[0])
    hashes, out = part["h"].tolist(), []
    for _ in range(levels):
        if n == 1:
            break
        hashes, level, first, n = _above(hashes), level + 1, first // 2, -(-n // 2)
        out += [(tree, level, first + i, n, h) for i, h in enumerate(hashes)]
    return pd.DataFrame(out, columns=["tree", "level", "pos", "n", "h"])


def grown(bottom: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes above the leaves ``tree, pos, n, h``, and the root of each tree: ``tree, h``.

    A round takes 2**BITS leaves to one node, so ten thousand million leaves take four rounds.
    """
    current = bottom.select("tree", F.lit(0).alias("level"), "pos", "n", "h")
    rounds, roots, bits = [], [current.where("n = 1")], BITS
    while True:
        current = current.where("n > 1")
        if current.isEmpty():
            break
        nodes = written(current.withColumn("_block", F.shiftright("pos", bits)).groupBy("tree", "_block")
                        .applyInPandas(lambda part: _grow_block(part, bits), _NODES))
        rounds.append(nodes)
        roots.append(nodes.where("n = 1"))
        current = nodes.where(F.col("level") == len(rounds) * bits)
    every = rounds[0] if rounds else bottom.sparkSession.createDataFrame([], _NODES)
    for more in rounds[1:]:
        every = every.unionByName(more)
    tops = roots[0]
    for more in roots[1:]:
        tops = tops.unionByName(more)
    return every, tops.select("tree", "h")


def build(docs: DataFrame) -> Manifest:
    """The manifest of a table with the columns ``doc_id, source, lang, n_chars, text``; other columns are left aside.

    NULL fields are hashed as ``-``, a NULL ``lang`` is a tree, the first. In a tree leaves ascend by ``doc_id``, NULL first;
    rows that repeat an id follow their hash, and repeated rows are leaves of their own.
    """
    leaves = placed(leaf_rows(docs), ["doc_id", "leaf", "_uid"]).drop("_uid")
    nodes, subroots = grown(leaves.select("tree", "pos", "n", F.col("leaf").alias("h")))
    trees = placed(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("below"), "h"), ["below"])
    top_nodes, root = grown(trees)
    first = root.first()
    return Manifest(leaves, nodes.unionByName(top_nodes),
                    trees.select(F.col("below").alias("tree"), F.col("h").alias("subroot"), F.col("pos").alias("tree_pos"), F.col("n").alias("n_trees")),
                    None if first is None else first["h"])


def missing(places: list[int], n: int) -> list[tuple[int, int]]:
    """``(level, pos)`` of the nodes that the paths from ``places`` need and cannot derive, in a tree of ``n`` leaves."""
    out, level, held = [], 0, set(places)
    while n > 1:
        out += [(level, p ^ 1) for p in sorted(held) if p ^ 1 not in held and p ^ 1 < n]
        held, level, n = {p // 2 for p in held}, level + 1, -(-n // 2)
    return out


def _ask(part: pd.DataFrame) -> pd.DataFrame:
    one = part.iloc[0]
    own = [(one["tree"], level, pos) for level, pos in missing(part["pos"].tolist(), int(one["n"]))]
    top = [(TOP, level, pos) for level, pos in missing([int(one["tree_pos"])], int(one["n_trees"]))]
    return pd.DataFrame([(one["tree"], one["part"], *x) for x in own + top], columns=["tree", "part", "of", "level", "pos"])


def _paths(hashes: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> dict[int, list[str]]:
    """For each place its siblings from the bottom up: ``L`` or ``R`` before the hash, nothing where a node is alone."""
    paths: dict[int, list[str]] = {p: [] for p in hashes}
    level, shift = 0, {p: p for p in hashes}
    while n > 1:
        hashes = hashes | {p: h for (at, p), h in fetched.items() if at == level}
        for p, path in paths.items():
            sibling = shift[p] ^ 1
            path.append("" if sibling >= n else ("L" if sibling < shift[p] else "R") + hashes[sibling])
            shift[p] //= 2
        parents = set(shift.values())
        hashes = {q: hashlib.sha256((hashes[2 * q] + hashes.get(2 * q + 1, "")).encode()).hexdigest() for q in parents}
        level, n = level + 1, -(-n // 2)
    return paths


def _expand(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    one, own, top = part.iloc[0], {}, {}
    for of, level, pos, h in zip(answers["of"], answers["level"], answers["pos"], answers["h"]):
        (top if of == TOP else own)[level, pos] = h
    paths = _paths(dict(zip(part["pos"].tolist(), part["leaf"])), own, int(one["n"]))
    above = _paths({int(one["tree_pos"]): one["subroot"]}, top, int(one["n_trees"]))[int(one["tree_pos"])]
    return pd.DataFrame({"doc_id": part["doc_id"], "leaf": part["leaf"], "tampered": part["tampered"], "subroot": part["subroot"],
                         "proof": [paths[p] + above for p in part["pos"].tolist()]})


def prove(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """``doc_id, leaf, tampered, subroot, proof`` for ``leaves`` (rows of the manifest's leaves; all, if not given).

    ``proof`` lists, level by level up to the root, the sibling's hash after ``L`` or ``R``, the side it stands on, or
    an empty text where the node has none. A partition holds 2**BITS neighbouring leaves at most, whatever the tree.
    """
    chosen = manifest.leaves if leaves is None else leaves
    chosen = attach(chosen, manifest.trees, ["tree"]).withColumn("part", F.shiftright("pos", BITS))
    asked = written(chosen.select("tree", "part", "pos", "n", "tree_pos", "n_trees").groupBy("tree", "part")
                    .applyInPandas(_ask, "tree string, part long, of string, level int, pos long"))
    place = ["of", "level", "pos"]
    bottom = manifest.leaves.select("tree", F.lit(0).alias("level"), "pos", F.col("leaf").alias("h"))
    tops = manifest.trees.select(F.lit(TOP).alias("tree"), F.lit(0).alias("level"), F.col("tree_pos").alias("pos"), F.col("subroot").alias("h"))
    nodes = manifest.nodes.select("tree", "level", "pos", "h").unionByName(bottom).unionByName(tops).withColumnRenamed("tree", "of")
    # each node is fetched once, and only then handed to the many partitions that named it
    wanted = asked.select(*place).distinct()
    met = nodes.join(F.broadcast(wanted) if at_most(wanted, BROADCAST_ROWS) else wanted, place)
    answers = attach(asked, written(met), place)
    return chosen.groupBy("tree", "part").cogroup(answers.groupBy("tree", "part")).applyInPandas(
        _expand, "doc_id long, leaf string, tampered string, subroot string, proof array<string>")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    def step(held: Column, item: Column) -> Column:
        other = F.substring(item, 2, 64)
        return (F.when(F.startswith(item, F.lit("L")), joined_hash(other, held))
                .when(F.startswith(item, F.lit("R")), joined_hash(held, other)).otherwise(joined_hash(held)))
    return F.aggregate(proof, leaf, step)


def verified(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    The proof is made of the untampered table; ``folded_root`` starts at the tampered leaf where there is one. A lone
    document is its own root and its proof is empty. An empty table has no rows.
    """
    manifest = build(docs)
    siblings = F.array_join(F.transform("proof", lambda x: F.substring(x, 2, 64)), "")
    return prove(manifest).select(
        "doc_id", "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"), F.sha2(siblings, 256).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
