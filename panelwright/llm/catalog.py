"""The registered queries of this subpackage, ``opN_<name>``, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import (
    deleted_interpolation,
    hard_negatives,
    jaccard_regions,
    line_spread,
    merkle,
    mixing,
    onebit_search,
    page_text,
    pii,
    quality,
    seed_extend,
    string_tiling,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_weak_pii(spark, sf_dir):
    """Personal data in every document."""
    return pii.find_private(table(spark, sf_dir, "documents"))


@query
def op2_mixing(spark, sf_dir):
    """Words the weighted fair mix takes of every document."""
    return mixing.allotments(table(spark, sf_dir, "documents"))


@query
def op3_quality(spark, sf_dir):
    """Compression quality score of every document."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_deleted_interpolation(spark, sf_dir):
    """Log-probability of every document."""
    return deleted_interpolation.score_texts(table(spark, sf_dir, "documents"))


@query
def op5_onebit_search(spark, sf_dir):
    """The 20 nearest vectors of every twentieth."""
    return onebit_search.nearest(table(spark, sf_dir, "embeddings"))


@query
def op6_seed_extend(spark, sf_dir):
    """Every document without the passages that a document with a smaller id has."""
    return seed_extend.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op7_line_spread(spark, sf_dir):
    """Every document without the lines that stand on many sites."""
    out = line_spread.remove_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op7_line_spread"] = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
spread AS (
  SELECT trim(line) AS bare, min(doc_id) AS first_doc FROM lines WHERE trim(line) <> ''
  GROUP BY 1 HAVING count(DISTINCT coalesce(source, '')) >= {line_spread.MIN_SITES}),
kept AS (
  SELECT doc_id, pos, line, coalesce(first_doc < doc_id, FALSE) AS gone
  FROM lines LEFT JOIN spread ON trim(line) = bare)
SELECT doc_id, CAST(count(pos) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
       CASE WHEN count(pos) > 0 THEN sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) END AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id) GROUP BY doc_id"""


@query
def op8_string_tiling(spark, sf_dir):
    """The benchmark item that each document covers most, whether that is contamination, and all items that contaminate it."""
    out = string_tiling.coverage(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), drop=("text",))
    return out.select("doc_id", "item_id", "coverage", "n_covered", (F.size("tiles") / 3).cast("int").alias("n_tiles"),
                      (F.col("coverage") >= string_tiling.COVERAGE).alias("contaminated"), "items", "item_coverage",
                      F.transform("item_tiles", lambda t: (F.size(t) / 3).cast("int")).alias("item_n_tiles"))


@query
def op10_page_text(spark, sf_dir):
    """Main text of every page."""
    return page_text.extract(table(spark, sf_dir, "pages"))


@query
def op9_jaccard_regions(spark, sf_dir):
    """Components of near-duplicate documents."""
    return jaccard_regions.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_warc(spark, sf_dir):
    """Records of all pages, read back from the archives."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ORACLES["op11_warc"] = f"""
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id, row_number() OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS k,
                  sha1(body) AS hex FROM bodies)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', CAST((CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first_id END AS refers_to
FROM firsts"""


@query
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


ORACLES["op12_hard_negatives"] = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM given a JOIN given c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


@query
def op13_merkle(spark, sf_dir):
    """Leaf, proof and check of every document."""
    return merkle.verified(table(spark, sf_dir, "documents"))


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# trees grow level by level in recursions; each leaf then walks up its two trees, keeping its siblings and the hash folded so far
ORACLES["op13_merkle"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('v' || lang, 'n') AS tree, {_leaf('n_chars')} AS leaf, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS start
  FROM (SELECT *, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
          lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc FROM documents)),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes(tree, level, pos, h, n) AS (
  SELECT tree, 0, pos, leaf, n FROM placed UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2),
subroots AS (SELECT tree, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, pos, h, n) AS (
  SELECT 0, pos, h, n FROM subroots UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM tops WHERE n > 1 GROUP BY level, pos // 2),
walk(doc_id, leaf, tree, row_pos, stage, level, pos, n, held, proof) AS (
  SELECT doc_id, leaf, tree, pos, 0, 0, pos, n, start, '' FROM placed UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.row_pos, CASE WHEN w.n > 1 THEN w.stage ELSE 1 END, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END,
         CASE WHEN w.n > 1 THEN w.pos // 2 ELSE t.pos END, CASE WHEN w.n > 1 THEN (w.n + 1) // 2 ELSE t.n END,
         CASE WHEN w.n > 1 THEN sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(s.h, u.h, '') || w.held ELSE w.held || coalesce(s.h, u.h, '') END) ELSE w.held END,
         CASE WHEN w.n > 1 THEN w.proof || coalesce(s.h, u.h, '') ELSE w.proof END
  FROM walk w JOIN subroots t ON t.tree = w.tree
  LEFT JOIN nodes s ON w.stage = 0 AND w.n > 1 AND s.tree = w.tree AND s.level = w.level AND s.pos = xor(w.pos, CAST(1 AS BIGINT))
  LEFT JOIN tops u ON w.stage = 1 AND w.n > 1 AND u.level = w.level AND u.pos = xor(w.pos, CAST(1 AS BIGINT))
  WHERE w.n > 1 OR w.stage = 0)
SELECT doc_id, leaf, t.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, held AS folded_root, held = r.h AS verified
FROM walk w JOIN subroots t ON t.tree = w.tree, (SELECT h FROM tops WHERE n = 1) r WHERE w.stage = 1 AND w.n = 1"""
