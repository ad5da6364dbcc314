"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.llm.common import read_table
from logsift.llm.decontaminate import decontaminate
from logsift.llm.embedding_dedup import embedding_dedup
from logsift.llm.hard_negatives import mine_hard_negatives
from logsift.llm.jaccard_join import jaccard_join
from logsift.llm.licenses import scan_licenses
from logsift.llm.quality import classify
from logsift.llm.sentencepiece_codec import round_trip
from logsift.llm.sharding import shard_by_bytes
from logsift.llm.substring_dedup import remove_repeats
from logsift.llm.suffix_tree_lm import lm_scores
from logsift.llm.token_alignment import align_tokens
from logsift.llm.token_counts import count_tokens
from logsift.llm.token_files import token_files_digest

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("spans")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"), PIECES)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read_table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), WORD_BPE)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files_digest(read_table(spark, sf_dir, "documents"), BYTE_BPE)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read_table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op10_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(read_table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).drop("spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate, op2_jaccard_join, op3_sentencepiece, op4_embedding_dedup, op5_token_counts, op6_token_files,
        op7_quality, op8_sharding, op9_licenses, op10_suffix_tree_lm,
        op11_hard_negatives, op12_token_alignment, op13_substring_dedup)
}

# Words of a text: A-Z lower-cased, runs of digits, a-z and non-ASCII characters.
_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS MATERIALIZED (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, w[i : i + least(13, len(w)) - 1] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
places AS MATERIALIZED (
  SELECT doc_id, n, i, w[i : i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS MATERIALIZED (SELECT doc_id, item_id, i, p.n AS n FROM places p JOIN win USING (n, win)),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS listed
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op2_jaccard_join": f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, w[i : i + 4] AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id WHERE 5 * c >= 4 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a),
class AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY w) END AS class_id FROM d)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, component_id, component_id = doc_id AS kept
FROM class JOIN comp USING (doc_id) LEFT JOIN degree USING (doc_id)
""",
    "op4_embedding_dedup": """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
usable AS MATERIALIZED (
  SELECT * FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(x, lambda c: c <> 0)) > 0),
link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM comp LEFT JOIN degree USING (vec_id)
""",
    "op13_substring_dedup": """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS MATERIALIZED (SELECT r, i, w[i : i + 34] AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
repeated AS (SELECT r, i FROM win JOIN (SELECT s FROM win GROUP BY s HAVING count(*) > 1) USING (s)),
gone AS MATERIALIZED (SELECT r, list(DISTINCT k) AS ks FROM (SELECT r, unnest(range(i, i + 35)) AS k FROM repeated) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ks IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ks, i)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
""",
    "op11_hard_negatives": """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY a.r, a.label = b.label ORDER BY list_inner_product(a.q, b.q) DESC, b.vec_id) AS nth
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.q) = len(b.q)),
found AS (
  SELECT p.a, p.anchor_id, p.id AS positive_id, p.nth, p.score AS positive_score, n.id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.nth ORDER BY n.score DESC, n.id) AS rank
  FROM scored p JOIN scored n ON p.a = n.a AND p.same AND NOT n.same AND p.nth <= 5
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3
""",
}
