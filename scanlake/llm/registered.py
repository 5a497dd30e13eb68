"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from scanlake.llm import byte_bpe, exact_dedup, hard_negatives, language, licences, minhash, mixing, outliers, pii, prefix_trie, quality, secrets_scan, simhash
from scanlake.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op7_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY normal ORDER BY doc_id DESC) = 1 AS kept, sha256(normal) AS text_sha256
FROM (SELECT doc_id, {LOWER} AS normal FROM documents) texts
WINDOW same AS (PARTITION BY normal)"""


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id", "n_links")


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = byte_bpe.encoded(documents(spark, sf_dir), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)
    return byte_bpe.digests(rows).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found, weight, drawn, stays = quality.resampled(documents(spark, sf_dir), labels, carry=False)
    return found.select("doc_id", weight, drawn, stays)


QUERIES["pipeline"] = corpus_pipeline.run


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.digests(secrets_scan.secrets(documents(spark, sf_dir)))


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.personal_data(documents(spark, sf_dir)))


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(documents(spark, sf_dir))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judged(documents(spark, sf_dir))


@query
def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scanned(documents(spark, sf_dir))
    return found.withColumn("families", F.array_join("families", ","))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: CRC-32 of a decimal number, bit by bit: eight steps for each of its characters.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1)) + z)), 4294967295::BIGINT)"""

ORACLE_SQL["op12_prefix_trie"] = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT c, c - c % 100 AS base, {CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id AS c FROM own)
), turns AS (
  SELECT c, 0 AS part, pos, role, text FROM ids JOIN own ON conv_id = base AND pos <= h
  UNION ALL SELECT c, 1, pos, role, text FROM ids JOIN own ON conv_id = c AND pos > h
), numbered AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, struct_pack(role := role, text := text) AS turn FROM turns
), pre AS (
  SELECT c, d, list(turn) OVER (PARTITION BY c ORDER BY d) AS key FROM numbered
  UNION ALL SELECT c, 0, CAST([] AS STRUCT(role VARCHAR, text VARCHAR)[]) FROM ids
), whole AS (SELECT c, max(d) AS length FROM pre GROUP BY c), nodes AS (
  SELECT d, key, min(c) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE length(key[-1].text) END AS chars,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = length), '')) AS ends_sha256
  FROM pre JOIN whole USING (c) GROUP BY d, key
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.key = n.key[1:n.d - 1]
), children AS (
  SELECT d - 1 AS d, key[1:d - 1] AS key, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), full_nodes AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (d, key)
), below AS (
  SELECT pre.d, pre.key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens
  FROM full_nodes q JOIN pre ON pre.c = q.conv_id AND pre.d <= q.d GROUP BY pre.d, pre.key
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM full_nodes JOIN below USING (d, key)"""


@query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(documents(spark, sf_dir))


ORACLE_SQL["op11_minhash"] = rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
), single AS (SELECT r, unnest(s) AS v FROM sets), common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS n FROM single a JOIN single b USING (v) WHERE a.r < b.r GROUP BY a.r, b.r
), links AS (
  SELECT a, b FROM common JOIN sets x ON x.r = a JOIN sets y ON y.r = b WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links), reach AS (
  SELECT r AS a, r AS b FROM sets UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.b
), lowest AS (SELECT reach.a AS r, min(doc_id) AS component_id FROM reach JOIN sets ON sets.r = reach.b GROUP BY reach.a)
SELECT doc_id, len(s) AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept FROM sets JOIN lowest USING (r)"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), "embedding")
    found = hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0, "vec_id", "label", "embedding")
    return found.withColumn("rank", F.col("rank").cast("int"))


ORACLE_SQL["op13_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER best <= 5
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)"""
