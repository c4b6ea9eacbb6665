"""The operators over the whole test tables, with production parameters."""

from pyspark.sql import DataFrame, SparkSession

from aftermath.llm import (
    chaining,
    chat,
    decontaminate,
    mixing,
    negatives,
    quality,
    secret_scan,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    warc_zip,
    whitening,
)
from aftermath.llm.shared import table

SHARDS = 16


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc_zip.round_trip(table(spark, folder, "pages"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.deduplicated(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    tree = sharding.even_tree(SHARDS)
    return sharding.sharded(table(spark, folder, "documents"), tree, sharding.grown(tree, SHARDS))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


def op9_chaining(spark: SparkSession, folder: str) -> DataFrame:
    return chaining.repeated_passages(table(spark, folder, "documents"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def op12_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts look like control strings."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hostile = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", hostile), (-7, 1, "assistant", hostile)], "conv_id long, turn long, role string, text string")
    return chat.round_trip(rows.unionByName(added))


def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mined(table(spark, folder, "embeddings"))


# The 160 bits of a SHA-1 are 32 letters: every five hexadecimal digits are four.
OP1_WARC = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
),
owned AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS owner FROM rows)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
         1 + ((CAST('0x' || substr(digest, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31)
         AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM owner AND owner IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM owner THEN owner END AS refers_to
FROM owned"""

# Markers of the template, with the blanks and line breaks around a turn's text.
OP12_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
written AS (
  SELECT *, CASE role WHEN 'system' THEN 14 WHEN 'user' THEN 16 WHEN 'assistant' THEN 10 ELSE 17 + length(role) END
            + length(text) + len(regexp_extract_all(text, '<\\*(s>|/s>)|\[\\*(SYS\]|/SYS\]|INST\]|/INST\]|TURN\]|/TURN\])')) AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id"""

OP13_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INT) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10"""

# name: (query, SQL or None)
QUERIES = {
    "op1_warc": (op1_warc, OP1_WARC),
    "op2_toxicity": (op2_toxicity, None),
    "op3_simhash": (op3_simhash, None),
    "op4_suffixes": (op4_suffixes, None),
    "op5_sharding": (op5_sharding, None),
    "op6_secrets": (op6_secrets, None),
    "op7_mixing": (op7_mixing, None),
    "op8_quality": (op8_quality, None),
    "op9_chaining": (op9_chaining, None),
    "op10_decontamination": (op10_decontamination, None),
    "op11_whitening": (op11_whitening, None),
    "op12_chat": (op12_chat, OP12_CHAT),
    "op13_negatives": (op13_negatives, OP13_NEGATIVES),
}
