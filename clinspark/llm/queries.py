"""The registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import (best_position, chat, exact_dedup, harmonic, mixing, packing, quality, repair, simhash, substring_dedup, suffix_dedup,
               toxicity, warc)
from .common import stage, table

CHAT_SAMPLE = "\\### Assistant: </turn> ok"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "shard")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removed(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/archives/{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = stage(warc.read_archives(spark, path), "op3-records")
    return warc.resolve(found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    sample = spark.createDataFrame([(-7, 0, "user", CHAT_SAMPLE), (-7, 1, "assistant", CHAT_SAMPLE)],
                                   "conv_id long, turn long, role string, text string")
    return chat.read_back(stage(chat.format_conversations(turns.unionByName(sample)), "op5-formatted"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op11_harmonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic.pack(table(spark, sf_dir, "documents"))


def op12_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_warc": op3_warc,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_chat": op5_chat,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_harmonic": op11_harmonic,
    "op12_best_position": op12_best_position,
    "op13_repair": op13_repair,
}

ORACLES = {
    "op3_warc": r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), r AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p
)
SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM r
""",
    "op4_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS rn
  FROM t WINDOW w AS (PARTITION BY norm ORDER BY cp DESC, doc_id ASC NULLS LAST)
)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM r
""",
    "op5_chat": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)
), w AS (
  SELECT *, regexp_replace(text, '(\\*(?:###|</turn>))', '\\\1', 'g') AS written,
         CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
                   WHEN 'tool' THEN 'Tool' ELSE '=' || url_encode(role) END AS mark
  FROM c
), a AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('### ' || mark || ': ') + length(written) + 9)::BIGINT AS formatted_chars
  FROM w GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars FROM a
""",
    "op12_best_position": r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), c AS (
  SELECT count(*) FILTER (len(terms) > 0) AS n_docs, coalesce(sum(len(terms)), 0)::BIGINT AS n_words FROM d
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), o AS (
  SELECT row_id, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT row_id, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY row_id, term
), f AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM o, c GROUP BY term
), i AS (
  SELECT row_id, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_words))) AS impact
  FROM o JOIN f USING (term), c
), s AS (
  SELECT item_id, row_id, any_value(doc_id) AS doc_id, sum(impact)::BIGINT AS score FROM q JOIN i USING (term) GROUP BY item_id, row_id
), r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
""",
}
