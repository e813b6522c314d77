"""Registered queries of this subpackage: one per operator, over its whole
table, and the pipeline's oracle where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from deidlake.llm import (
    bpe, collocations, embedding_dedup, fingerprint, mixing, pii, prefix_trie, quality, simhash, substring_dedup, toxicity, url_filter, warc)
from deidlake.llm.common import table

#: Rank file of the tokenizer; a parameter, the file stays where it is.
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.components(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_substring_dedup, op3_quality, op4_pii, op5_warc, op6_simhash, op7_toxicity, op8_url_filter,
    op9_fingerprint, op10_mixing, op11_prefix_trie, op12_collocations, op13_embedding_dedup)}

SUBSTRING_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT rid, doc_id, text, i, ws[i] AS w, len(ws) AS n,
                 CASE WHEN i + 19 <= len(ws) THEN array_to_string(ws[i:i + 19], ' ') END AS g
          FROM docs, unnest(generate_series(1, len(ws))) AS t(i)),
starts AS (SELECT *, g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, text, rid, i) > 1 AS again FROM words),
marked AS (SELECT rid, i, w, max(again::INT) OVER (PARTITION BY rid ORDER BY i ROWS 19 PRECEDING) = 1 AS gone FROM starts),
kept AS (SELECT rid, count(*) FILTER (gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS t FROM marked GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""

WARC_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, CASE WHEN payload_bytes >= {warc.LEAST_REVISITED} THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS r FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN r = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN r <> page_id THEN r END AS refers_to FROM q
"""

ORACLES = {
    "op11_prefix_trie": prefix_trie.TRIE_SQL, "op12_collocations": collocations.COLLOCATIONS_SQL,
    "op13_embedding_dedup": embedding_dedup.COMPONENTS_SQL,
    "op2_substring_dedup": SUBSTRING_SQL, "op3_quality": quality.JUDGE_SQL, "op5_warc": WARC_SQL,
}
