"""Queries of the training-data operators over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quern.llm import alignment, bpe, capfilters, decontaminate, langid, lm, periodic, secrets, simhash, substrings, tokencount, topk, urls

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_of_documents(_table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(_table(spark, sf_dir, "documents"))


def op5_class_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), urls.labelled_urls(spark))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op8_section_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.section_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.embedding_top_k(_table(spark, sf_dir, "embeddings"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.near_vectors(_table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, two = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.aligned_documents(_table(spark, sf_dir, "documents"), one, two, public_tokenizers.PATTERN)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_language_id, op3_simhash_near_dedup, op4_secret_scan, op5_class_lm_score, op6_url_filter, op7_suffix_dedup, op8_section_token_counts, op9_bpe_encode_decode, op10_exact_top_k,
        op11_embedding_near_dedup, op12_periodic_runs, op13_token_alignment,
    )
}

#: SQL for what SQL can express: exact search is the only one.
ORACLES: dict[str, str] = {
    "op10_exact_top_k": """WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
