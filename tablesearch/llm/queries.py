"""The registered queries of this subpackage: each applies one operation to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, embeddings, langid, simhash, substrings, toxicity
from .bpe import bpe_round_trip
from .pii import find_pii
from .token_counts import count_tokens
from .token_files import new_folder, read_token_files, write_token_files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), details=False)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_held_out(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(_table(spark, sf_dir, "documents"), details=False)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder := new_folder(spark), end_id=1)
    return read_token_files(spark, folder, "ids_crc32")


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_substring_dedup, op3_token_counts, op4_simhash, op5_language_id, op6_toxicity, op7_byte_bpe, op8_decontamination, op9_pii, op10_token_files)}
#: DuckDB SQL for those whose results SQL can express.
SQL: dict[str, str] = {
    "op1_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) / (sqrt(list_sum(list_transform(a.e, lambda x: x * x))) * sqrt(list_sum(list_transform(b.e, lambda x: x * x)))) >= 0.95
), r AS (
  SELECT vec_id AS node, vec_id AS reached FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON r.reached = l.a
)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT node, min(reached) AS component_id FROM r GROUP BY node) c ON c.node = e.vec_id
""",
    "op2_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS run FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
), r AS (
  SELECT doc_id, i FROM g JOIN (SELECT run, min(doc_id) AS low FROM g GROUP BY run) USING (run) WHERE low < doc_id
), c AS (
  SELECT DISTINCT doc_id, i + j AS pos FROM r, (SELECT unnest(range(13)) AS j)
), k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w) ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id
)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
""",
}
