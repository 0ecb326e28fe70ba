"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm import (
    byte_bpe, conversation_trie, decontamination, html_render, importance, language_id, language_model, quality_kernel,
    secrets_scan, simhash, token_files, topk, toxicity,
)
from ledgerlane.llm.common import held_out


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_render.rendered(table(spark, folder, "pages"))


def op3_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.scored(table(spark, folder, "documents"), held_out("doc_id", 7, 2))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), held_out("doc_id", 4, 2))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.scaled_search(table(spark, folder, "embeddings"))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets_scan.scan(table(spark, folder, "documents"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held = held_out("doc_id", 4, 2)
    return language_id.identified(documents, held).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(table(spark, folder, "conversations"))


def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    held = held_out("doc_id", 5, 0)
    found = quality_kernel.quality(table(spark, folder, "documents"), table(spark, folder, "labels"), held)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_token_files, op2_html_text, op3_lm_scores, op4_toxicity, op5_decontamination, op6_simhash, op7_top_k,
        op8_byte_bpe, op9_secrets, op10_language, op11_prefix_trie, op12_quality, op13_resampling, pipeline,
    )
}

# The others cannot be said in SQL: tests compare them with brute force, libraries and held-out rows.
# Sums of products of whole numbers are exact in doubles here, since they stay below 2^53.
ORACLE_SQL: dict[str, str] = {
    "op7_top_k": """
        WITH scaled AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS vector
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   CAST(list_inner_product(q.vector, v.vector) AS BIGINT) AS score
            FROM (SELECT DISTINCT * FROM scaled WHERE vec_id % 100 = 0) q
            JOIN scaled v ON q.vec_id <> v.vec_id AND len(q.vector) = len(v.vector))
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
        FROM scores
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 10""",
}
