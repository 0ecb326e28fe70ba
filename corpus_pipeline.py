"""Training-corpus pipeline: each stage's output is stored as Parquet and is the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm import byte_bpe, decontamination, language_id, secrets_scan, simhash
from ledgerlane.llm.common import held_out, spare, work_folder

LEAST_COSINE = 0.05


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language; lang becomes the language found.

    Goes: null text, no letter, or a cosine below ``LEAST_COSINE`` with every language, which means
    letter sequences like none of the languages learned.
    """
    known = language_id.prototypes(docs.where(~held_out("doc_id", 4, 2)))
    predicted, cosine = spare(docs.columns, "predicted", "cosine")
    found = language_id.with_language(docs, known, predicted, cosine)
    kept = found.where((F.col(predicted) != language_id.UNDETERMINED) & (F.col(cosine) >= LEAST_COSINE))
    return kept.select(*[
        F.col(predicted).alias("lang") if name == "lang" else F.col(f"`{name}`") for name in docs.columns
    ])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest doc_id of each group of near duplicates."""
    return simhash.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace live secrets in the texts; no document goes."""
    return secrets_scan.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, lang, source, ids, and the text decoded from the ids."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encoded(docs, path, public_tokenizers.PATTERN, ("doc_id", "lang", "source"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the last one's stored result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = work_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs


# Learned languages, Hamming components and byte merges cannot be said in SQL; tests use brute force.
ORACLE_SQL = None
