"""The driver's queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillsync.llm import decontamination, embedding_dedup, language_id, ngram_join, oracles, secret_scan, substring_dedup, token_codec, toxicity
from rillsync.llm.packing import pack_documents
from rillsync.llm.subwords import vocabulary_path
from rillsync.llm.token_counts import count_tokens


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_spans(_read(spark, sf_dir, "documents"))


def op1_whole_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op1_substring_dedup, whose SQL states which runs it finds, with the lines and ends that those lose."""
    return substring_dedup.repeated_spans(_read(spark, sf_dir, "documents"), cut_text=substring_dedup.whole_runs)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return secret_scan.scan(documents, secret_scan.fit_from_documents(documents))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_read(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return language_id.identify(documents, language_id.fit_from_documents(documents))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_links(_read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return toxicity.score_documents(documents, toxicity.fit_from_labels(documents, _read(spark, sf_dir, "labels")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codec.round_trip(_read(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {
        f.__name__: f for f in (
            op1_substring_dedup, op1_whole_dedup, op2_secret_scan, op3_packing, op4_language_id, op5_token_counts,
            op6_ngram_join, op7_toxicity, op8_decontamination, op9_token_output, op10_embedding_dedup
        )
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
