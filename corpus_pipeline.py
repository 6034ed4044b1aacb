"""Corpus pipeline: toxicity, n-gram Jaccard join, benchmark decontamination, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the next one's
docs. All but the last return the columns of `documents`. Every decision rests on the text alone, so rows with a null
doc_id are judged like the others; a null text is clean, like no other, and packed as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillsync.llm import decontamination, ngram_join, secret_scan, toxicity
from rillsync.llm.common import materialize, release
from rillsync.llm.packing import pack_documents
from rillsync.llm.subwords import vocabulary_path
from rillsync.sources.scratch import scratch_scope


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is predicted toxic go."""
    model = toxicity.fit_from_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of least doc_id."""
    return ngram_join.keep_one(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or nearly, go."""
    return decontamination.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    return secret_scan.redact(docs, secret_scan.fit_from_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return pack_documents(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("packing", pack),
]

#: Model scores, banding and packing are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage writes on its way goes when its result is written."""
    docs, was = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark) as keep:
            docs = keep(materialize(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        if was is not None:
            release(was)
        was = docs
    return STAGES[-1][1](spark, docs, sf_dir)
