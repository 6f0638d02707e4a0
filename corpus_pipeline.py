"""Corpus pipeline over the documents table: each stage works on all its predecessor kept.

``STAGES`` may be run one by one, each stage's rows written and read again as the next one's documents; ``run`` does so
through the shared folder. The first three stages return the columns of ``documents``, the last the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagseries.llm import packing, pii, shingles, toxicity
from tagseries.llm._tables import stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no toxic category holds for."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return shingles.first_of_group(docs, words=5, num=80, den=100)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    return packing.pack(packing.cut(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard", near_duplicates),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: The first two stages have no SQL form; tests hold the whole against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
