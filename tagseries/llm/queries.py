"""Registered queries: one per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir
from . import (
    alignment,
    bin_completion,
    bpe,
    chat,
    filter_audit,
    hashing_search,
    licenses,
    packing,
    pii,
    pivot_search,
    shingles,
    token_files,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@register("op3_bpe_two_tier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of the bytes decoded from them."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@register("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids, read back from the files written."""
    path = shared_dir(spark)
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.digests(token_files.read_tokens(spark, path))


@register("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.cut(docs, public_tokenizers.path("byte_bpe_50k.json")))


@register("op8_ngram_jaccard", shingles.GROUPS_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate group of each document."""
    return shingles.near_groups(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


@register("op1_toxicity_chain")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities of each document, and whether to reject it."""
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_multi_index_hashing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return hashing_search.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


@register("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in each document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@register("op6_pivot_top_k", pivot_search.TOP_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every vector whose id is divisible by 50."""
    return pivot_search.search(table(spark, sf_dir, "embeddings"), every=50, k=5)


@register("op7_chat_format")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of every conversation under the role recovered, as canonical turns."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@register("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document."""
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


@register("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers in each document, and how usual the links are."""
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


@register("op12_filter_audit", filter_audit.AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at every step of every order, per source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op13_bin_completion")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset, in few sequences."""
    docs = table(spark, sf_dir, "documents")
    return bin_completion.pack(bin_completion.cut(docs, public_tokenizers.path("word_bpe_49k.json")))
