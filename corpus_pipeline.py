"""From raw documents to token ids: quality rules, near duplicates, personal data, source mix, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from tidemark.llm import bpe, mixing, ngram_join, pii, quality
from tidemark.plans.durable import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or leave their language's perplexity band go."""
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.one_of_each(docs, width=5, percent=75)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return pii.redacted_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` (packed little-endian unsigned 32-bit), ``n_tokens`` and digests of ids and decoded bytes; all other columns go."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = bpe.decode_documents(bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN), ranks, public_tokenizers.PATTERN)
    return bpe.digests(decoded, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("byte-level BPE", token_ids),
]

# The perplexity bands, the bootstrapped patterns and the merges are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next.

    A null or empty text fails the quality rules, so it never comes further; whole texts of any length are worked on. Null doc_id, lang and source
    are values like any other. Of rows equal in doc_id and text, and of equal texts, one stays after the join, the smallest doc_id (null last). The
    mix may take a document twice, so a doc_id can have two rows at the end. An empty table gives an empty one; extra columns go along up to the last stage.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
