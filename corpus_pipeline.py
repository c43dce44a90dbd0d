"""From raw documents to token ids, in stages that are each written and read again.

Every stage works on all rows that the one before kept. All but the last return the columns
of ``documents``; the last one returns, for each row of the mix, its id, source and ids.
A text that the mix takes twice is two rows with the same id.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from drayage.llm import bpe, exact, mixing, quality, simhash
from drayage.session import workspace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest accept."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.good_documents(docs, labels).select(*COLUMNS)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.distinct_documents(docs).select(*COLUMNS)


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the one with the smallest id."""
    return simhash.distinct_documents(docs).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each pass over a document."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether decoding them gives the text back."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.with_ids(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good),
    ("exact dedup", different),
    ("simhash near-dedup", apart),
    ("mixing", mixed),
    ("byte-level bpe", encoded),
]

#: SQL has no isolation forest.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents, each result written in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = workspace(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
