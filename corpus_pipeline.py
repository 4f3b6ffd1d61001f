"""A corpus pipeline of five stages, each on all rows that the stage before kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns the columns of documents, the last one the encoded texts. ``run``
writes every stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import byte_bpe, exact_dedup, hyperminhash, mixing, quality
from tallymark.llm.common import table, written

TOKENIZER = "byte_bpe_50k.tiktoken"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.judged(docs).where("kept").select("row.*")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return exact_dedup.without_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: five words, similarity 0.8."""
    return hyperminhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until the sources have their target weights."""
    return mixing.mixed_rows(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text, one row per document of the mix."""
    return byte_bpe.digests(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs


#: A trained classifier, a random mix and a tokenizer are not SQL; the stages are tested against brute force.
ORACLE_SQL = None
