"""Documents to training data: quality rules, near duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. Every stage but the last
returns the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe_tree, budgets, count_vectors, feistel, repetition
from tidemark.llm.stage import ready, staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rule keeps."""
    ready(spark)
    return repetition.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ready(spark)
    return count_vectors.one_of_each(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced."""
    ready(spark)
    return feistel.pseudonymise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix; one that is in two epochs comes twice."""
    ready(spark)
    return budgets.mix(docs).select("doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    ready(spark)
    return bpe_tree.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("near duplicates", near_duplicates), ("personal data", pseudonyms), ("mixing", mixture), ("tokens", tokens),
]

#: Token ids are not SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(spark, docs, name.replace(" ", "-"))
    return docs
