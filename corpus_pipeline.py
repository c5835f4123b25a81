"""The corpus pipeline: language, near duplicates, benchmark passages, personal data, mixing.

Each stage takes (spark, docs, sf_dir), with docs the rows of ``documents`` that its
predecessor kept, and returns a DataFrame; all but the last return the columns
of ``documents``.  The last returns the blocks of the mix with the ids of their documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphloom.llm import decontaminate, langid, minhash, mixing, pii
from graphloom.llm.common import cut, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; ``und`` and doubtful ones go."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return minhash.deduplicate(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of words, drawn from the sources by weight."""
    return mixing.Mix(docs).blocks()


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mix", mix),
]

#: SQL expresses neither the network of the first stage nor the closure of the second.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
