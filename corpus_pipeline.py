"""From raw documents to packed training sequences, in five stages.

Each stage takes all that its predecessor kept and is written before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import jaccard, langid, mixing, packing, toxicity
from tabwright.llm import queries as llm
from tabwright.llm.common import stage


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified with a probability of at least one half."""
    return langid.keep_identified(docs, llm.language_model(spark, sf_dir))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return toxicity.keep_clean(docs, llm.toxicity_model(spark, sf_dir))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return jaccard.keep_one(docs, words=5, threshold=(8, 10))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, each with its token ids and its place in a sequence."""
    return packing.pack(docs, added=packing.ADDED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identified),
    ("toxicity", clean),
    ("ngram_jaccard_join", distinct),
    ("mixing", mixed),
    ("best_fit_packing", packed),
]

# No stage is SQL: tests compare the stages with plain versions of them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = llm.table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
