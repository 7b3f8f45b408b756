"""A corpus pipeline of the llm operators: five stages, each reading what its predecessor wrote.

Every stage takes (spark, docs, sf_dir), where docs has the columns of ``documents``, and returns a DataFrame. All but
the last return those columns again. Nulls in any column, empty texts, repeated rows and empty tables are handled as
the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinloom.llm import decontaminate, language_id, mixing, near_dedup, suffix_dedup
from kinloom.llm.common import materialize, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, and those that the uniform distribution explains better than any language.
    The model learns from the labelled rows of ``docs``; ``lang`` stays as it was."""
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    return language_id.known(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.near_dedup(docs, words=5, per_cent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every 100-byte string that also starts earlier out of the texts, whole characters only."""
    return suffix_dedup.dedup(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of ten words of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, and taken: how many of its words the mix takes, repeats counted."""
    return mixing.mix(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mix", source_mix),
]

#: The mixture inference of the first stage has no SQL form; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
