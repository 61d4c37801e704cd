"""A corpus pipeline over ``documents``: each stage is one operator of
``growlytics.llm`` and reads what its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of documents; the last stage returns the mixed corpus, with four
more columns (shard, place in it, copy, words).  Nulls, blank texts, repeated
rows, empty tables and extra columns are treated as the operators say: a null
or blank text has no language and goes in the first stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from growlytics.llm import op2_language, op3_lines, op5_mixing, op6_ngram_join, op10_decontaminate
from growlytics.llm.common import staged, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letter, or no dominant one) go."""
    return op2_language.keep_identified(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to earlier ones go; so do documents without any other."""
    return op3_lines.without_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return op6_ngram_join.representatives(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers or names, go."""
    return op10_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus, in shards."""
    return op5_mixing.mix(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources to target weights", mix_sources),
]

#: Learned models and seeded draws are not expressible in SQL; the tests hold
#: the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
