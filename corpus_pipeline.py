"""The corpus pipeline: raw documents in, sharded training documents out.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; its
result is written as Parquet to the shared folder and read again as the
next stage's input.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardwatch.llm import decontaminate, language_id, mixing, ngram_join, sharding
from cardwatch.llm.common import read, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# Least mean posterior of a text's language; below it the text is rejected.
# Clean texts that mix two or three languages stay above it.
LEAST_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return language_id.keep_identified(docs, LEAST_LANGUAGE_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return ngram_join.drop_near_duplicates(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per copy taken of a document."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in shards of bounded bytes, with the shard's name."""
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

# Stages train models and draw by hash, which SQL cannot express; the tests
# compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-').lower()}")
    return docs
