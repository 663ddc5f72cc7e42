"""The corpus pipeline: documents in, a training mix out.

Each stage works on all that the one before kept. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.llm.common import read_table, stored
from tripflow.llm.decontaminate import without_leaks
from tripflow.llm.mix_sources import mix_sources
from tripflow.llm.near_copies import one_of_each
from tripflow.llm.quality_rules import keep_good
from tripflow.llm.secret_scan import redacted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest id, of each group of near copies: five words, 0.8."""
    return one_of_each(docs, n=5, least=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain an item of the benchmark."""
    return without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With a mark in the place of every secret."""
    return redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mix_sources(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontaminate),
    ("secret scans", secrets),
    ("mixing sources to target weights", mix),
]

#: Several stages go beyond SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
