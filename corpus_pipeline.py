"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept.
Stages return the columns of ``documents``; the last adds ``copy``, the number of
a repeated document. Tables other than ``documents`` come from ``sf_dir``. Cases
such as nulls, empty tables and repeated rows are those of the operators called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stagehouse.llm import decontam, jaccard, mixing, quality, suffix
from stagehouse.llm.common import read_table
from stagehouse.session import materialize


def reject_faulty(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that word shingles link."""
    return jaccard.without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document, or the text itself, already has."""
    return suffix.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontam.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    return mixing.mix(docs)


STAGES = [
    ("quality", reject_faulty),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mix", mix_sources),
]

# Classifier and suffix arrays are beyond SQL. Tests hold the stages against brute force one by one (the classifier
# against labels); of the whole chain they check columns and the number of rows only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
