"""What a source holds that its copy does not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagehouse.operators.joins import unplaced


def count_drift(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both row counts and whether they differ."""
    def side(df: DataFrame, is_source: bool) -> DataFrame:
        return df.select(F.lit(is_source).alias("_source"))

    both = side(source, True).unionAll(side(target, False))
    return both.agg(
        F.count_if(F.col("_source")).alias("source_count"),
        F.count_if(~F.col("_source")).alias("target_count"),
    ).withColumn("changed", F.col("source_count") != F.col("target_count"))


def drift_from(source_count: int, target: DataFrame) -> DataFrame:
    """:func:`count_drift` for a source that has counted its own rows."""
    return target.agg(
        F.lit(source_count).cast("long").alias("source_count"),
        F.count(F.lit(1)).alias("target_count"),
    ).withColumn("changed", F.col("source_count") != F.col("target_count"))


def high_watermark(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The greatest key, part by part; one row."""
    return df.agg(F.max(F.struct(*keys)).alias("k")).select("k.*")


def past_mark(keys: Sequence[str], mark: Sequence[object]) -> Column:
    """Whether the key lies past ``mark``, part by part, a null before everything else.

    Spelled out in plain comparisons, which parquet and JDBC scans evaluate
    themselves; the leading one alone also prunes row groups and slices.
    """
    beyond: Column | None = None
    for key, value in reversed(list(zip(keys, mark, strict=True))):
        greater = F.col(key).isNotNull() if value is None else F.col(key) > F.lit(value)
        equal = F.col(key).isNull() if value is None else F.col(key) == F.lit(value)
        beyond = greater if beyond is None else greater | (equal & beyond)
    lead = mark[0]
    return beyond if lead is None else (F.col(keys[0]) >= F.lit(lead)) & beyond


def rows_after(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key lies past the greatest key of ``target``.

    The mark is a single row, so it is read first and compared as literals
    that the scan can use. An empty target gives all rows. Rows that arrive
    later with a smaller key are missed; :func:`rows_not_loaded` finds those.
    """
    mark = target.agg(F.max(F.struct(*keys)).alias("k")).first()["k"]
    return source if mark is None else source.where(past_mark(keys, mark))


def rows_not_loaded(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key ``target`` lacks.

    The target's keys are made distinct first, so a key that fills much of it
    costs one row per map task.
    """
    return source.join(unplaced(target.select(*keys).distinct()), list(keys), "left_anti")
