"""Filters by value list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A longer list would bloat the plan; it becomes a table and a semi join.
MAX_LITERALS = 1000


def filter_in(
    df: DataFrame, column: str, values: Sequence | None, max_literals: int = MAX_LITERALS
) -> DataFrame:
    """Rows whose ``column`` is in ``values``; nothing given keeps all rows.

    Values are cast to the column's type in lists of any length; null matches nothing.
    """
    if not values:
        return df
    kind = df.schema[column].dataType
    given = [v for v in values if v is not None]
    if len(given) <= max_literals:
        return df.where(F.col(column).isin([F.lit(v).cast(kind) for v in given]))
    wanted = df.sparkSession.createDataFrame([(v,) for v in given], [column])
    wanted = wanted.select(F.col(column).cast(kind).alias(column))
    return df.join(wanted, column, "left_semi")


def filter_not_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose ``column`` is none of ``values``; a null is dropped, as in SQL."""
    return df.where(~F.col(column).isin(list(values)))
