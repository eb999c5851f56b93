"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unplaced(df: DataFrame) -> DataFrame:
    """``df`` without the hash partitioning an aggregate left it in.

    AQE splits a hot key of a join only where both inputs arrive by a shuffle
    made for that join. A distinct or grouped side is already placed by its
    key and gets none, so the hot key of the other side would stay in one
    task. After this the side is shuffled (or broadcast, if it is small).
    """
    return df.coalesce(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def join_null_safe(
    df: DataFrame, other: DataFrame, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join on equal tuples, null being equal to null; ``columns`` come once."""
    renamed = other.select(
        *[F.col(c).alias(f"_k_{c}") for c in columns],
        *[c for c in other.columns if c not in columns],
    )
    match = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in columns]
    )
    return df.join(renamed, match, how).drop(*[f"_k_{c}" for c in columns])
