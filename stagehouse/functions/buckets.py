"""Age buckets of the customer mart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AgeBuckets:
    """Inclusive bounds per label; a null bound is open. ``keep`` limits the rows."""

    bounds: tuple[tuple[str, int | None, int | None], ...]
    keep: tuple[int, int] | None = None


UNKNOWN_AGE = "Unknown"

# Labels and bounds of the two variants of the age mart.
HISTORY = AgeBuckets(
    (
        ("18-29", 18, 29),
        ("30-39", 30, 39),
        ("40-49", 40, 49),
        ("50-59", 50, 59),
        ("60-80", 60, 80),
    ),
    keep=(18, 80),
)
REPEATED = AgeBuckets(
    (
        ("Under 10", None, 9),
        ("10-19", 10, 19),
        ("20-29", 20, 29),
        ("30-39", 30, 39),
        ("40-49", 40, 49),
        ("50-59", 50, 59),
        ("60-69", 60, 69),
        ("70-79", 70, 79),
        ("80 and Over", 80, None),
    ),
)


def _inside(column: Column, low: int | None, high: int | None) -> Column:
    if low is None:
        return column <= high
    if high is None:
        return column >= low
    return column.between(low, high)


def age_bucket(column: Column, buckets: AgeBuckets = HISTORY) -> Column:
    label = F.lit(UNKNOWN_AGE)
    for name, low, high in reversed(buckets.bounds):
        label = F.when(_inside(column, low, high), name).otherwise(label)
    return label
