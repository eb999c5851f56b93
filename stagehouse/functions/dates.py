"""Date parts and weekday labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names as the marts show them.
SUNDAY_FIRST = (
    "Воскресенье",
    "Понедельник",
    "Вторник",
    "Среда",
    "Четверг",
    "Пятница",
    "Суббота",
)
# The repeated load takes day 0 for Monday, so its labels are one day off.
SHIFTED = SUNDAY_FIRST[1:] + SUNDAY_FIRST[:1]
UNKNOWN_DAY = "Неизвестный день"


def sale_year(column: Column) -> Column:
    return F.year(column).cast("long")


def sale_month(column: Column) -> Column:
    return F.month(column).cast("long")


def day_of_week(column: Column) -> Column:
    """0 = Sunday … 6 = Saturday; Spark counts from 1."""
    return (F.dayofweek(column) - 1).cast("long")


def weekday_label(column: Column, labels: tuple[str, ...] = SUNDAY_FIRST) -> Column:
    names = F.array(*[F.lit(name) for name in labels])
    # get, not element_at: the latter reads a null index as some element.
    return F.coalesce(F.get(names, F.dayofweek(column) - 1), F.lit(UNKNOWN_DAY))
