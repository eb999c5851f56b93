"""Current state of employees out of the change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.functions.text import name_part
from stagehouse.operators.joins import unplaced
from stagehouse.operators.keys import latest_per_key
from stagehouse.schemas import EMPLOYMENT

KEY = "id_employee"


def entries_of(log: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Log entries of the given ids only, all entries without a list."""
    if ids is None:
        return log
    return log.join(unplaced(ids.select(KEY).distinct()), KEY, "left_semi")


def newest_entries(entries: DataFrame, ties: Sequence[str] = ("record_id",)) -> DataFrame:
    """Each employee's newest entry, all columns; ``ties`` settle equal dates."""
    return latest_per_key(entries, [KEY], "date_devations", ties)


def persons_of(newest: DataFrame) -> DataFrame:
    """Name parts and birth date.

    Parts are taken by position: first, last and sur name are the first three
    words of the full name in that order.
    """
    return newest.select(
        KEY,
        name_part(F.col("fio"), 1).alias("first_name"),
        name_part(F.col("fio"), 2).alias("last_name"),
        name_part(F.col("fio"), 3).alias("sur_name"),
        "birth_date",
    )


def employment_of(newest: DataFrame) -> DataFrame:
    """Region, company, factors and polling station."""
    return newest.select(*[F.col(f.name).cast(f.dataType) for f in EMPLOYMENT.fields])


def current_persons(log: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Persons as of the newest entry of the whole log."""
    rows = entries_of(log, ids).select(KEY, "date_devations", "record_id", "fio", "birth_date")
    return persons_of(newest_entries(rows))


def current_employment(log: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Employment as of the newest entry of the whole log."""
    rows = entries_of(log, ids).select("record_id", *EMPLOYMENT.fieldNames())
    return employment_of(newest_entries(rows))


def advance(
    batch: DataFrame, employment: DataFrame, ties: Sequence[str] = ("record_id",)
) -> DataFrame:
    """Newest entries of a new batch that take the place of the current ones.

    The employment table holds the date of each employee's newest entry, so
    the log itself need not be read again. As in the log, a missing date is
    the newest, and of two equal dates the later batch wins.
    """
    held = employment.select(
        KEY, F.col("date_devations").alias("_held"), F.lit(True).alias("_is_held")
    )
    is_newer = (
        F.col("_is_held").isNull()
        | F.col("date_devations").isNull()
        | (F.col("date_devations") >= F.col("_held"))
    )
    return (
        newest_entries(batch, ties).join(held, KEY, "left").where(is_newer).drop("_held", "_is_held")
    )
