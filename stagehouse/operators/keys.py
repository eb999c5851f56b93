"""Unique keys, newest rows and surrogate keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagehouse.operators.joins import join_null_safe, unplaced
from stagehouse.session import materialize


def _fails(condition: Column, message: Column) -> Column:
    """A filter that passes where ``condition`` holds and raises elsewhere."""
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` itself, raising when two rows share a key. Null keys are never equal.

    The check is an aggregate with map-side combine, so a key that fills a
    third of the rows still sends one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    first = [F.first(F.struct(*rest)).alias("_row")] if rest else []
    seen = df.where(_all_set(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *first)
    message = F.concat(
        F.lit(f"duplicate key in {what}: "), F.concat_ws(", ", *[F.col(k) for k in keys])
    )
    unique = seen.where(_fails(F.col("_n") == 1, message))
    rows = unique.select(*keys, *(["_row.*"] if rest else [])).select(*df.columns)
    return rows.unionByName(df.where(~_all_set(keys)))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest ``newest`` per key; a null counts as the greatest.

    ``max_by`` keeps one row per key and map task, where a window would bring
    every row of a hot key into one task. ``ties`` (greatest wins) settle equal
    dates, the remaining columns settle what is left.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(
        F.col(newest).isNull().alias("_open"),
        F.col(newest),
        *ties,
        *[c for c in rest if c != newest and c not in ties],
    )
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the least one; rows with a null key are all kept."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.where(_all_set(keys)).distinct().unionByName(df.where(~_all_set(keys)))
    least = df.where(_all_set(keys)).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    rows = least.select(*keys, "_row.*").select(*df.columns)
    return rows.unionByName(df.where(~_all_set(keys)))


def task_position() -> Column:
    """How many rows the task has emitted before this one."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    id_column: str = "id",
    start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """``df`` with dense numbers in the order of ``order``, whose tuples are unique.

    No global window: the rows are range-partitioned and sorted, numbered
    inside their partition, and each partition is shifted by the size of those
    before it. The numbered rows are written once, so both uses see the same
    partitions even when an executor is lost. Unique tuples leave no value
    that could fill a range. Without ``partitions`` AQE brings small ranges
    together; the numbers do not depend on it.
    """
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    numbered = materialize(
        ranged.sortWithinPartitions(*order)
        .select(*df.columns, F.spark_partition_id().alias("_part"), task_position().alias("_pos")),
        "surrogate-keys",
    )
    # One row per range partition: as many as there are shuffle partitions at most.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        numbered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    return numbered.join(F.broadcast(shift), "_part").select(
        *df.columns, (F.col("_pos") + F.col("_shift") + F.lit(start)).alias(id_column)
    )


def surrogate_keys(
    df: DataFrame,
    columns: Sequence[str],
    id_column: str = "id",
    start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Distinct tuples of ``columns`` with dense ids in sorted order, nulls first.

    Tuples are distinct before they move (see :func:`number_rows`).
    """
    return number_rows(df.select(*columns).distinct(), columns, id_column, start, partitions)


@dataclass(frozen=True)
class Keyed:
    """``every`` tuple of a run with its id, and the rows that are ``fresh``."""

    every: DataFrame
    fresh: DataFrame


def reused_keys(
    df: DataFrame,
    columns: Sequence[str],
    stored: DataFrame,
    id_column: str = "id",
    start: int = 1,
    same: Callable[[Column], Column] = lambda value: value,
) -> Keyed:
    """Ids of the distinct tuples of ``columns``: the stored one, else the next from ``start``.

    Nulls are equal, and so are values that ``same`` maps to one. A tuple that is
    stored twice keeps its least id. Only the run's tuples are numbered, so an
    increment costs the join with the stored keys, whichever side Spark moves.
    """
    alike = [f"_same_{c}" for c in columns]

    def mapped(rows: DataFrame) -> list[Column]:
        return [same(F.col(c)).alias(a) for c, a in zip(columns, alike, strict=True)]

    held = stored.select(id_column, *mapped(stored)).groupBy(*alike).agg(F.min(id_column).alias(id_column))
    tuples = df.select(*columns).distinct()
    found = materialize(
        join_null_safe(tuples.select(*columns, *mapped(tuples)), unplaced(held), alike), "known-keys"
    )
    new = found.where(F.col(id_column).isNull()).drop(id_column)
    numbered = number_rows(new.select(*alike).distinct(), alike, id_column, start)
    every = found.where(F.col(id_column).isNotNull()).unionByName(join_null_safe(new, numbered, alike))
    return Keyed(
        every.select(id_column, *columns),
        numbered.select(id_column, *[F.col(a).alias(c) for c, a in zip(columns, alike, strict=True)]),
    )
