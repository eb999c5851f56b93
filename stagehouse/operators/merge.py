"""What a table holds after an insert, an upsert or new dimension values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.operators.keys import assert_unique, one_per_key, surrogate_keys


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], check_unique: bool = True
) -> DataFrame:
    """``target`` with the rows of ``updates`` in place of those with the same key.

    Rows with a null key never match, so they are added. A key twice in
    ``updates`` raises; ``check_unique=False`` saves that check where the rows
    come out of a group by the key.
    """
    rows = updates.select(*target.columns)
    kept = target.join(rows.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(assert_unique(rows, keys, "upsert") if check_unique else rows)


def insert_ignore(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` plus the ``rows`` whose key it does not hold yet."""
    fresh = one_per_key(rows.select(*target.columns), keys).join(
        target.select(*keys), list(keys), "left_anti"
    )
    return target.unionByName(fresh.select(*target.columns))


def new_dim_values(
    dim: DataFrame, values: DataFrame, name: str, code: str, dedupe: bool = True
) -> DataFrame:
    """Rows to append to ``dim``: the distinct values it lacks, with codes after its last.

    ``dedupe=False`` appends every distinct value, known or not. A null value
    counts as one more name.
    """
    fresh = values.select(F.col(values.columns[0]).alias(name)).distinct()
    if dedupe:
        known = dim.select(F.col(name).alias("_known")).distinct()
        fresh = fresh.join(known, F.col(name).eqNullSafe(F.col("_known")), "left_anti")
    last = dim.agg(F.coalesce(F.max(code), F.lit(0))).first()[0]
    return surrogate_keys(fresh, [name], code, start=int(last) + 1).select(*dim.columns)


def append_new_values(
    dim: DataFrame, values: DataFrame, name: str, code: str, dedupe: bool = True
) -> DataFrame:
    return dim.unionByName(new_dim_values(dim, values, name, code, dedupe))
