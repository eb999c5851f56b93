"""Lookups into dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.operators.joins import unplaced
from stagehouse.operators.keys import assert_unique

BROADCAST_ENTRIES = 10_000


def lookup(
    df: DataFrame,
    key: str,
    index: DataFrame,
    index_key: str,
    value: str,
    max_entries: int | None = None,
) -> DataFrame:
    """Add ``value`` found in ``index``; a miss is null, a doubled index key raises.

    ``max_entries`` states a bound the caller can prove. A small one lets the
    index be broadcast, so ``df`` stays where it is; otherwise Catalyst decides
    by size and AQE splits hot keys.
    """
    entries = index.select(F.col(index_key).alias("_key"), value)
    unique = assert_unique(entries.where(F.col("_key").isNotNull()), ["_key"], f"index {index_key}")
    if max_entries is not None and max_entries <= BROADCAST_ENTRIES:
        unique = F.broadcast(unique)
    else:
        unique = unplaced(unique)
    return df.join(unique, df[key] == unique["_key"], "left").drop("_key")


def lookup_codes_by_name(
    stage: DataFrame, type_company: DataFrame, type_industry: DataFrame
) -> DataFrame:
    """Add both codes by name; a row with an unknown or null name drops out.

    A name that a dimension holds twice doubles the row.
    """
    return stage.join(
        type_company, F.col("type_company") == F.col("type_company_name")
    ).join(type_industry, F.col("type_industry") == F.col("type_indystry_name"))
