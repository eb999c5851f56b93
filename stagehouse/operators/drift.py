"""Where a copy differs from its source, beyond the number of rows.

Ranges of the leading key are compared by fingerprints that do not depend on
the order of rows: over both sides together, the number of rows, the sum of
row hashes (the copy's taken off) and the xor of other row hashes are all zero
where the sides agree. That is one aggregation with partial sums, so neither
side is sorted or joined. Only ranges that differ are cut into finer ones, and
only their rows are compared key by key in the end.

Defined cases: a null key has a range of its own; rows that share a key are
compared as a bag; null and absent values differ; column order does not matter
but both sides need the same columns; two empty sides agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagehouse.session import materialize

# The first look cuts the keys into at most this many ranges.
RANGES = 4096


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash that tells a null from the columns beside it."""
    return F.xxhash64(F.lit(seed), *[part for c in columns for part in (F.col(c), F.col(c).isNull())])


def _differ(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose sides differ, with the rows of either side."""
    sign = F.when(F.col("_new"), F.lit(1)).otherwise(F.lit(-1))
    summed = rows.groupBy(*by).agg(
        F.count_if("_new").alias("_n_new"),
        F.count_if(~F.col("_new")).alias("_n_old"),
        F.sum((sign * F.col("_sum").cast("decimal(20,0)"))).alias("_balance"),
        F.bit_xor("_xor").alias("_odd"),
    )
    return summed.where("_n_new <> _n_old or _balance <> 0 or _odd <> 0").drop("_balance", "_odd")


def _range(key: str, width: int) -> Column:
    return F.col(key) - F.pmod(F.col(key), F.lit(width))


def _hashed(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    columns = sorted(source.columns)
    if columns != sorted(target.columns):
        raise ValueError("source and target need the same columns")
    both = source.select(*columns, F.lit(True).alias("_new")).unionAll(
        target.select(*columns, F.lit(False).alias("_new"))
    )
    return both.select(*keys, "_new", _row_hash(columns, 1).alias("_sum"), _row_hash(columns, 2).alias("_xor"))


def row_drift(
    source: DataFrame, target: DataFrame, keys: Sequence[str], leaf: int = 1024, fan: int = 64
) -> DataFrame:
    """Keys that differ: ``range_low`` of their range, the keys, and ``change``.

    ``change`` is ``new`` (only in the source), ``gone`` (only in the target) or
    ``changed``. The leading key is a whole number. What reaches the driver is
    the least and the greatest key, and the least and the greatest range that differs.
    """
    lead = keys[0]
    rows = _hashed(source, target, keys)
    low, high = rows.agg(F.min(lead), F.max(lead)).first()
    width = leaf
    while low is not None and (high - low) // width > RANGES:
        width *= fan
    while width > leaf:
        found = _differ(rows.withColumn("range_low", _range(lead, width)), ["range_low"])
        found = materialize(found.select(F.col("range_low").alias("_low")), "ranges")
        first, last, nulls = found.agg(F.min("_low"), F.max("_low"), F.count_if(F.col("_low").isNull())).first()
        # Plain bounds reach the scans of both sides; the join leaves the ranges between out.
        inside = F.lit(False) if first is None else F.col(lead).between(first, last + width - 1)
        rows = rows.where(inside | F.col(lead).isNull() if nulls else inside)
        rows = rows.join(found, _range(lead, width).eqNullSafe(F.col("_low")), "left_semi")
        width //= fan
    changed = _differ(rows.withColumn("range_low", _range(lead, leaf)), ["range_low", *keys])
    change = F.when(F.col("_n_old") == 0, "new").when(F.col("_n_new") == 0, "gone").otherwise("changed")
    return changed.select("range_low", *keys, change.alias("change"))


def range_drift(
    source: DataFrame, target: DataFrame, keys: Sequence[str], leaf: int = 1024, fan: int = 64
) -> DataFrame:
    """One row per differing range: how many keys are new, gone or changed."""
    found = row_drift(source, target, keys, leaf, fan)
    kinds = [F.count_if(F.col("change") == k).alias(f"n_{k}") for k in ("new", "gone", "changed")]
    return found.groupBy("range_low").agg(*kinds)
