"""From all-text staging to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.functions.text import blank_to_null
from stagehouse.session import materialize


def _timestamp(column: Column, fmt: str | None, strict: bool) -> Column:
    if fmt is None:
        kind = T.TimestampNTZType()
        return column.cast(kind) if strict else column.try_cast(kind)
    parsed = F.to_timestamp_ntz(column, F.lit(fmt))
    if strict:
        return parsed
    return F.when(F.try_to_timestamp(column, F.lit(fmt)).isNotNull(), parsed)


def typed(
    column: Column, kind: T.DataType, timestamp_format: str | None = None, strict: bool = True
) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return _timestamp(column, timestamp_format, strict)
    return column.cast(kind) if strict else column.try_cast(kind)


def to_typed(
    df: DataFrame,
    target: T.StructType,
    blank_null: tuple[str, ...] = (),
    timestamp_format: str | None = None,
    on_error: str = "fail",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Cast the columns of ``target`` out of text.

    A value that does not parse fails the load (an empty string too, unless its
    column is listed in ``blank_null``). ``on_error="quarantine"`` keeps such
    rows instead, with null in place of the value and the names of the columns
    at fault in ``_rejected``. ``keep`` columns pass through in front.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be fail or quarantine, not {on_error}")
    strict = on_error == "fail"
    if strict and df.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("strict casts need spark.sql.ansi.enabled=true")

    def source(name: str) -> Column:
        return blank_to_null(F.col(name)) if name in blank_null else F.col(name)

    def value(field: T.StructField) -> Column:
        return typed(source(field.name), field.dataType, timestamp_format, strict)

    columns = [value(f).alias(f.name) for f in target.fields]
    if strict:
        return df.select(*keep, *columns)
    failed = [
        F.when(source(f.name).isNotNull() & value(f).isNull(), F.lit(f.name))
        for f in target.fields
    ]
    return df.select(*keep, *columns, F.array_compact(F.array(*failed)).alias("_rejected"))


class TooManyRejected(ValueError):
    """More rows failed their casts than the load may leave out."""


def split_rejects(
    df: DataFrame,
    target: T.StructType,
    blank_null: tuple[str, ...] = (),
    timestamp_format: str | None = None,
    keep: tuple[str, ...] = (),
    most: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the rows that do not parse, in one pass over ``df``.

    Rejects carry the ``keep`` columns, the names of the columns at fault in
    ``rejected`` and all values as they came in ``raw`` (JSON). A share of
    rejects above ``most`` raises :class:`TooManyRejected` before either is
    handed out; the rows are counted while they are written.
    """
    raw = F.struct(*df.columns)
    rows = to_typed(
        df.withColumn("_raw", raw), target, blank_null, timestamp_format, "quarantine", (*keep, "_raw")
    )
    faulty = F.size("_rejected") > 0
    seen = Observation()
    rows = rows.withColumn("_raw", F.when(faulty, F.to_json("_raw"))).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(faulty).alias("rejected")
    )
    rows = materialize(rows, "typed")
    count, rejected = seen.get["rows"], seen.get["rejected"]
    if rejected > most * count:
        raise TooManyRejected(f"{rejected} of {count} rows do not parse")
    good = rows.where(~faulty).drop("_raw", "_rejected")
    return good, rows.where(faulty).select(*keep, F.col("_rejected").alias("rejected"), F.col("_raw").alias("raw"))


def tag_batch(df: DataFrame, request_id: str) -> DataFrame:
    """Put the batch id in front of every row."""
    return df.select(F.lit(request_id).alias("request_id"), "*")


# Measures whose absence counts as zero.
MEASURES = ("emission_total", "discharge_total", "waste_total", "co2_total")


def fill_measures(df: DataFrame) -> DataFrame:
    """Null and NaN measures become 0; other columns keep their nulls."""
    return df.fillna(0.0, subset=list(MEASURES))
