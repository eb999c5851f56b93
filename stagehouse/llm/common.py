"""What several corpus operators share: tokens, table readers, block sizes."""

from __future__ import annotations

import ctypes
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.session import materialize

# A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# Bytes of rows that go to a Python worker at a time (a longer row goes alone).
BATCH = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: 10,000 rows, Spark's own bound, are gigabytes where texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), 1)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Total bytes of a text column: what numbers of batches and buckets are derived from."""
    total = docs.agg(F.sum(F.octet_length(column).cast("long")).alias("n")).first()["n"]
    return int(total or 0)


# Bits of a map of ids for each of them, and of all maps at most (8 MB).
BITS_EACH, BITS_MOST = 16, 1 << 26
BITS_MAP = 1 << 15


def split_by_ids(rows: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose id may be among ``ids`` (one long column, null an id like others), and those whose id is not.

    What decides is a bit by a hash of the id, in maps of bounded size that are broadcast. An exact join then has to move
    few rows with their texts besides those it is about, where it would move all.
    """
    ids = ids.toDF("_id")
    bits = min(BITS_MOST, max(BITS_MAP, 1 << (BITS_EACH * ids.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(bits))
    map_of = lambda c: F.floor(F.col(c) / BITS_MAP).cast("long")
    places = ids.select(place("_id").alias("_place")).distinct().withColumn("_map", map_of("_place"))
    maps = places.repartition("_map").groupBy("_map").agg(F.bitmap_construct_agg(F.col("_place") % BITS_MAP).alias("_bits"))
    maps = materialize(maps, "id-maps")
    placed = rows.withColumn("_place", place(column)).withColumn("_map", map_of("_place"))
    placed = placed.join(F.broadcast(maps), "_map", "left")
    byte = F.expr(f"conv(hex(substring(_bits, int(_place % {BITS_MAP} div 8) + 1, 1)), 16, 10)").cast("int")
    there = F.coalesce(F.expr("int(_place % 8)"), F.lit(0))
    bit = F.coalesce(F.call_function("shiftright", byte, there).bitwiseAND(1), F.lit(0))
    return placed.where(bit == 1).select(*rows.columns), placed.where(bit == 0).select(*rows.columns)


def parts_for(total: int, each: int, least: int = 1) -> int:
    """How many parts of about ``each`` bytes hold ``total`` bytes."""
    return max(least, math.ceil(total / each))


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker outlives its tasks and would keep it for idle."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def uniform(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the keys only (52 bits of MD5)."""
    parts = [F.coalesce(k.cast("string"), F.lit("null")) for k in keys]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
