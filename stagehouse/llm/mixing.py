"""Mixing sources to target weights, with built-in functions only.

Tokens are summed per source with map-side combine, targets are derived on that
one-row-per-source table, and every document is emitted ``floor(rate)`` times
plus once more when its seeded hash falls under the fraction of the rate.

Defined cases: a null text has size 0; a null source is a source of its own,
ordered last; a source without words has target 0 and rate 0; repeated rows are
documents of their own that draw the same number; the draw goes by id and text, so rows
that share an id, or have none, draw apart where their texts differ; an empty table gives an empty
result; further columns are kept, and the columns made here replace columns of
the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stagehouse.llm.common import read_table, uniform, word_count
from stagehouse.session import materialize

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """One row per source: ``source``, ``source_size`` (words)."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(word_count(F.col(text))).alias("source_size")
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """Add ``target``: shares by weight of all sizes, none above ``most`` times its source.

    Resharing what a stopped source leaves over until none is above its limit
    ends where every open source has ``weight x level`` for one common level.
    Sources are stopped in order of size per weight, so running sums over that
    order find the level. The windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long"),
    )
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("place").asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    limit = F.col("source_size") * most
    stepped = (
        listed.withColumn("limit", limit)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(onward))
        .withColumn("stopped", F.col("limit") * F.col("open_weight") <= F.col("weight") * F.col("left"))
    )
    level = stepped.withColumn(
        "rest", F.col("total") - F.sum(F.when(F.col("stopped"), F.col("limit")).otherwise(0)).over(everything)
    ).withColumn("rest_weight", F.sum(F.when(F.col("stopped"), 0).otherwise(F.col("weight"))).over(everything))
    target = F.when(F.col("stopped"), F.col("limit").cast("double")).otherwise(
        (F.col("weight") * F.col("rest")).cast("double") / F.col("rest_weight")
    )
    return level.select("source", "source_size", target.alias("target"))


def with_copies(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Every document once, with ``size``, ``source_size``, ``target`` and ``copies``.

    The targets are written first, so the join knows their true size: Catalyst
    broadcasts them when they are small and the texts are not moved at all.
    """
    targets = materialize(source_targets(source_sizes(docs, source, text), weights, most), "targets")
    targets = targets.select(F.col("source").alias("_source"), "source_size", "target")
    made = ("size", "source_size", "target", "copies", "_source")
    kept = docs.drop(*[c for c in made if c not in (doc_id, source, text)])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    draw = uniform(seed, F.col(doc_id), F.md5(F.coalesce(F.col(text), F.lit(""))))
    copies = whole + F.when(draw < rate - whole, 1).otherwise(0)
    return (
        kept.join(targets, kept[source].eqNullSafe(targets["_source"]), "left")
        .drop("_source")
        .withColumn("size", word_count(F.col(text)))
        .withColumn("copies", copies.cast("int"))
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with its ``copy`` number."""
    taken = with_copies(docs, **options)
    numbered = taken.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return numbered.drop("size", "source_size", "target", "copies")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    taken = with_copies(docs)
    return taken.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix_sql(documents: str = "documents") -> str:
    """The documents of the mix with their copies, as SQL."""
    return f"""
    sized AS (
        SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
        FROM {documents}),
    sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    placed AS (
        SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS place FROM sums),
    listed AS (
        SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM placed),
    stepped AS (
        SELECT *, 3 * source_size AS most,
            sum(source_size) OVER () AS total,
            sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
                ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
            sum(weight) OVER (
                ORDER BY source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
        FROM listed),
    marked AS (SELECT *, most * open_weight <= weight * remaining AS stopped FROM stepped),
    targets AS (
        SELECT source, source_size, CASE WHEN stopped THEN most::DOUBLE ELSE
            (weight * (total - sum(CASE WHEN stopped THEN most ELSE 0 END) OVER ()))::DOUBLE
            / (sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
        FROM marked),
    rated AS (
        SELECT d.*, t.source_size, t.target,
            CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
            ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
        FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
    copied AS (
        SELECT *, (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
        FROM rated)"""


ORACLE_SQL = f"""
WITH {mix_sql()}
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM copied
"""
