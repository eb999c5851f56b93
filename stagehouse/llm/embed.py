"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products within cells.

Equal vectors of a label are first collapsed to one. Centres are fitted on a
bounded sample (``SAMPLE`` vectors, drawn by a hash of the id); every vector is
assigned to its nearest centre and visits, as a guest, those cells of higher number
whose centre is nearly as near (``MARGIN`` in cosine), so two near vectors on either
side of a border still meet, and each pair meets once. A cell of any size is cut
into blocks, and pairs of blocks are compared as products of bounded size; a
block pair returns one row per vector (its links and the smallest vector it hangs
together with), never the pairs.

Defined cases: a null label, or a vector that is null, empty, zero or holds null or
non-finite components links with nothing; vectors of different length never link;
repeated rows of one id count as vectors of their own in ``n_links``; a null id
is a node of its own and links with nothing; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.llm.common import read_table, uniform
from stagehouse.llm.graph import components, local_roots
from stagehouse.session import materialize

LEAST = 0.98
SAMPLE = 20_000
CELL = 1000
MOST_CELLS = 4096
MARGIN = 0.12
BLOCK = 1024
ROUNDS = 8


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_centres(sample: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """Spherical k-means: unit centres, cosine assignment; an empty cell takes a random vector."""
    rng = np.random.default_rng(seed)
    vectors = unit(sample.astype(np.float64))
    centres = vectors[rng.choice(len(vectors), size=min(cells, len(vectors)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate(
            [(vectors[i : i + 4096] @ centres.T).argmax(1) for i in range(0, len(vectors), 4096)]
        )
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        empty = np.linalg.norm(sums, axis=1) < 1e-9
        sums[empty] = vectors[rng.choice(len(vectors), size=int(empty.sum()))]
        centres = unit(sums)
    return centres


def _usable(rows: DataFrame) -> DataFrame:
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    power = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    some = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
    return rows.where(some).where(~odd).where(power > 0)


def _compare(frame: pd.DataFrame) -> pd.DataFrame:
    """One block pair: links of each vector to those of the other side, and its local root."""
    ids, counts = frame["rep"].to_numpy(), frame["n"].to_numpy()
    side = frame["side"].to_numpy()
    order = np.lexsort((ids, side))
    ids, counts, side = ids[order], counts[order], side[order]
    raw = frame["embedding"].to_numpy()[order]
    vectors = unit(np.stack([np.asarray(v, dtype=np.float64) for v in raw]))
    cut = int(np.searchsorted(side, 1))
    left, right = (np.arange(cut), np.arange(cut, len(ids))) if cut < len(ids) else (np.arange(cut),) * 2
    links = np.zeros(len(ids), dtype=np.int64)
    found_a, found_b = [], []
    if len(left) and len(right):
        close = vectors[left] @ vectors[right].T >= LEAST
        if cut == len(ids):
            np.fill_diagonal(close, False)
            links += close @ counts
        else:
            links[left] += close @ counts[right]
            links[right] += counts[left] @ close
        a, b = np.nonzero(close)
        found_a.append(left[a])
        found_b.append(right[b])
    by_id = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), dtype=np.int64)
    rank[by_id] = np.arange(len(ids))
    none = np.zeros(0, dtype=np.int64)
    root = local_roots(len(ids), rank[np.concatenate([none, *found_a])], rank[np.concatenate([none, *found_b])])
    met = links > 0
    return pd.DataFrame({"rep": ids[met], "links": links[met], "root": ids[by_id][root[rank[met]]]})


def _visitor(held):
    def visited(vectors: pd.Series) -> pd.Series:
        """Home cell first, then the cells visited as a guest."""
        out = []
        for i in range(0, len(vectors), 1024):
            part = unit(np.stack([np.asarray(v, dtype=np.float64) for v in vectors.iloc[i : i + 1024]]))
            cosine = part @ held.value.T
            home = cosine.argmax(1)
            near = cosine >= cosine[np.arange(len(part)), home][:, None] - MARGIN
            for own, row in zip(home, near, strict=True):
                out.append([int(own), *(int(c) for c in np.flatnonzero(row) if c > own)])
        return pd.Series(out)

    return visited


def near_duplicates(rows: DataFrame) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    spark = rows.sparkSession
    rows = rows.select("vec_id", "label", "embedding")
    classes = (
        _usable(rows)
        .withColumn("dim", F.size("embedding"))
        .groupBy("label", "dim", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    )
    classes = materialize(classes, "vectors")
    total = classes.groupBy("dim").count().collect()
    assigned = None
    for dim, count in ((r["dim"], r["count"]) for r in total):
        own = classes.where(F.col("dim") == dim)
        drawn = own.where(uniform("cells", F.col("rep")) < SAMPLE / count).select("rep", "embedding").collect()
        drawn.sort(key=lambda r: r["rep"])
        cells = min(MOST_CELLS, max(1, math.ceil(count / CELL)))
        if cells > 1 and len(drawn) > cells:
            centres = fit_centres(np.array([r["embedding"] for r in drawn]), cells)
        else:
            centres = np.ones((1, dim))
        part = own.withColumn("cells", F.pandas_udf(_visitor(spark.sparkContext.broadcast(centres)), "array<int>")("embedding"))
        assigned = part if assigned is None else assigned.unionByName(part)
    if assigned is None:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    placed = assigned.select("label", "dim", "rep", "n", "embedding", F.posexplode("cells").alias("side", "cell"))
    placed = materialize(placed.withColumn("side", F.least("side", F.lit(1))), "cells")
    sizes = placed.groupBy("label", "dim", "cell").agg(
        F.ceil(F.sum(F.when(F.col("side") == 0, 1).otherwise(0)) / BLOCK).cast("int").alias("homes"),
        F.ceil(F.sum("side") / BLOCK).cast("int").alias("guests"),
    )
    sizes = materialize(sizes, "cell-sizes")
    mine = F.when(F.col("side") == 0, F.col("homes")).otherwise(F.col("guests"))
    in_block = placed.join(sizes, ["label", "dim", "cell"]).where("homes > 0").withColumn(
        "block", F.pmod(F.xxhash64("rep"), mine).cast("int")
    )
    home = F.col("side") == 0
    # A home block meets every home block (itself included) and every guest block of its cell.
    of_home = F.concat(
        F.transform(
            F.sequence(F.lit(0), F.col("homes") - 1),
            lambda j: F.struct(
                F.least("block", j).alias("i"), F.greatest("block", j).alias("j"), F.lit(False).alias("visit"),
                F.when(F.col("block") > j, 1).otherwise(0).alias("side"),
            ),
        ),
        F.when(F.col("guests") > 0, F.transform(
            F.sequence(F.lit(0), F.greatest(F.col("guests"), F.lit(1)) - 1),
            lambda g: F.struct(F.col("block").alias("i"), g.alias("j"), F.lit(True).alias("visit"), F.lit(0).alias("side")),
        )).otherwise(F.array().cast("array<struct<i:int,j:int,visit:boolean,side:int>>")),
    )
    of_guest = F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1),
        lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit(True).alias("visit"), F.lit(1).alias("side")),
    )
    meets = F.explode(F.when(home, of_home).otherwise(of_guest)).alias("meet")
    pairs = in_block.select("label", "dim", "cell", "rep", "n", "embedding", meets).select(
        "label", "dim", "cell", "rep", "n", "embedding", "meet.*"
    )
    key = ["label", "dim", "cell", "i", "j", "visit"]
    found = pairs.groupBy(*key).applyInPandas(_compare, "rep long, links long, root long")
    found = materialize(found, "met")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    summed = classes.join(linked, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    by_class = summed.select(
        "label", "embedding", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    usable = _usable(rows).join(by_class, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    power = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & ~odd & (power > 0)
    rest = rows.where(~F.coalesce(fine, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return usable.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
