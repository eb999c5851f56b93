"""Hard negatives: blocks of vectors along a Hilbert curve, with zone maps that decide what is read.

Vectors become integers, are ordered along a Hilbert curve through the ``AXES`` entries
of greatest variance, and are packed ``BLOCK`` to a row of a Parquet table, in that order.
A block carries the smallest and largest value of every entry (its zone map), its labels and its smallest id, and those of
its rows that are anchors with what the block alone says of them: a score that five
positives reach, and near negatives. The inner product of an anchor with anything in a block lies between two
sums of interval ends, so

* a block is read for an anchor's positives only if it has the anchor's label and can reach the fifth
  positive known so far (by score, then by id), and
* for a positive's window only if it has another label and its interval meets the window above
  the fifth negative known so far.

Anchors are a stated query set (ids divisible by ``EVERY``) against all rows. Anchors of neighbouring blocks form a group;
a group meets the zone maps of a slice of blocks, then the blocks chosen. Every task holds
one group and one slice; each returns at most five rows per anchor or window, and the best of
them over all slices are kept by a rank that Spark limits before it shuffles.

Defined cases: rows with a null id, a null label, a null vector, or any null or non-finite component take no part;
vectors of different length are never compared; components are held within a bound that lets five times a score fit 64 bits
(``held``); rows that share an id are rows of their own, and an anchor is compared with every row but itself; ties go to the smaller id; windows of
negative positives are empty; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stagehouse.llm.common import read_table
from stagehouse.operators.keys import number_rows
from stagehouse.session import materialize

SCALE = 256
EVERY = 100
POSITIVES = NEGATIVES = 5
# A negative's score is at least 4/5 of the positive's and at most the positive's.
LEAST, OF = 4, 5
AXES, BITS = 20, 3
BLOCK = 512
# Blocks to a slice, and blocks whose anchors form a group.
SLICE, SPAN = 16, 64
# Near negatives of its own block an anchor starts with.
NEAR = 64


def held(dim: int) -> int:
    """Bound of a component: five times an inner product of such vectors fits 62 bits."""
    return min(1 << 30, math.isqrt((1 << 59) // max(dim, 1)))


def taking_part(rows: DataFrame) -> DataFrame:
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col("label").cast("long")
    return (
        rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
        .where(~odd)
        .select(
            F.monotonically_increasing_id().alias("rid"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
            F.size("embedding").alias("dim"),
            "embedding",
        )
    )


def integers(values: np.ndarray, dim: int) -> np.ndarray:
    return np.clip(np.floor(values * SCALE), -held(dim), held(dim)).astype(np.int32)


def hilbert(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points whose coordinates have ``bits`` bits each.

    Bit by bit from the top, a set bit of an axis turns the first axis over in the
    bits below and a clear one swaps them with the first axis; the Gray code of
    what results, read across the axes, is the place.
    """
    x = coordinates.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for axis in range(axes):
            turned = (x[axis] >> level) & 1 == 1
            swapped = np.where(turned, 0, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(turned, below, swapped)
            x[axis] ^= swapped
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    flips = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flips
    place = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(axes):
            place = (place << 1) | ((x[axis] >> level) & 1)
    return place


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    for dim in pc.unique(batch.column("dim")).to_pylist():
        own = batch.filter(pc.equal(batch.column("dim"), dim))
        flat = own.column("embedding").flatten().to_numpy(zero_copy_only=False)
        yield dim, own, integers(flat.reshape(own.num_rows, dim), dim)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sums and sums of squares of each entry, by length of the vectors."""
    for batch in batches:
        for dim, _, x in _by_length(batch):
            x = x.astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
                    pa.array(np.full(dim, len(x), np.int64)), pa.array(x.sum(axis=0)), pa.array((x * x).sum(axis=0)),
                ],
                names=["dim", "i", "n", "total", "squares"],
            )


def curve(vectors: DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray] | None:
    """The commonest length, its entries of greatest variance, and where they lie; None without vectors.

    Only this many numbers reach the driver. Vectors of other lengths are ordered by id.
    """
    sums = vectors.select("dim", "embedding").mapInArrow(_spread, "dim int, i int, n long, total double, squares double")
    sums = materialize(
        sums.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares")),
        "spread",
    )
    common = sums.where("i = 0").orderBy(F.col("n").desc(), "dim").first()
    if common is None:
        return None
    mean = F.col("total") / F.col("n")
    variance = F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0))
    widest = sums.where(F.col("dim") == common["dim"]).select("i", mean.alias("mean"), variance.alias("variance"))
    picked = widest.orderBy(F.col("variance").desc(), "i").limit(AXES).collect()
    middle = np.array([r["mean"] for r in picked])
    return common["dim"], np.array([r["i"] for r in picked]), middle, np.sqrt([r["variance"] for r in picked]) + 1e-9


def _keyed(along: tuple[int, np.ndarray, np.ndarray, np.ndarray]):
    common, axes, middle, spread = along

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own, x in _by_length(batch):
                place = np.zeros(len(x), dtype=np.int64)
                if dim == common:
                    # Two deviations to either side of the mean are told apart; what lies beyond shares the outermost cells.
                    cell = np.floor(((x[:, axes] - middle) / spread / 4 + 0.5) * (1 << BITS))
                    place = hilbert(np.clip(cell, 0, (1 << BITS) - 1), BITS)
                entries = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * dim, pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [own.column("rid"), own.column("vec_id"), own.column("label"), own.column("dim"), pa.array(place), entries],
                    names=["rid", "vec_id", "label", "dim", "place", "entries"],
                )

    return run


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; in floating point where all sums fit its 53 bits."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def best(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, rids: np.ndarray, most: int) -> np.ndarray:
    """Indexes of the first ``most`` of each key, by score downwards, then id, then row."""
    order = np.lexsort((rids, ids, -scores, keys))
    ranked = keys[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(order) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < most]


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().to_numpy(zero_copy_only=False)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


# What an anchor starts with: a (score, id) that enough positives reach, and near negatives.
ANCHOR = pa.struct(
    [
        ("rid", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("entries", pa.list_(pa.int32())),
        ("reach", pa.int64()), ("reach_id", pa.int64()), ("near", pa.list_(pa.int64())), ("near_ids", pa.list_(pa.int64())),
    ]
)
ANCHOR_SQL = (
    "struct<rid: long, vec_id: long, label: long, entries: array<int>, reach: long, reach_id: long,"
    " near: array<long>, near_ids: array<long>>"
)


def _pack(table: pa.Table) -> pa.Table:
    """One block as one row: its rows, its zone map, and its anchors."""
    dim, block = table.column("dim")[0].as_py(), table.column("block")[0].as_py()
    rids, ids, labels = (_numbers(table.column(c)) for c in ("rid", "vec_id", "label"))
    x = _flat(table.column("entries")).reshape(len(rids), dim)
    anchors = []
    at = np.flatnonzero(ids % EVERY == 0)
    scores = products(x[at], x)
    for k, row in enumerate(at):
        other = np.arange(len(rids)) != row
        same = np.flatnonzero(other & (labels == labels[row]))
        differ = np.flatnonzero(labels != labels[row])
        none = np.zeros(len(rids), dtype=np.int64)
        top = same[best(none[same], scores[k, same], ids[same], rids[same], POSITIVES)]
        near = differ[best(none[differ], scores[k, differ], ids[differ], rids[differ], NEAR)]
        full = len(top) == POSITIVES
        anchors.append(
            {
                "rid": int(rids[row]), "vec_id": int(ids[row]), "label": int(labels[row]), "entries": x[row].tolist(),
                "reach": int(scores[k, top[-1]]) if full else None, "reach_id": int(ids[top[-1]]) if full else None,
                "near": scores[k, near].tolist(), "near_ids": ids[near].tolist(),
            }
        )
    row = {
        "dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int64()),
        "lo": pa.array([x.min(axis=0).tolist()], pa.list_(pa.int32())), "hi": pa.array([x.max(axis=0).tolist()], pa.list_(pa.int32())),
        "labels": pa.array([np.unique(labels).tolist()], pa.list_(pa.int64())), "least_id": pa.array([int(ids.min())], pa.int64()),
        "rids": pa.array([rids], pa.list_(pa.int64())), "ids": pa.array([ids], pa.list_(pa.int64())),
        "label_of": pa.array([labels], pa.list_(pa.int64())), "entries": pa.array([x.ravel()], pa.list_(pa.int32())),
        "anchors": pa.array([anchors], pa.list_(ANCHOR)),
    }
    return pa.table(row)


BLOCK_SQL = (
    "dim int, block long, lo array<int>, hi array<int>, labels array<long>, least_id long, rids array<long>,"
    f" ids array<long>, label_of array<long>, entries array<int>, anchors array<{ANCHOR_SQL}>"
)


def zoned_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame | None:
    """The block table; None where no row takes part."""
    vectors = materialize(taking_part(rows), "vectors")
    along = curve(vectors)
    if along is None and vectors.isEmpty():
        return None
    keyed = vectors.mapInArrow(
        _keyed(along or (-1, *[np.zeros(0)] * 3)), "rid long, vec_id long, label long, dim int, place long, entries array<int>"
    )
    ranked = number_rows(keyed, ["dim", "place", "vec_id", "rid"], "rank", 0)
    packed = ranked.withColumn("block", F.expr(f"rank div {block}")).groupBy("dim", "block").applyInArrow(_pack, BLOCK_SQL)
    return materialize(packed, "blocks")


def _box(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with anything inside each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


class Anchors:
    """A group's anchors; with positives, also their windows, each with what its own block says of it."""

    def __init__(self, table: pa.Table, dim: int) -> None:
        self.rids, self.labels = _numbers(table.column("rid")), _numbers(table.column("label"))
        self.entries = _flat(table.column("entries")).reshape(len(self.rids), dim)
        least = np.iinfo(np.int64)
        reach = [(r, i) if r is not None else (least.min, least.max) for r, i in zip(*(table.column(c).to_pylist() for c in ("reach", "reach_id")), strict=True)]
        self.reach = np.array(reach, dtype=np.int64).reshape(-1, 2)
        if "tops" not in table.column_names:
            return
        owner, places, tops, known = [], [], [], []
        columns = (table.column(c).to_pylist() for c in ("places", "tops", "near", "near_ids"))
        for k, (place, top, near, near_ids) in enumerate(zip(*columns, strict=True)):
            near, near_ids = np.array(near, dtype=np.int64), np.array(near_ids, dtype=np.int64)
            for p, score in zip(place, top, strict=True):
                if score < 0:
                    continue
                inside = np.flatnonzero((near <= score) & (OF * near >= LEAST * score))[:NEGATIVES]
                full = len(inside) == NEGATIVES
                bound = (near[inside[-1]], near_ids[inside[-1]]) if full else (-(-LEAST * score // OF), least.max)
                owner.append(k)
                places.append(p)
                tops.append(score)
                known.append(bound)
        self.owner, self.places, self.tops = (np.array(v, dtype=np.int64) for v in (owner, places, tops))
        self.known = np.array(known, dtype=np.int64).reshape(-1, 2)


def _labelled(labels: list[np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per label wanted and block: whether the block has it, and whether it has another."""
    has = np.array([np.isin(wanted, own) for own in labels]).T
    other = np.array([len(own) - np.isin(wanted, own) > 0 for own in labels]).T
    return has, other


def _chooser(windows: bool):
    """Which blocks of a slice the anchors of a group must read."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks, rids = [], []
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            group = Anchors(left, dim)
            lo, hi = (_flat(right.column(c)).reshape(right.num_rows, dim) for c in ("lo", "hi"))
            low, high = _box(group.entries, lo, hi)
            least_id = _numbers(right.column("least_id"))
            has, other = _labelled([np.array(v) for v in right.column("labels").to_pylist()], group.labels)
            if windows:
                bound, bound_id = group.known[:, :1], group.known[:, 1:]
                o = group.owner
                reaches = (high[o] > bound) | ((high[o] == bound) & (least_id <= bound_id))
                met = other[o] & reaches & (low[o] <= group.tops[:, None])
                needed = np.zeros(low.shape, dtype=bool)
                np.logical_or.at(needed, o, met)
            else:
                bound, bound_id = group.reach[:, :1], group.reach[:, 1:]
                needed = has & ((high > bound) | ((high == bound) & (least_id <= bound_id)))
            for k, block in enumerate(_numbers(right.column("block"))):
                if needed[:, k].any():
                    blocks.append(int(block))
                    rids.append(group.rids[needed[:, k]])
        return pa.table({"block": pa.array(blocks, pa.int64()), "needs": pa.array(rids, pa.list_(pa.int64()))})

    return run


def _reader(windows: bool):
    """The best rows of the chosen blocks: of each anchor, or of each window (``place``)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kept = [np.zeros(0, dtype=np.int64)] * 4
        if not left.num_rows or not right.num_rows:
            return _found(*kept, np.zeros(0, dtype=np.int64))
        dim = left.column("dim")[0].as_py()
        group = Anchors(left, dim)
        by_rid = np.argsort(group.rids)
        for row in right.select(["needs", "rids", "ids", "label_of", "entries"]).to_batches(max_chunksize=1):
            needs, rids, ids, labels, entries = (c.flatten().to_numpy(zero_copy_only=False) for c in row.columns)
            some = by_rid[np.searchsorted(group.rids, needs, sorter=by_rid)]
            scores = products(group.entries[some], entries.reshape(len(ids), dim))
            same = group.labels[some][:, None] == labels
            if windows:
                line = np.full(len(group.rids), -1)
                line[some] = np.arange(len(some))
                w = np.flatnonzero(line[group.owner] >= 0)
                at, score, keys = line[group.owner[w]], None, w
                score, top = scores[at], group.tops[w][:, None]
                bound, bound_id = group.known[w, :1], group.known[w, 1:]
                fits = ~same[at] & (score <= top) & (OF * score >= LEAST * top)
            else:
                keys, score = some, scores
                bound, bound_id = group.reach[some, :1], group.reach[some, 1:]
                fits = same & (group.rids[some][:, None] != rids)
            fits &= (score > bound) | ((score == bound) & (ids <= bound_id))
            a, b = np.nonzero(fits)
            kept = [np.concatenate(p) for p in zip(kept, (keys[a], score[a, b], ids[b], rids[b]), strict=True)]
            first = best(*kept, NEGATIVES if windows else POSITIVES)
            kept = [p[first] for p in kept]
        keys, score, ids, rids = kept
        if windows:
            return _found(group.rids[group.owner[keys]], score, ids, rids, group.places[keys])
        return _found(group.rids[keys], score, ids, rids, np.zeros(len(keys), dtype=np.int64))

    return run


def _found(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, rids: np.ndarray, place: np.ndarray) -> pa.Table:
    columns = {"anchor": anchor, "place": place, "score": score, "id": ids, "rid": rids}
    return pa.table({k: pa.array(v, pa.int64()) for k, v in columns.items()})


FOUND_SQL = "anchor long, place long, score long, id long, rid long"


def _search(anchors: DataFrame, blocks: DataFrame, windows: bool, slices: int, span: int) -> DataFrame:
    """What the blocks that the zone maps choose hold for the anchors: up to five rows an anchor or window and slice."""
    key = ["dim", "group", "slice"]
    slice_of: Column = F.expr(f"block div {slices}")
    zones = blocks.select("dim", "block", slice_of.alias("slice"), "lo", "hi", "labels", "least_id")
    # One row per length of vectors: the first and last of its slices and groups.
    extent = blocks.groupBy("dim").agg(
        F.min(slice_of).alias("s0"), F.max(slice_of).alias("s1"),
        F.min(F.expr(f"block div {span}")).alias("g0"), F.max(F.expr(f"block div {span}")).alias("g1"),
    )
    asking = anchors.join(extent.select("dim", "s0", "s1"), "dim").withColumn("slice", F.explode(F.sequence("s0", "s1")))
    asked = zones.join(extent.select("dim", "g0", "g1"), "dim").withColumn("group", F.explode(F.sequence("g0", "g1")))
    chosen = _renewed(asking.drop("s0", "s1")).groupBy(*key).cogroup(asked.drop("g0", "g1").groupBy(*key))
    needed = materialize(_with_key(chosen, _chooser(windows), key, "block long, needs array<long>"), "needed")
    wanted = needed.join(blocks.select("dim", "block", "rids", "ids", "label_of", "entries"), ["dim", "block"])
    readers = anchors.join(needed.select(*key).distinct(), ["dim", "group"])
    return _renewed(readers).groupBy(*key).cogroup(wanted.groupBy(*key)).applyInArrow(_reader(windows), FOUND_SQL)


def _renewed(df: DataFrame) -> DataFrame:
    """The same columns as new ones, for a cogroup of frames that read the same table."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _with_key(cogrouped, function, key: list[str], schema: str) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = function(left, right)
        side = left if left.num_rows else right
        for c in reversed(key):
            out = out.add_column(0, c, pa.array([side.column(c)[0].as_py()] * out.num_rows, side.schema.field(c).type))
        return out

    return cogrouped.applyInArrow(run, f"dim int, group long, slice long, {schema}")


def _first(found: DataFrame, by: list[str], most: int) -> DataFrame:
    """The first rows of each anchor or window; the rank is limited before the shuffle too."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


COLUMNS = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, block: int = BLOCK, slices: int = SLICE, span: int = SPAN) -> DataFrame:
    """One row per anchor, positive and hard negative (``COLUMNS``)."""
    blocks = zoned_blocks(rows, block)
    if blocks is None:
        return rows.sparkSession.createDataFrame([], COLUMNS)
    anchors = materialize(blocks.select("dim", F.expr(f"block div {span}").alias("group"), F.inline("anchors")), "anchors")
    positives = _search(anchors.drop("near", "near_ids"), blocks, False, slices, span)
    positives = materialize(_first(positives, ["anchor"], POSITIVES).drop("place"), "positives")
    of_anchor = positives.groupBy(F.col("anchor").alias("rid")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank").cast("long").alias("place"), "score"))).alias("tops")
    )
    with_windows = anchors.join(of_anchor, "rid").withColumns({"places": F.col("tops.place"), "tops": F.col("tops.score")})
    negatives = _first(_search(with_windows, blocks, True, slices, span), ["anchor", "place"], NEGATIVES)
    named = positives.select(
        "anchor", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        negatives.join(named, ["anchor", "place"])
        .join(anchors.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, v.rid, v.vec_id, v.label = a.label AS same,
    list_dot_product(a.e, v.e)::BIGINT AS score
  FROM v AS a JOIN v ON a.vec_id % {EVERY} = 0 AND a.rid <> v.rid AND len(a.e) = len(v.e)),
positive AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, rid) AS place
  FROM scored WHERE same QUALIFY place <= {POSITIVES})
SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id, n.rid)::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive AS p JOIN scored AS n ON p.anchor = n.anchor AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= {NEGATIVES}
"""
