"""Fingerprints of key ranges, and what a load sets aside."""

import json
import random

import pytest
from pyspark.sql import functions as F

from stagehouse.operators import drift, typing
from stagehouse.schemas import struct

LINE = "k long, part long, v string, w double"


def by_hand(left, right):
    keys = {r[:2] for r in left} | {r[:2] for r in right}
    out = {}
    for key in keys:
        a, b = (sorted(repr(r) for r in side if r[:2] == key) for side in (left, right))
        if a != b:
            out[key] = "new" if not b else "gone" if not a else "changed"
    return out


@pytest.fixture(scope="module")
def sides():
    rng = random.Random(5)
    left = [(rng.randrange(-5000, 900_000), rng.randrange(3), rng.choice("ab"), 1.0) for _ in range(800)]
    # Nulls, repeated rows, and a key that holds a third of all rows.
    left += [(None, 1, None, 2.0), (None, 1, None, 2.0), (None, None, "a", None), (70, 1, "a", None)]
    left += [(123_456, i, "hot", 0.0) for i in range(400)]
    right = list(left)
    for i in rng.sample(range(800), 12):
        k, part, v, w = right[i]
        right[i] = rng.choice([(k, part, v, w + 1), (k + 7, part, v, w), (k, part, None, w)])
    right.remove((None, 1, None, 2.0))
    right[right.index((70, 1, "a", None))] = (70, 1, None, 1.0)
    right[right.index((123_456, 17, "hot", 0.0))] = (123_456, 17, "hot", None)
    right.append(right[3])
    return left, right


@pytest.mark.parametrize("leaf, fan", [(64, 4), (1024, 64), (1 << 30, 2)])
def test_row_drift_is_that_of_all_rows(spark, sides, leaf, fan):
    left, right = sides
    source, target = spark.createDataFrame(left, LINE), spark.createDataFrame(right, LINE)
    # Columns in another order are the same columns.
    found = drift.row_drift(source, target.select("w", "v", "part", "k"), ["k", "part"], leaf, fan).collect()
    assert {(r.k, r.part): r.change for r in found} == by_hand(left, right)
    assert len(found) == len(by_hand(left, right))
    assert all(r.range_low is None if r.k is None else 0 <= r.k - r.range_low < leaf for r in found)


def test_range_drift_counts_keys(spark, sides):
    source, target = (spark.createDataFrame(s, LINE) for s in sides)
    ranges = drift.range_drift(source, target, ["k", "part"], 64, 4).collect()
    total = {c: sum(r[f"n_{c}"] for r in ranges) for c in ("new", "gone", "changed")}
    changes = list(by_hand(*sides).values())
    assert total == {c: changes.count(c) for c in total}


def test_only_a_null_key_differs(spark):
    source = spark.createDataFrame([(None, 1, "a", 1.0), (5_000_000, 1, "a", 1.0), (1, 1, "a", 1.0)], LINE)
    target = source.where("k is not null")
    found = drift.row_drift(source, target, ["k", "part"], 4, 4).collect()
    assert [tuple(r) for r in found] == [(None, None, 1, "new")]


def test_equal_and_empty_sides_agree(spark, sides):
    rows = spark.createDataFrame(sides[0], LINE)
    none = rows.limit(0)
    assert drift.row_drift(rows, rows.repartition(5), ["k", "part"], 64, 4).isEmpty()
    assert drift.range_drift(none, none, ["k", "part"]).isEmpty()
    assert drift.row_drift(rows, none, ["k"], 64, 4).where("change <> 'new'").isEmpty()
    with pytest.raises(ValueError):
        drift.row_drift(rows, rows.drop("v"), ["k"])


def test_same_count_same_sum_of_keys_is_seen(spark):
    """What counts alone do not show: as many rows, other rows."""
    source = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    target = source.withColumn("k", F.when(F.col("k") == 500, 5000).otherwise(F.col("k")))
    found = {r.k: r.change for r in drift.row_drift(source, target, ["k"]).collect()}
    assert found == {500: "new", 5000: "gone"}


TARGET = struct("id:long born:time name")


def staged(spark, *rows):
    return spark.createDataFrame(list(rows), "record_id long, id string, born string, name string, extra string")


def test_rejects_are_split_off_in_whole(spark):
    df = staged(
        spark, (1, "7", "2024-01-01 00:00:00", "a", None), (2, "x", "soon", "b", "e"), (3, None, None, None, None), (4, "", "", "", "")
    )
    good, rejects = typing.split_rejects(df, TARGET, keep=("record_id",))
    assert sorted((r.record_id, r.id) for r in good.collect()) == [(1, 7), (3, None)]
    assert good.columns == ["record_id", "id", "born", "name"]
    found = {r.record_id: r for r in rejects.collect()}
    assert {k: r.rejected for k, r in found.items()} == {2: ["id", "born"], 4: ["id", "born"]}
    assert json.loads(found[2].raw) == {"record_id": 2, "id": "x", "born": "soon", "name": "b", "extra": "e"}


def test_blanks_may_be_null_and_too_many_rejects_fail(spark):
    df = staged(spark, (1, "", "", "a", None), (2, "x", "", "b", None))
    good, rejects = typing.split_rejects(df, TARGET, blank_null=("id", "born"), keep=("record_id",), most=0.5)
    assert (good.count(), rejects.count()) == (1, 1)
    with pytest.raises(typing.TooManyRejected, match="1 of 2"):
        typing.split_rejects(df, TARGET, blank_null=("id", "born"), most=0.4)
    good, rejects = typing.split_rejects(df.limit(0), TARGET, most=0.0)
    assert good.isEmpty() and rejects.isEmpty()
