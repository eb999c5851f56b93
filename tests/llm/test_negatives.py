"""Hard negatives against all products, with small blocks and awkward rows."""

import itertools
import math

import numpy as np
import pytest

from stagehouse.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, place long, `group` long, block string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, k, 1, 2, "x") for i, v, k in rows], SCHEMA).repartition(parts)


def by_hand(rows):
    some = [
        (i, (k + 1) % 10 if i % 7 == 0 else k, [max(-negatives.held(len(v)), min(negatives.held(len(v)), math.floor(256 * float(np.float32(c))))) for c in v])
        for i, v, k in rows
        if i is not None and k is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for a, (anchor, label, x) in enumerate(some):
        if anchor % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y, strict=True)), i, k) for b, (i, k, y) in enumerate(some) if b != a and len(y) == len(x)]
        for score, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            fits = sorted(s for s in scored if s[2] != label and 80 * -score <= 100 * -s[0] <= 100 * -score)
            out += [(anchor, positive, n, i, -score, -s) for n, (s, i, _) in enumerate(fits[:5], 1)]
    return sorted(out)


def held(spark, rows, **sizes):
    out = negatives.hard_negatives(frame(spark, rows), **sizes)
    assert sorted(tuple(r) for r in out.collect()) == by_hand(rows)


def random_rows(seed, n, dim, labels=4, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    which = rng.integers(0, 6, n)
    vectors = (centres[which] + spread * rng.normal(size=(n, dim))).astype(np.float32)
    return [(int(i) * 25, v.tolist(), int(k % labels)) for i, v, k in zip(rng.permutation(n), vectors, which, strict=True)]


@pytest.mark.parametrize("seed, sizes", [(1, {"block": 8, "slices": 2, "span": 4}), (2, {"block": 16, "slices": 3, "span": 1}), (3, {})])
def test_matches_all_products(spark, seed, sizes):
    held(spark, random_rows(seed, 220, 5), **sizes)


def test_awkward_rows(spark):
    rows = random_rows(4, 60, 3)
    nan, inf = float("nan"), float("inf")
    rows += [
        (None, [1.0, 1.0, 1.0], 1), (100, None, 1), (200, [1.0, None, 1.0], 1), (300, [nan, 1.0, 1.0], 1), (400, [inf, 1.0, 1.0], 2),
        (500, [1.0, 1.0, 1.0], None), (600, [], 1), (601, [], 2), (700, [1.0], 1), (701, [1.0], 1), (702, [0.9], 2), (800, [3e38, 0.0, 1.0], 1),
        (803, [3e38, 0.0, 1.0], 2), (804, [3e38, 0.0, 0.5], 1), (900, [0.5, 0.5, 0.5], 1), (900, [0.5, 0.5, 0.5], 1), (900, [0.5, 0.5, 0.25], 2),
    ]
    held(spark, rows, block=7, slices=2, span=2)


def test_a_very_common_vector(spark):
    rows = [(i, [0.5, 0.25], i % 3) for i in range(0, 900, 3)] + [(i, [0.5, 0.2], i % 2) for i in range(1, 200, 4)]
    held(spark, rows, block=16, slices=2, span=3)


def test_empty(spark):
    out = negatives.hard_negatives(frame(spark, [(1, None, 1)], 1))
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and out.count() == 0


def test_curve_visits_neighbours():
    for axes, bits in ((2, 3), (3, 2), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        place = negatives.hilbert(points, bits)
        assert sorted(place) == list(range(len(points)))
        path = points[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_zone_maps_spare_blocks(spark):
    rng = np.random.default_rng(9)
    centres = np.eye(8) * 4
    which = rng.integers(0, 8, 800)
    vectors = (centres[which] + 0.1 * rng.normal(size=(800, 8))).astype(np.float32)
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, which, strict=True))]
    blocks = negatives.zoned_blocks(frame(spark, rows), 20)
    anchors = blocks.selectExpr("dim", "0L AS `group`", "inline(anchors)").where("reach IS NOT NULL").collect()
    zones = blocks.select("block", "lo", "hi").collect()
    reached = sum(sum(max(a * x, a * y) for a, x, y in zip(r.entries, z.lo, z.hi, strict=True)) >= r.reach for r in anchors for z in zones)
    assert 0 < reached < 0.3 * len(anchors) * len(zones)
    held(spark, rows, block=20, slices=4, span=5)
