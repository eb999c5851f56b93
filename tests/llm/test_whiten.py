"""Whitening against exact fractions and numpy."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagehouse.llm import whiten

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, n string, i int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", 7) for i, v in vectors], SCHEMA)


def by_hand(vectors):
    """Scaled vectors and their covariance, in whole numbers up to one division."""
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(r[k] for r in x), n) for k in range(d)]
    gap = np.array([[n * c - int(n * m) for c, m in zip(r, mean, strict=True)] for r in x], dtype=object)
    return x, mean, np.array([[c / n**3 for c in r] for r in gap.T @ gap])


def held_against(rows, vectors, ids):
    x, mean, cov = by_hand(vectors)
    n, d = len(x), len(x[0])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    got = {(r.vec_id, r.component): r for r in rows}
    k = min(8, d)
    assert sorted(got) == sorted((i, c) for i in ids for c in range(1, k + 1))
    signs = {}
    for at, i in enumerate(ids):
        centred = np.array([float(a - b) for a, b in zip(x[at], mean, strict=True)])
        deviation = sum((n * a - int(n * b)) ** 2 for a, b in zip(x[at], mean, strict=True))
        for c in range(1, k + 1):
            r = got[i, c]
            assert (r.n, r.deviation_exact) == (n, str(deviation))
            assert r.deviation == (deviation if deviation < 1 << 63 else None)
            assert abs(r.explained - values[c - 1] / np.trace(cov)) <= 1e-9 * r.explained + 1e-12
            want = centred @ axes[:, c - 1] / np.sqrt(values[c - 1])
            sign = signs.setdefault(c, np.sign(want * r.whitened) if abs(want) > 1e-3 else None)
            if sign is None:
                signs.pop(c)
                assert abs(abs(r.whitened) - abs(want)) < 1e-6
            else:
                assert abs(r.whitened - sign * want) < 1e-6
            assert 0 <= r.identity_error < 1e-6


def test_matches_fractions(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(60, 10)) * np.arange(1, 11)).astype(np.float32).tolist()
    vectors[7] = vectors[3]
    odd = [(900, None), (901, []), (902, [None] + [1.0] * 9), (903, [float("nan")] * 10), (904, [float("inf")] * 10), (905, [1.0, 2.0])]
    rows = frame(spark, [*enumerate(vectors), *odd]).repartition(5)
    held_against(whiten.whiten(rows).collect(), vectors, list(range(60)))


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(6)
    vectors = (rng.normal(size=(50, 3)) * 90_000).astype(np.float32).tolist()
    held_against(whiten.whiten(frame(spark, list(enumerate(vectors)))).collect(), vectors, list(range(50)))


def test_holds_huge_entries(spark):
    rows = whiten.whiten(frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.5, 3.0])])).collect()
    assert len(rows) == 6 and all(np.isfinite(r.whitened) for r in rows)
    assert all(r.identity_error < 1e-4 for r in rows)


def test_repeated_ids_null_ids_and_flat_components(spark):
    rows = whiten.whiten(frame(spark, [(1, [1.0, 5.0]), (1, [2.0, 5.0]), (None, [4.0, 5.0]), (None, [4.0, 5.0])])).collect()
    assert len(rows) == 8 and {r.n for r in rows} == {4}
    assert all((r.whitened is None) == (r.component == 2) for r in rows)
    one = whiten.whiten(frame(spark, [(1, [1.0, 5.0])])).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in one] == [(None, None, None, 0)] * 2


def test_empty(spark):
    empty = whiten.whiten(frame(spark, [(1, None), (2, [])]))
    assert empty.columns == whiten.COLUMNS and empty.count() == 0


@pytest.mark.parametrize("parts", [1, 9])
def test_whole_table(spark, parts):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").repartition(parts)
    kept = table.where("embedding is not null").where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x))).collect()
    held_against(whiten.whiten(table).collect(), [r.embedding for r in kept], [r.vec_id for r in kept])
