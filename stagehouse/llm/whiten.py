"""Embedding whitening by a polarisation covariance.

Variances alone give every covariance: 2 cov(a, b) = var(a + b) - var(a) - var(b).
So tasks only square: the centred values of each dimension and the sums of each pair
of dimensions. All of it is in whole numbers, hence exact however the rows are dealt.
A first pass sums each dimension (``S``); the second subtracts ``m = floor(S / n)``
and sums squares of what is left, and the driver takes out the rest ``S - n m`` in
big integers, so the matrix is that of the values less their mean, rounded once. Only sums
reach the driver: one per dimension and pair of dimensions, whatever the number of rows.

Defined cases: a vector that is null, empty or holds null or non-finite entries is
dropped, as are vectors of another length than the most common one (the shortest of equally common ones);
scaled entries are held within ``HELD``; rows that share an id, or have none, each give
their own rows, and repeated rows count as often as they come; a component without variance has null ``whitened``
and no part in ``identity_error``; ``deviation`` is null where it exceeds a long
(``deviation_exact`` has its digits always); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from stagehouse.llm.common import read_table
from stagehouse.session import materialize

SCALE, OFFSET = 1024, 100_000
# Scaled entries beyond this are held there, so that the square of a sum of two centred ones fits 63 bits.
HELD = 1 << 29
COMPONENTS = 8
ROWS = 4096
# Components with less than this share of the largest eigenvalue count as without variance.
FLAT = 1e-12


def finite_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id`` and the vector in double precision, where it has entries and all are finite numbers."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vectors = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return vectors.where(F.size("embedding") > 0).where(~odd)


def _scaled(vectors: pa.ListArray, dim: int) -> np.ndarray:
    entries = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.clip(np.floor(entries * SCALE), -HELD, HELD).astype(np.int64) + OFFSET


def _of_length(batch: pa.RecordBatch, dim: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with vectors of that length."""
    own = batch.filter(pc.equal(pc.list_value_length(batch.column("embedding")), dim))
    for first in range(0, own.num_rows, ROWS):
        yield own.slice(first, ROWS)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and sums per dimension of a task, by length of the vectors."""
    found: dict[int, list] = defaultdict(lambda: [0, 0])
    for batch in batches:
        for dim in pc.unique(pc.list_value_length(batch.column("embedding"))).to_pylist():
            for part in _of_length(batch, dim):
                x = _scaled(part.column("embedding"), dim)
                found[dim][0] += len(x)
                found[dim][1] += x.sum(axis=0).astype(object)
    for dim, (n, total) in found.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
                pa.array([n] * dim, pa.int64()), pa.array([str(t) for t in total], pa.string()),
            ],
            names=["dim", "i", "n", "total"],
        )


def _squares(dim: int, middle: np.ndarray):
    """Sums of squares of each centred dimension (j = i) and of each sum of two (j > i)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = [(i, j) for i in range(dim) for j in range(i, dim)]
        total = np.zeros(len(place), dtype=object)
        for batch in batches:
            for part in _of_length(batch, dim):
                u = _scaled(part.column("embedding"), dim) - middle
                # As many rows at a time as surely fit 63 bits.
                most = 2 * int(np.abs(u).max(initial=0))
                step = int(max(1, min(ROWS, (1 << 62) // max(1, most * most))))
                for first in range(0, len(u), step):
                    total += _square_sums(u[first : first + step]).astype(object)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in place], pa.int32()), pa.array([j for _, j in place], pa.int32()),
                pa.array([str(t) for t in total], pa.string()),
            ],
            names=["i", "j", "total"],
        )

    return run


def _square_sums(u: np.ndarray) -> np.ndarray:
    columns = np.ascontiguousarray(u.T)
    out = []
    for i, column in enumerate(columns):
        sums = columns[i + 1 :] + column
        out.append(column @ column)
        out.extend(np.einsum("ij,ij->i", sums, sums))
    return np.array(out, dtype=np.int64)


@dataclass(frozen=True)
class Whitening:
    """What a fit learns: ``n`` rows, sums, and per component its axis, eigenvalue and share of the trace."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def middle(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], dtype=np.int64)


def polarised(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance from sums of squares about ``floor(S / n)``, each entry rounded once."""
    dim = len(rest)
    # n times the square sum less the squared rest is n**2 times a variance.
    alone = [n * squares[i, i] - rest[i] ** 2 for i in range(dim)]
    out = np.empty((dim, dim))
    for i in range(dim):
        out[i, i] = alone[i] / n**2
        for j in range(i + 1, dim):
            together = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (together - alone[i] - alone[j]) / (2 * n**2)
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from all rows of ``finite_vectors``; None without any."""
    sums = vectors.select("embedding").mapInArrow(_sums, "dim int, i int, n long, total string")
    sums = materialize(
        sums.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")), "sums"
    )
    common = sums.where("i = 0").orderBy(F.col("n").desc(), "dim").first()
    if common is None:
        return None
    dim, n = common["dim"], common["n"]
    by_place = {r["i"]: int(r["total"]) for r in sums.where(F.col("dim") == dim).collect()}
    total = [by_place[i] for i in range(dim)]
    middle, rest = np.array([s // n for s in total], dtype=np.int64), [s % n for s in total]
    squares = vectors.select("embedding").mapInArrow(_squares(dim, middle), "i int, j int, total string")
    squares = squares.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    covariance = polarised(n, rest, {(r["i"], r["j"]): int(r["total"]) for r in squares.collect()})
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(covariance))
    explained = values[order] / trace if trace > 0 else np.full(len(order), np.nan)
    return Whitening(n, total, covariance, axes[:, order], values[order], explained)


def _projector(model: Whitening):
    """From scaled vectors to whitened components; NaN where a component has no variance."""
    value = model.values
    live = value > FLAT * max(value[0], 0.0)
    weights = np.where(live, model.axes / np.sqrt(np.where(live, value, 1.0)), np.nan)
    middle, shift = model.middle, model.rest / model.n
    return lambda x: ((x - middle) - shift) @ weights


def _products(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project, k = _projector(model), len(model.values)
        alone, together = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for part in _of_length(batch, model.dim):
                w = project(_scaled(part.column("embedding"), model.dim))
                alone += w.sum(axis=0)
                together += w.T @ w
        a, b = np.indices((k, k))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(a.ravel(), pa.int32()), pa.array(b.ravel(), pa.int32()),
                pa.array(alone[a.ravel()]), pa.array(together.ravel()),
            ],
            names=["a", "b", "alone", "together"],
        )

    return run


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured on the rows."""
    sums = vectors.select("embedding").mapInArrow(_products(model), "a int, b int, alone double, together double")
    k, n = len(model.values), model.n
    mean, product = np.zeros(k), np.zeros((k, k))
    for r in sums.groupBy("a", "b").agg(F.sum("alone").alias("alone"), F.sum("together").alias("together")).collect():
        mean[r["a"]] = r["alone"] / n
        product[r["a"], r["b"]] = r["together"] / n
    gap = np.abs(product - np.outer(mean, mean) - np.eye(k))
    return float(np.nanmax(gap)) if np.isfinite(gap).any() else None


def _deviations(model: Whitening, x: np.ndarray) -> list[int] | np.ndarray:
    """Exact sums of (n x - S)**2, which is n times the value less the middle, less the rest."""
    u, rest, n = x - model.middle, model.rest, model.n
    most = n * (int(np.abs(u).max(initial=0)) + 1)
    if most * most * model.dim < 1 << 63:
        gap = n * u - rest
        return np.einsum("ij,ij->i", gap, gap)
    gap = n * u.astype(object) - rest.astype(object)
    return list((gap * gap).sum(axis=1))


def _rows(model: Whitening, error: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project, k = _projector(model), len(model.values)
        for batch in batches:
            for part in _of_length(batch, model.dim):
                x = _scaled(part.column("embedding"), model.dim)
                exact = [int(d) for d in _deviations(model, x)]
                count = len(x)
                each = pa.array(np.repeat(np.arange(count), k))
                fits = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(each),
                        pa.array(np.tile(np.arange(1, k + 1), count), pa.int32()),
                        pa.array(np.full(count * k, model.n), pa.int64()),
                        fits.take(each),
                        pa.array(project(x).ravel(), from_pandas=True),
                        pa.array(np.tile(model.explained, count), from_pandas=True),
                        pa.array([error] * (count * k), pa.float64()),
                        pa.array([str(d) for d in exact], pa.string()).take(each),
                    ],
                    names=COLUMNS,
                )

    return run


COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component (``COLUMNS``)."""
    vectors = finite_vectors(rows)
    kinds = [
        rows.schema["vec_id"].dataType, IntegerType(), LongType(), LongType(), DoubleType(), DoubleType(), DoubleType(), StringType(),
    ]
    schema = StructType([StructField(c, t) for c, t in zip(COLUMNS, kinds, strict=True)])
    model = fit(vectors, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    return vectors.mapInArrow(_rows(model, identity_error(vectors, model)), schema)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
