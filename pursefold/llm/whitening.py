"""Whitening of embeddings: principal components by FEAST, scaled to unit variance.

Vectors that are null or hold a null or a number that is not finite are dropped; so are those without entries and those whose
length is not the commonest (of equally common ones the greatest). Each entry c becomes the whole number
floor(64 * c) + 1000000, so sums and products over all vectors are exact, whatever tasks added them up; entries beyond 2^39
count as 2^39. All vectors left are the fit list.

Tasks add up the products of vectors less the rounded mean; what is collected is one number for each pair of dimensions. The
spectrum is cut into intervals by inertia counts; the intervals are solved as tasks, and the pairs found are counted again.
Components are ordered by falling eigenvalue; of each the entry of largest size is positive. There are as many as have an
eigenvalue above rounding error, at most `most`: none, and so no rows, for equal vectors. Vectors of equal id each have rows.
An empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pursefold.llm.common import written
from pursefold.llm.feast import EPS, Spectrum, pairs

SCALE, OFFSET, GREATEST, COMPONENTS = 64, 1_000_000, 1 << 45, 32


def rounded(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): the fit list in whole numbers."""
    sound = ~F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(vector, lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-float(GREATEST))), F.lit(float(GREATEST)))) + OFFSET)
    rows = vectors.filter(F.col(vector).isNotNull()).filter(sound & (F.size(vector) > 0))
    rows = written(rows.select(F.col(id).alias("vec_id"), whole.alias("x")), "whitening")
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return rows.filter(F.size("x") == sizes["size"]) if sizes else rows


def matrix_of(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def products(y: np.ndarray) -> np.ndarray:
    """y' y exactly, in the fastest numbers that can hold it."""
    most = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if most < 1 << 53:
        y = y.astype(float)
        return (y.T @ y).astype(np.int64).astype(object)
    if most >= 1 << 63:
        y = y.astype(object)
    return (y.T @ y).astype(object)


def _added(rows: DataFrame, column: str, kind: str, part: Callable[[np.ndarray], np.ndarray]) -> dict[tuple[int, int], int]:
    """Sums over all rows of the matrix that `part` makes of a block of rows; only those not below the diagonal."""
    exact = kind != "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = np.atleast_2d(part(matrix_of(batch.column(0))))
                total = found if total is None else total + found
        if total is not None:
            i, j = np.triu_indices(total.shape[1]) if len(total) > 1 else (np.zeros(total.shape[1], int), np.arange(total.shape[1]))
            values = total[i, j]
            made = pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)) if exact else pa.array(values.astype(float))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), made], ["i", "j", "value"])

    sums = rows.select(column).mapInArrow(run, f"i int, j int, value {kind}").groupBy("i", "j").agg(F.sum("value").alias("value"))
    return {(r.i, r.j): int(r.value) if exact else r.value for r in sums.collect()}


def _square(sums: dict, size: int, of: Callable[[int, int], float]) -> np.ndarray:
    return np.array([[of(*((i, j) if i <= j else (j, i))) for j in range(size)] for i in range(size)], float).reshape(size, size)


class Fit:
    """Count, exact sums and covariance of the fit list."""

    def __init__(self, rows: DataFrame):
        exact = "decimal(38,0)"
        first = lambda x: np.concatenate([x.astype(object).sum(axis=0) if np.abs(x).max() > 1 << 48 else x.sum(axis=0), [len(x)]]).astype(object)
        sums = _added(rows, "x", exact, first)
        self.size = max(len(sums) - 1, 0)
        self.n = sums[0, self.size] if sums else 0
        self.sums = [sums[0, k] for k in range(self.size)]
        self.middle = middle = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        self.rest = rest = [s - self.n * m for s, m in zip(self.sums, middle)]
        centre = np.array(middle, np.int64)
        found = _added(rows, "x", exact, lambda x: products(x - centre)) if self.n else {}
        if self.size == 1:
            found = {(0, 0): found[0, 0]}
        # Centred at the rounded mean; what is left of the mean is taken out exactly.
        self.covariance = _square(found, self.size, lambda i, j: (self.n * found[i, j] - rest[i] * rest[j]) / (self.n * self.n))


def components(fit: Fit, spark, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit vectors as columns, of the largest components."""
    matrix = fit.covariance
    spectrum = Spectrum(matrix)
    many = min(most, spectrum.size - spectrum.below(max(fit.size, 8) * EPS * spectrum.norm)) if spectrum.norm else 0
    if not many:
        return np.zeros(0), np.zeros((fit.size, 0))
    cuts = spectrum.intervals(many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*(c.to_pylist() for c in batch.columns)):
                values, vectors = pairs(matrix, low, high, count)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], ["value", "vector"])

    asked = spark.createDataFrame(cuts, "low double, high double, count int").repartition(len(cuts))
    found = sorted(((r.value, r.vector) for r in asked.mapInArrow(run, "value double, vector array<double>").collect()), reverse=True)
    if len(found) != sum(count for _, _, count in cuts) or len(found) != spectrum.size - spectrum.below(cuts[-1][0]):
        raise ArithmeticError("an eigenvalue was missed")
    # One more Rayleigh-Ritz on all that was found makes vectors of different intervals orthogonal to rounding error.
    basis, _ = np.linalg.qr(np.array([v for _, v in found]).T)
    projected = basis.T @ matrix @ basis
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    vectors = (basis @ turn)[:, ::-1][:, :many]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(many)])
    return values[::-1][:many], vectors * signs


def _deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Of each row the sum of (n * y - rest)^2; null if it is no 64-bit number."""
    most = (n * int(np.abs(y).max(initial=0)) + max(map(abs, rest))) ** 2 * y.shape[1]
    z = (y if most < 1 << 63 else y.astype(object)) * n - np.array(rest, np.int64 if most < 1 << 63 else object)
    return [int(v) if v < 1 << 63 else None for v in (z * z).sum(axis=1)]


def projected(rows: DataFrame, fit: Fit, values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """(vec_id, deviation, whitened): one number for each component."""
    kind, scaled, n, rest = rows.schema["vec_id"].dataType, vectors / np.sqrt(values), fit.n, fit.rest
    centre, left = np.array(fit.middle, np.int64), np.array([r / n for r in rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = matrix_of(batch.column(1)) - centre
                done = (y - left) @ scaled
                lists = pa.ListArray.from_arrays(np.arange(len(y) + 1, dtype=np.int32) * done.shape[1], pa.array(done.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_deviations(y, n, rest), pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    schema = T.StructType([T.StructField("vec_id", kind), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return rows.select("vec_id", "x").mapInArrow(run, schema)


def identity_error(rows: DataFrame, many: int, n: int) -> float:
    """The largest entry of the covariance of `whitened` less the identity."""
    sums = _added(rows, "whitened", "double", lambda w: w.sum(axis=0))
    centre = np.array([sums[0, k] for k in range(many)]) / n
    found = _added(rows, "whitened", "double", lambda w: (w - centre).T @ (w - centre))
    return float(np.abs(_square(found, many, lambda i, j: found[i, j]) / n - np.eye(many)).max())


def whitened(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row for each vector of the fit list: vec_id, n, deviation, whitened and explained (a number for each component), identity_error."""
    rows = rounded(vectors, id, vector)
    fit = Fit(rows)
    values, axes = components(fit, vectors.sparkSession, most)
    if not len(values):
        rows = rows.select("vec_id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")).filter("false")
        error, shares = 0.0, []
    else:
        rows = written(projected(rows, fit, values, axes), "whitened")
        error, shares = identity_error(rows, len(values), fit.n), [float(e / fit.covariance.trace()) for e in values]
    explained = F.array(*(F.lit(s) for s in shares)).cast("array<double>")
    return rows.select("vec_id", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))
