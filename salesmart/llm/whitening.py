"""Whitening of embeddings: each vector in the leading components, with unit variances.

Entries become whole numbers, so the sums per dimension are exact and every deviation from the
mean, n * x - S, is a whole number too. Their products, centred before they are multiplied, are
added up in the tasks, one matrix for each, and the matrices by Spark. What reaches the driver is
one matrix of dimensions by dimensions, whatever the number of rows. There it is brought to
tridiagonal form by Householder reflections; the leading eigenvalues are found by bisection on
Sturm counts, the vectors by inverse iteration, those of close eigenvalues made orthogonal to each
other, and carried back through the reflections. The components are broadcast and every row is
projected on them.

Defined cases: vectors that are null or hold a null or non-finite entry take no part. Shorter
vectors are as if filled with zeros. Components without variance, as of one vector or of fewer
vectors than dimensions, cannot be scaled to variance 1 and are left out. No usable vector, no row.
Repeated rows and rows without an id are rows like others. A deviation beyond 64 bits is null. A
scaled entry beyond 2 ** 50 is an error, not a wrong number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import shipped, stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
LARGEST = 2.0**50
EPS = np.finfo(np.float64).eps
# Eigenvalues nearer than this part of the largest are made orthogonal together.
CLUSTER = 1e-3
ROWS = 4096


def usable(embedding: str = "embedding") -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(embedding).isNotNull() & F.forall(embedding, lambda x: finite(x.cast("double")))


def whole_numbers(vectors: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * c) + OFFSET of each entry as a double, a row for each vector."""
    matrix = np.zeros((len(vectors), dims))
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix[np.arange(dims) < sizes[:, None]] = values
    scaled = np.floor(matrix * SCALE)
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise OverflowError("an embedding's entry is beyond the range of exact sums")
    return scaled.astype(np.int64) + OFFSET


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part, part.column(part.schema.get_field_index(column))


def sums(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Added up as high and low halves: no sum of 2 ** 30 rows of a task passes 64 bits.
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for _, column in _slices(batches, "embedding"):
            x = whole_numbers(column, dims)
            n += len(x)
            high += (x >> 25).sum(0)
            low += (x & (2**25 - 1)).sum(0)
        yield pa.RecordBatch.from_pydict({"dim": np.arange(dims, dtype=np.int32), "n": [n] * dims, "high": high, "low": low})

    found = vectors.select("embedding").mapInArrow(run, "dim int, n long, high long, low long").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(28,0)")).alias("high"), F.sum(F.col("low").cast("decimal(28,0)")).alias("low")
    )
    rows = sorted(found.collect())
    return (int(rows[0].n) if rows else 0), [int(r.high) * 2**25 + int(r.low) for r in rows]


def centred(x: np.ndarray, n: int, total: Sequence[int]) -> np.ndarray:
    """n * x - total, exactly: as 64-bit numbers where they fit, else as Python's."""
    mean = np.array([t // n for t in total], np.int64)
    rest = np.array([t - n * (t // n) for t in total], object)
    off = x - mean
    if int(np.abs(off).max(initial=0) + 1) * n < 2**62:
        return off * n - rest.astype(np.int64)
    return off.astype(object) * n - rest


def centred_covariance(vectors: DataFrame, dims: int, n: int, total: Sequence[int]) -> np.ndarray:
    """Covariance of the whole numbers, divisor n, centred at the exact mean."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, column in _slices(batches, "embedding"):
            yield centred(whole_numbers(column, dims), n, total).astype(np.float64) / n

    return _products(vectors.select("embedding"), dims, n, rows)


def _products(df: DataFrame, dims: int, n: int, rows) -> np.ndarray:
    """Sum of the products of the centred `rows` of all tasks, over n; one matrix for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = np.zeros((dims, dims))
        for part in rows(batches):
            matrix += part.T @ part
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "x": matrix[i, j]})

    found = df.mapInArrow(run, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    matrix = np.zeros((dims, dims))
    for row in found.collect():  # dims * (dims + 1) / 2 rows, whatever the number of vectors
        matrix[row.i, row.j] = matrix[row.j, row.i] = row.x / n
    return matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal and off-diagonal of Q' A Q, and the reflections (first row, unit vector) of Q."""
    a = np.array(matrix, np.float64)
    d = len(a)
    reflections = []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if np.linalg.norm(x[1:]) <= EPS * EPS * size:
            continue  # nothing to clear below the off-diagonal
        x[0] += np.copysign(size, x[0])
        v = x / np.linalg.norm(x)
        block = a[k + 1 :, k + 1 :]
        p = block @ v
        w = p - (v @ p) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        reflections.append((k + 1, v))
    return a.diagonal().copy(), a.diagonal(-1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value of `at` the number of eigenvalues below it: the negative pivots of T - at."""
    least = np.finfo(np.float64).tiny / EPS
    q = diagonal[0] - at
    count = (q < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < least, -least, q)
        q = diagonal[i] - at - off[i - 1] ** 2 / q
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest, falling, each bisected until its bounds are neighbours or of equal size."""
    d = len(diagonal)
    reach = np.concatenate([[0], np.abs(off)]) + np.concatenate([np.abs(off), [0]])
    wide = EPS * max(np.abs(diagonal).max(), reach.max()) * d
    low = np.full(k, (diagonal - reach).min() - wide)
    high = np.full(k, (diagonal + reach).max() + wide)
    wanted = d - 1 - np.arange(k)  # so many eigenvalues lie below
    for _ in range(200):
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        above = sturm_counts(diagonal, off, middle) > wanted
        high, low = np.where(above, middle, high), np.where(above, low, middle)
    return low + (high - low) / 2


class Pivoted:
    """Factors of T - e with row exchanges, for repeated solving."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, e: float, least: float):
        d = len(diagonal)
        self.main = diagonal - e
        self.up = np.append(off, 0.0)  # first above the diagonal
        self.up2 = np.zeros(d)  # second above, made by exchanges
        below = off.copy()
        self.times, self.swap = np.zeros(d), np.zeros(d, bool)
        for i in range(d - 1):
            if abs(below[i]) > abs(self.main[i]):
                self.swap[i] = True
                self.main[i], below[i] = below[i], self.main[i]
                self.up[i], self.main[i + 1] = self.main[i + 1], self.up[i]
                self.up2[i], self.up[i + 1] = self.up[i + 1], 0.0
            if abs(self.main[i]) < least:
                self.main[i] = least
            self.times[i] = below[i] / self.main[i]
            self.main[i + 1] -= self.times[i] * self.up[i]
            self.up[i + 1] -= self.times[i] * self.up2[i]
        if abs(self.main[-1]) < least:
            self.main[-1] = least

    def solve(self, b: np.ndarray) -> np.ndarray:
        b, d = b.copy(), len(b)
        for i in range(d - 1):
            if self.swap[i]:
                b[i], b[i + 1] = b[i + 1], b[i]
            b[i + 1] -= self.times[i] * b[i]
        for i in range(d - 1, -1, -1):
            if i + 1 < d:
                b[i] -= self.up[i] * b[i + 1]
            if i + 2 < d:
                b[i] -= self.up2[i] * b[i + 2]
            b[i] /= self.main[i]
        return b


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, one row for each of the falling `values`.

    Vectors of a cluster, values nearer than CLUSTER of the largest, are made orthogonal to those
    before them in every step. Start vectors are fixed.
    """
    d, scale = len(diagonal), max(np.abs(diagonal).max(), np.abs(off).max(initial=0))
    least = EPS * scale
    rng = np.random.default_rng(d)
    vectors: list[np.ndarray] = []
    cluster = 0  # where the cluster of the present value starts
    for k, e in enumerate(values):
        if k and values[k - 1] - e > CLUSTER * scale:
            cluster = k
        shift = e - 4 * least * (k - cluster)  # equal values are taken a little apart
        factors = Pivoted(diagonal, off, shift, least)
        x = rng.uniform(0.5, 1.0, d)
        for _ in range(6):
            x = factors.solve(x / np.abs(x).max())
            for _twice in range(2):
                for other in vectors[cluster:]:
                    x -= (other @ x) * other
            x /= np.linalg.norm(x)
        vectors.append(x)
    return np.array(vectors).reshape(len(values), d)


def principal_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues that are not zero to working precision, and their unit vectors as
    rows."""
    d = len(matrix)
    scale = np.abs(matrix).max(initial=0)
    if scale == 0:
        return np.zeros(0), np.zeros((0, d))
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, min(k, d))
    values = values[values > 4 * d * EPS * max(values[0], 0)]
    vectors = inverse_iteration(diagonal, off, values)
    for first, v in reversed(reflections):
        vectors[:, first:] -= 2 * np.outer(vectors[:, first:] @ v, v)
    return values * scale, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def projected(vectors: DataFrame, dims: int, n: int, total: Sequence[int], values: np.ndarray, components: np.ndarray) -> DataFrame:
    """(vec_id, deviation, whitened array) of each vector."""
    load = shipped(vectors.sparkSession, (components / np.sqrt(values)[:, None]).T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = load()
        for batch, column in _slices(batches, "embedding"):
            off = centred(whole_numbers(column, dims), n, total)
            if off.dtype == object or float(np.abs(off).max(initial=0)) ** 2 * dims >= 2.0**62:
                far = [sum(int(v) ** 2 for v in row) for row in off]
            else:
                far = (off * off).sum(1).tolist()
            whitened = off.astype(np.float64) / n @ weights
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("vec_id")),
                    pa.array([f if f < 2**63 else None for f in far], pa.int64()),
                    pa.ListArray.from_arrays(np.arange(0, whitened.size + 1, max(1, weights.shape[1])).astype(np.int32), whitened.ravel()),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the covariance of the `whitened` rows, minus the identity."""
    means = rows.select(F.posexplode("whitened")).groupBy("pos").agg(F.sum("col").alias("total")).collect()
    mean = np.zeros(k)
    for row in means:  # one row for each component
        mean[row.pos] = row.total / n

    def centred_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, column in _slices(batches, "whitened"):
            yield column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k) - mean

    covariance = _products(rows.select("whitened"), k, n, centred_rows)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) from (vec_id,
    embedding): a row for each usable vector and component."""
    found = vectors.where(usable()).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    dims = found.agg(F.max(F.size("embedding"))).first()[0] or 0
    empty = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    empty = found.sparkSession.createDataFrame([], empty.format(found.schema["vec_id"].dataType.simpleString()))
    if dims == 0:
        return empty
    n, total = sums(found, dims)
    matrix = centred_covariance(found, dims, n, total)
    values, components = principal_components(matrix, k)
    if len(values) == 0:
        return empty
    rows = stored(projected(found, dims, n, total, values, components), "whitened")
    explained = F.array(*[F.lit(float(e / np.trace(matrix))) for e in values])
    error = identity_error(rows, n, len(values))
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, "at").alias("explained"), F.lit(error).alias("identity_error"),
    )
