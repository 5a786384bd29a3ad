"""Embedding whitening: vectors are turned and scaled so that their components are uncorrelated and of variance one.

Three passes over the vectors, each with sums per task that Spark adds up: counts and exact integer sums per dimension; the
covariance of the centred vectors; the covariance of the result, as a check. The matrix of the second pass is as large as the
dimensions squared, whatever the number of rows, and is taken apart on the driver: Householder reflections make it tridiagonal,
bisection on Sturm counts finds the leading eigenvalues, and inverse iteration their vectors, orthogonalised again within
clusters of close eigenvalues. The axes go to the tasks, which project.

Vectors are worked on as whole numbers, x = floor(scale * c) + shift, so that sums and deviations are exact.

Defined results: a vector that is null, or holds a null or an entry that is not finite or too large for x, takes no part; neither
does one of another length than most (of two lengths equally frequent, the longer counts), nor one without entries. Repeated rows
count each, a null id is an id like any other, an empty table gives an empty table. Axes whose eigenvalue is not above the rounding
of the trace (constant dimensions, fewer vectors than dimensions) cannot be scaled to one and are left out. A deviation beyond
64 bits is null. Only the id and the vector column are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_CELLS = 1 << 20
LARGEST = float(1 << 62)


def usable(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of vectors: the values in a row, each vector's first place and length, and which ones are whole and finite."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.cumsum(lengths) - lengths
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    return values, first, lengths, (lengths > 0) & (bad[first + lengths] == bad[first])


@dataclass
class Grid:
    """The whole numbers that stand for the entries."""

    scale: float = 64.0
    shift: int = 1_000_000

    def matrices(self, batch: pa.RecordBatch, dims: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in the batch, their x-vectors) for each length of vector, or for one, a bounded number of rows at a time."""
        values, first, lengths, whole = usable(batch.column("vector"))
        for length in np.unique(lengths[whole]).tolist() if dims is None else [dims]:
            rows = np.flatnonzero(whole & (lengths == length))
            step = max(1, SLICE_CELLS // length)
            for part in (rows[at : at + step] for at in range(0, len(rows), step)):
                x = np.floor(self.scale * values[first[part, None] + np.arange(length)])
                fits = (np.abs(x) < LARGEST).all(axis=1)
                if fits.any():
                    yield part[fits], x[fits].astype(np.int64) + self.shift


def exact(x: np.ndarray, factor: int) -> np.ndarray:
    """x, as Python's own numbers where 64 bits cannot hold `factor` times its largest entry."""
    return x if int(np.abs(x).max()) * factor < 1 << 62 else x.astype(object)


@dataclass
class Whitening:
    grid: Grid
    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        sums = np.array(self.sums, object)
        wide = exact(x, 2 * self.n)
        return wide * self.n - (sums if wide.dtype == object else sums.astype(np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.differences(x).astype(np.float64) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.eigenvalues))


def deviations(differences: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, exactly; None beyond 64 bits."""
    if differences.dtype != object:
        if float(np.abs(differences).max()) ** 2 * differences.shape[1] < 2.0**62:
            return (differences * differences).sum(axis=1).tolist()
        differences = differences.astype(object)
    return [total if total < 1 << 63 else None for total in (differences * differences).sum(axis=1).tolist()]


def _narrow(df: DataFrame, vector: str, *others: str) -> DataFrame:
    return df.select(*others, F.col(vector).cast("array<double>").alias("vector"))


def column_sums(df: DataFrame, vector: str, grid: Grid) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension, of the vectors of the most frequent length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for _, x in grid.matrices(batch):
                n, sums = found.get(x.shape[1], (0, 0))
                found[x.shape[1]] = n + len(x), sums + exact(x, len(x)).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array([n for n, _ in found.values()], pa.int64()),
             pa.array([[str(value) for value in sums] for _, sums in found.values()], pa.list_(pa.string()))],
            ["dims", "n", "sums"],
        )

    parts = _narrow(df, vector).mapInArrow(add, "dims int, n bigint, sums array<string>")
    flat = parts.select("dims", "n", F.posexplode("sums").alias("at", "part"))
    total = F.sum(F.col("part").cast("decimal(38,0)"))
    # One row per dimension of the length that most vectors have.
    by_place = flat.groupBy("dims", "at").agg(F.sum("n").alias("n"), total.alias("total"))
    top = by_place.filter("at = 0").orderBy(F.desc("n"), F.desc("dims")).select("dims").first()
    if top is None:
        return 0, []
    rows = sorted(by_place.filter(F.col("dims") == top["dims"]).collect(), key=lambda row: row["at"])
    return rows[0]["n"], [int(row["total"]) for row in rows]


def second_moments(df: DataFrame, vector: str, grid: Grid, dims: int, size: int, values) -> np.ndarray:
    """Sum over all vectors of v' v, where v = values(x) has `size` entries. A task sends one matrix."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for _, x in grid.matrices(batch, dims):
                v = values(x)
                total += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(list(total))], ["i", "row"])

    parts = _narrow(df, vector).mapInArrow(add, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "part")).groupBy("i", "j").agg(F.sum("part").alias("value"))
    # At most size * size rows, a matrix of the dimensions.
    rows = cells.collect()
    matrix = np.zeros((size, size))
    for row in rows:
        matrix[row["i"], row["j"]] = row["value"]
    return (matrix + matrix.T) / 2


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = 32, grid: Grid | None = None) -> Whitening:
    """Fitted on all usable vectors of the table."""
    grid = grid or Grid()
    n, sums = column_sums(df, vector, grid)
    empty = Whitening(grid, n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    if not n:
        return empty
    covariance = second_moments(df, vector, grid, len(sums), len(sums), empty.centred) / n
    eigenvalues, vectors = leading_eigenpairs(covariance, components)
    trace = float(np.trace(covariance))
    above = eigenvalues > len(sums) * np.finfo(float).eps * trace
    return Whitening(grid, n, sums, eigenvalues[above], vectors[:, above], trace)


def whiten(df: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`key`, the whitened vector and its exact deviation (the sum over dimensions of (n * x - S) squared) of every usable row."""
    kind = df.select(key).schema[0].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, x in model.grid.matrices(batch, len(model.sums)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(places)), pa.array(list(model.whiten(x)), pa.list_(pa.float64())),
                     pa.array(deviations(model.differences(x)), pa.int64())],
                    [key, "whitened", "deviation"],
                )

    schema = f"`{key}` {kind}, whitened array<double>, deviation bigint"
    if not model.sums:
        return df.sparkSession.createDataFrame([], schema)
    return _narrow(df, vector, F.col(key).alias("key")).mapInArrow(project, schema)


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def with_one(x: np.ndarray) -> np.ndarray:
        return np.hstack([model.whiten(x), np.ones((len(x), 1))])

    # The last column sums up the vectors, which are centred already; what rounding has left of their mean goes too.
    moments = second_moments(df, vector, model.grid, len(model.sums), k + 1, with_one) / model.n
    mean = moments[:k, k]
    return float(np.abs(moments[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit reflectors of Q with Q' A Q tridiagonal."""
    a, reflectors = matrix.astype(np.float64, copy=True), []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        norm = np.linalg.norm(v)
        if norm:
            v[0] += np.copysign(norm, v[0])
            v /= np.linalg.norm(v)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] -= 2 * (v @ a[k + 1 :, k]) * v
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_counts(diagonal: np.ndarray, squares: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of the points."""
    q = diagonal[0] - at
    below = (q < 0).astype(np.int64)
    for d, square in zip(diagonal[1:], squares, strict=True):
        q = d - at - square / np.where(np.abs(q) < least, np.copysign(least, q), q)
        below += q < 0
    return below


def bisect(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The `count` largest eigenvalues, falling, each to the last bits of the matrix's norm."""
    reach = np.abs(np.concatenate((off, [0]))) + np.abs(np.concatenate(([0], off)))
    low, high = (diagonal - reach).min(), (diagonal + reach).max()
    scale = max(abs(low), abs(high), np.finfo(float).tiny)
    low, high = low - 2 * np.finfo(float).eps * scale, high + 2 * np.finfo(float).eps * scale
    least = max(np.finfo(float).eps ** 2 * scale, np.finfo(float).tiny)
    wanted = len(diagonal) - 1 - np.arange(count)
    lows, highs = np.full(count, low), np.full(count, high)
    while True:
        middle = (lows + highs) / 2
        if ((middle <= lows) | (middle >= highs) | (highs - lows <= np.finfo(float).eps * scale / 4)).all():
            return middle
        above = sturm_counts(diagonal, off * off, middle, least) <= wanted
        lows, highs = np.where(above, middle, lows), np.where(above, highs, middle)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """x with (T - shift) x = right, by elimination with row exchanges; a vanishing pivot is replaced by a tiny one."""
    n = len(diagonal)
    main, upper = (diagonal - shift).tolist(), [*off.tolist(), 0.0, 0.0]
    second, x, lower = [0.0] * (n + 1), right.tolist(), off.tolist()
    for k in range(n - 1):
        pivot, under = main[k], lower[k]
        if abs(under) > abs(pivot):
            factor, beside = pivot / under, upper[k]
            main[k], upper[k], second[k], x[k], x[k + 1] = under, main[k + 1], upper[k + 1], x[k + 1], x[k]
            main[k + 1] = beside - factor * upper[k]
            upper[k + 1] = -factor * second[k]
        else:
            if abs(pivot) < least:
                main[k] = pivot = least
            factor = under / pivot
            main[k + 1] -= factor * upper[k]
        x[k + 1] -= factor * x[k]
    if abs(main[n - 1]) < least:
        main[n - 1] = least
    for k in range(n - 1, -1, -1):
        total = x[k]
        if k + 1 < n:
            total -= upper[k] * x[k + 1]
        if k + 2 < n:
            total -= second[k] * x[k + 2]
        x[k] = total / main[k]
    return np.array(x)


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, eigenvalues: np.ndarray) -> np.ndarray:
    """Unit eigenvectors by inverse iteration; those of a cluster of close eigenvalues are orthogonalised against each other."""
    n, eps, rng = len(diagonal), np.finfo(float).eps, np.random.default_rng(11)
    scale = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    found, start, shift = np.zeros((n, len(eigenvalues))), 0, np.inf
    for k, value in enumerate(eigenvalues):
        if k and eigenvalues[k - 1] - value > 1e-3 * scale:
            start = k
        # Equal eigenvalues get shifts of their own, and so vectors of their own.
        shift = min(value, shift - 10 * eps * scale) if k > start else value
        vector, cluster = rng.uniform(-1, 1, n), found[:, start:k]
        for _ in range(6):
            vector = solve_shifted(diagonal, off, shift, vector / np.linalg.norm(vector), eps * scale)
            grown = np.linalg.norm(vector)
            for _ in range(2):
                vector -= cluster @ (cluster.T @ vector)
            if np.linalg.norm(vector) < 1e-8 * grown:
                vector = rng.uniform(-1, 1, n)
        vector -= cluster @ (cluster.T @ vector)
        found[:, k] = vector / np.linalg.norm(vector)
    return found


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    count, size = min(count, len(matrix)), np.abs(matrix).max()
    if not size:
        return np.zeros(count), np.eye(len(matrix))[:, :count]
    diagonal, off, reflectors = tridiagonal(matrix / size)
    eigenvalues = bisect(diagonal, off, count)
    vectors = tridiagonal_vectors(diagonal, off, eigenvalues)
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        if v.any():
            vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    return eigenvalues * size, vectors
