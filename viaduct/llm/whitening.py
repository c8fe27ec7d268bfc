"""Embedding whitening.

Vectors become integers (``floor(1024 c) + 100000``), so their sums are exact whatever the order. Map
tasks subtract the mean and multiply (one ``d x d`` partial sum a task, by rows); the
rows of all tasks are added up in Spark, spread over ``d`` keys. The driver holds
``d x d`` numbers, a size given by the width of a vector and not by the rows, and finds the leading
components itself: Householder reflections make the covariance
tridiagonal, Sturm counts bisect for the largest eigenvalues, inverse iteration gives the vectors, where
those of close eigenvalues are kept orthogonal to each other. Components and mean, ``(k + 1) d``
numbers, go to all tasks, which project their vectors.

The covariance of the whitened vectors, centred on their own mean, is one more aggregation over the
written result; its distance from the identity is part of the result.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped, as are
vectors whose length isn't the most frequent one (the longer one of a tie) and empty ones; rows
that repeat an id are rows of their own; a null id stays null. Components whose eigenvalue is not above
``RANK`` times the largest can't be scaled to variance one and are left out, so one vector, or copies of
one, give no row; an empty table gives an empty result. Entries that would pass 2^61 count as that. ``deviation`` is null where the exact
sum passes 64 bits (``deviation_exact`` has it as a decimal); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import map_arrow, staged

COMPONENTS = 8
RANK = 1e-12
BLOCK_ROWS = 4096
# Entries beyond this in size count as it.
LARGEST = 1 << 61


def householder(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, subdiagonal, reflections) of a symmetric matrix; reflection i works on what lies below row i."""
    a = matrix.copy()
    reflections = []
    for i in range(len(a) - 2):
        x = a[i + 1 :, i].copy()
        size = np.abs(x).max(initial=0.0)
        v = np.zeros_like(x)
        if size > 0 and np.abs(x[1:]).max(initial=0.0) > 0:
            x /= size
            x[0] += np.copysign(np.sqrt(x @ x), x[0])
            v = x / np.sqrt(x @ x)
            # (I - 2 v v') A (I - 2 v v') on the rest of the matrix
            rest = a[i + 1 :, i + 1 :]
            p = rest @ v
            w = p - (v @ p) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
            column = a[i + 1 :, i]
            column -= 2 * v * (v @ column)
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def count_above(diagonal: np.ndarray, below: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix lie above each of the numbers."""
    least = np.finfo(float).tiny / np.finfo(float).eps
    squares = np.concatenate([[0.0], below * below])
    pivot, count = np.ones_like(at), np.zeros(len(at), np.int64)
    for d, s in zip(diagonal, squares, strict=True):
        pivot = d - at - s / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot > 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, below: np.ndarray, k: int) -> np.ndarray:
    """The k largest, falling, each bisected down to neighbouring doubles."""
    reach = np.concatenate([[0.0], np.abs(below)]) + np.concatenate([np.abs(below), [0.0]])
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    span = max(np.abs(low).max(), np.abs(high).max(), np.finfo(float).tiny)
    low, high = low - 1e-12 * span, high + 1e-12 * span
    rank = np.arange(1, k + 1)
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return high
        over = count_above(diagonal, below, middle) >= rank
        low = np.where(open_ & over, middle, low)
        high = np.where(open_ & ~over, middle, high)


def solve_shifted(diagonal: np.ndarray, below: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(T - shift) x = right for a tridiagonal T, by elimination with row exchanges."""
    n = len(diagonal)
    scale = max(np.abs(diagonal).max(), np.abs(below).max(initial=0.0), np.finfo(float).tiny)
    least = np.finfo(float).eps * scale
    d, e, f = diagonal - shift, np.concatenate([below, [0.0]]), np.zeros(n)
    under, x = np.concatenate([below, [0.0]]), right.copy()
    for i in range(n - 1):
        if abs(d[i]) >= abs(under[i]):
            if abs(d[i]) < least:
                d[i] = least
            m = under[i] / d[i]
            d[i + 1] -= m * e[i]
            x[i + 1] -= m * x[i]
        else:
            m = d[i] / under[i]
            d[i], e[i], d[i + 1], f[i] = under[i], d[i + 1], e[i] - m * d[i + 1], e[i + 1]
            e[i + 1] *= -m
            x[i], x[i + 1] = x[i + 1], x[i] - m * x[i + 1]
    for i in range(n - 1, -1, -1):
        if abs(d[i]) < least:
            d[i] = least
        rest = x[i] - (e[i] * x[i + 1] if i + 1 < n else 0.0) - (f[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = rest / d[i]
    return x


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the k largest eigenvalues of a symmetric matrix."""
    n = len(matrix)
    scale = np.abs(matrix).max(initial=0.0)
    if not n or not scale:
        return np.zeros(0), np.zeros((0, n))
    k = min(k, n)
    diagonal, below, reflections = householder(matrix / scale)
    values = leading_eigenvalues(diagonal, below, k)
    random = np.random.default_rng(0)
    vectors: list[np.ndarray] = []
    first = 0
    for i, value in enumerate(values):
        # Eigenvalues within a thousandth of the matrix's size of their neighbour are one cluster.
        if i and values[i - 1] - value > 1e-3 * values[0]:
            first = i
        x = random.standard_normal(n)
        for _ in range(5):
            for _ in range(2):
                for other in vectors[first:]:
                    x = x - (other @ x) * other
            x /= np.sqrt(x @ x)
            x = solve_shifted(diagonal, below, value, x)
            x /= np.abs(x).max()
        for _ in range(2):
            for other in vectors[first:]:
                x = x - (other @ x) * other
        vectors.append(x / np.sqrt(x @ x))
    out = np.array(vectors)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        out[:, i + 1 :] -= 2 * np.outer(out[:, i + 1 :] @ v, v)
    return values * scale, out


def _matrix(column: pa.Array, d: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, d)


def _partial_products(mean: np.ndarray):
    """(row, values): this task's share of each row of the sum of centred products."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((len(mean), len(mean))), False
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.column("x").slice(low, BLOCK_ROWS), len(mean), np.float64) - mean
                total += x.T @ x
                some = True
        if some:
            rows = [pa.array(range(len(mean)), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())]
            yield pa.RecordBatch.from_arrays(rows, ["row", "values"])

    return scan


def _added_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the same number added up; they come sorted by number."""
    row, total = None, None
    for batch in batches:
        done = []
        for i, values in zip(batch.column("row").to_pylist(), batch.column("values").to_pylist(), strict=True):
            if i != row:
                if row is not None:
                    done.append((row, total.tobytes()))
                row, total = i, np.zeros(len(values) // 8)
            total = total + np.frombuffer(values, np.float64)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int32()), pa.array([x[1] for x in done], pa.binary())], ["row", "values"])
    if row is not None:
        yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["row", "values"])


def _projected(n: int, sums: list[int], projection: np.ndarray):
    """(vec_id, deviation, deviation_exact, whitened list) of each vector."""
    mean = np.array([s / n for s in sums])
    # x - S/n = (x - whole) - part, both exact enough: the integer part of the mean is taken off as an integer.
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])
    rest = [s % n for s in sums]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for low in range(0, whole_batch.num_rows, BLOCK_ROWS):
                batch = whole_batch.slice(low, BLOCK_ROWS)
                x = _matrix(batch.column("x"), len(mean), np.int64) - whole
                white = ((x - part) @ projection.T)
                # (n x - S)^2 = (n (x - whole) - rest)^2, in 64 bits where it surely fits
                if n * (float(np.abs(x).max(initial=0)) + 1) < 2**31 / len(mean) ** 0.5:
                    exact = ((n * x - np.array(rest, np.int64)) ** 2).sum(1).tolist()
                else:
                    exact = [sum((n * a - b) ** 2 for a, b in zip(v, rest, strict=True)) for v in x.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"), pa.array([e if e < 2**63 else None for e in exact], pa.int64()),
                        pa.array([str(e) for e in exact], pa.string()),
                        pa.ListArray.from_arrays(np.arange(0, white.size + 1, white.shape[1], dtype=np.int32), white.ravel()),
                    ],
                    ["vec_id", "deviation", "deviation_exact", "whitened"],
                )

    return scan


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[int, list[int], np.ndarray, np.ndarray, float]:
    """(rows, sums per dimension, eigenvalues, components as rows, trace) of integer vectors ``x`` of one length.

    Comes to the driver: one sum per dimension and the covariance, d x d numbers.
    """
    sums = vectors.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n")).orderBy("i").collect()
    if not sums:
        return 0, [], np.zeros(0), np.zeros((0, 0)), 0.0
    n, total = sums[0].n, [int(r.s) for r in sums]
    parts = map_arrow(vectors.select("x"), _partial_products(np.array([s / n for s in total])), "row int, values binary")
    added = map_arrow(parts.repartition("row").sortWithinPartitions("row"), _added_rows, "row int, values binary")
    covariance = np.zeros((len(total), len(total)))
    for r in added.collect():
        covariance[r.row] = np.frombuffer(r["values"], np.float64)
    covariance = (covariance + covariance.T) / 2 / n
    values, vectors_ = leading_components(covariance, components)
    keep = values > RANK * max(values.max(initial=0.0), 0.0)
    return n, total, values[keep], vectors_[keep], float(np.trace(covariance))


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    good = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where(
        "size(v) > 0 AND NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) = double('infinity'))"
    )
    lengths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.where(F.size("v") == (lengths.d if lengths else 0)).select(
        "vec_id", F.expr(f"transform(v, c -> greatest(least(floor(1024 * c), {LARGEST}L), -{LARGEST}L) + 100000)").alias("x")
    )


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact, eigenvalue."""
    vectors = integer_vectors(rows, id_col, vector_col)
    n, sums, values, axes, trace = fit(vectors, components)
    k = len(values)
    kind = "vec_id long, deviation long, deviation_exact string, whitened array<double>"
    if not k:
        table, error = rows.sparkSession.createDataFrame([], kind), 0.0
    else:
        table = staged(map_arrow(vectors, _projected(n, sums, axes / np.sqrt(values)[:, None]), kind), "whitened")
        w = [F.col("whitened")[i] for i in range(k)]
        mean = table.agg(*[F.sum(x) / F.lit(n) for x in w]).first()
        centred = [x - F.lit(m) for x, m in zip(w, mean, strict=True)]
        upper = [(i, j) for i in range(k) for j in range(i, k)]
        second = table.agg(*[F.sum(centred[i] * centred[j]) / F.lit(n) for i, j in upper]).first()
        error = max(abs(s - (i == j)) for s, (i, j) in zip(second, upper, strict=True))
    per = F.array(*[F.struct(F.lit(float(e)).alias("eigenvalue"), F.lit(float(e) / trace).alias("explained")) for e in values]) if k else F.array(
        F.struct(F.lit(0.0).alias("eigenvalue"), F.lit(0.0).alias("explained"))
    )
    each = table.select("vec_id", "deviation", "deviation_exact", F.posexplode("whitened").alias("i", "whitened"), per.alias("per"))
    return each.select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.col("per")[F.col("i")]["explained"].alias("explained"), F.lit(float(error)).alias("identity_error"),
        F.col("deviation_exact").try_cast("decimal(38,0)").alias("deviation_exact"), F.col("per")[F.col("i")]["eigenvalue"].alias("eigenvalue"),
    )


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))
