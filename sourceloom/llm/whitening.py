"""Embedding whitening by spectral divide-and-conquer on the covariance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sourceloom.llm.common import ship, store

#: An entry c becomes the integer floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries beyond this size do not fit the integer arithmetic; their rows are left out.
MOST = float(1 << 38)
#: Vectors that a task holds as doubles at once.
ROWS = 4096
_EPS = float(np.finfo(float).eps)


def _vectors(batches: Iterator[pa.RecordBatch], dims: int | None = None) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """Usable rows of one length at a time: their numbers in the batch, ``vec_id``, and integer vectors."""
    for batch in batches:
        vectors = batch.column("_vector")
        ids = batch.column("vec_id")
        for a in range(0, len(vectors), ROWS):
            part = vectors.slice(a, ROWS)
            size = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = part.flatten()
            value = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            start = np.cumsum(size) - size
            for n in np.unique(size[size > 0]) if dims is None else [dims]:
                rows = np.flatnonzero(size == n)
                wide = value[start[rows][:, None] + np.arange(n)]
                fine = (np.abs(wide) < MOST).all(1)  # false for NaN as well
                if fine.any():
                    rows = rows[fine]
                    yield rows + a, ids.take(pa.array(rows + a)), np.floor(wide[fine] * SCALE).astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and entry sums of a task by length of vector; slot -1 holds the count."""
    total: dict[int, list[int]] = {}
    for _, _, x in _vectors(batches):
        held = total.setdefault(x.shape[1], [0] * (x.shape[1] + 1))
        for i, s in enumerate([len(x), *x.sum(0).tolist()]):
            held[i] += s
    for dims, sums in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([dims] * len(sums), pa.int32()), pa.array(range(-1, dims), pa.int32()),
                                          pa.array(sums, pa.decimal128(38, 0))], names=["dims", "slot", "total"])


def _products(batches: Iterator[pa.RecordBatch], spec) -> Iterator[pa.RecordBatch]:
    """A task's sum of products of the centred, projected vectors: one row for each row of the matrix."""
    mean, project = spec.value
    total = None
    for _, _, x in _vectors(batches, len(mean)):
        y = x - mean
        if project is not None:
            y = y @ project
        total = y.T @ y if total is None else total + y.T @ y
    if total is not None:
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "value"])


def _whitened(batches: Iterator[pa.RecordBatch], spec) -> Iterator[pa.RecordBatch]:
    n, sums, mean, project = spec.value
    k = project.shape[1]
    # n*x - S = n*(x - base) - rest, with a base near the mean, so that the numbers stay small.
    base = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    for _, ids, x in _vectors(batches, len(mean)):
        z = x - base
        if n * (int(np.abs(z).max()) + 1) < 1 << 62 and len(sums) * (n * (int(np.abs(z).max()) + 1)) ** 2 < 1 << 63:
            deviation = pa.array(((n * z - np.array(rest, np.int64)) ** 2).sum(1))
        else:
            exact = [sum((n * v - r) ** 2 for v, r in zip(row, rest)) for row in z.tolist()]
            deviation = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
        rows = np.repeat(np.arange(len(x)), k)
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), deviation.take(pa.array(rows)),
             pa.array(((x - mean) @ project).ravel())], names=["vec_id", "component", "deviation", "whitened"])


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps (QDWH).

    A step is a QR factorisation of the weighted matrix over the identity, or one by Cholesky once the weights are mild.
    Directions of eigenvalue zero stay zero.
    """
    size = len(a)
    x = a / np.linalg.norm(a)
    low, eye = _EPS, np.eye(size)
    for _ in range(30):
        before = x
        d = (4 * max(1 - low * low, 0.0) / low ** 4) ** (1 / 3)
        root = np.sqrt(1 + d)
        h = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * root), 0.0))
        g = (h - 1) ** 2 / 4
        c = h + g - 1
        if c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
            x = g / c * x + (h - g / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        else:
            half = np.linalg.cholesky(eye + c * x.T @ x)
            x = g / c * x + (h - g / c) * np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
        x = (x + x.T) / 2
        low = min(low * (h + g * low * low) / (1 + c * low * low), 1.0)
        if 1 - low < 10 * _EPS and np.linalg.norm(x - before) < 1e-10 * np.sqrt(size):
            break
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift, or None if all eigenvalues are equal to precision."""
    size, middle = len(a), np.trace(a) / len(a)
    spread = np.linalg.norm(a - middle * np.eye(size))
    best = None
    # The mean lies strictly between unequal eigenvalues; the steps beside it are for one that meets an eigenvalue.
    for shift in (float(np.median(np.diag(a))), middle, middle + 0.01 * spread / size, middle - 0.013 * spread / size, middle + 0.1 * spread / size):
        b = a - shift * np.eye(size)
        if np.linalg.norm(b) == 0:
            continue
        projector = (polar_factor(b) + np.eye(size)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < size or np.linalg.norm(projector @ projector - projector) > 1e-8 * size:
            continue
        # Subspace iteration from the longest columns; a second step makes the bases orthogonal to precision.
        order = np.argsort(-np.linalg.norm(projector, axis=0), kind="stable")[:k]
        first = np.linalg.qr(projector @ np.linalg.qr(projector[:, order])[0])[0]
        rest = np.eye(size) - first @ first.T
        order = np.argsort(-np.linalg.norm(rest, axis=0), kind="stable")[:size - k]
        second = np.linalg.qr(rest[:, order])[0]
        second = np.linalg.qr(second - first @ (first.T @ second))[0]
        left = np.linalg.norm(first.T @ a @ second) / np.linalg.norm(a)
        if best is None or left < best[0]:
            best = left, first, second
        if left <= 4 * size * _EPS:
            break
    return None if best is None or best[0] > 1e-9 else best[1:]


def leading_components(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, and unit eigenvectors as columns, of a symmetric positive matrix.

    Polar decompositions of the shifted matrix give projectors on the invariant subspaces above and below the shift; each subspace is
    split again until it holds one direction, or several of one eigenvalue.  Subspaces beyond the first ``most`` directions are not split.
    """
    values: list[float] = []
    vectors: list[np.ndarray] = []
    size = max(np.linalg.norm(a), np.finfo(float).tiny)
    open_ = [(a / size, np.eye(len(a)))]
    while open_ and len(values) < most:
        part, basis = open_.pop()
        middle = np.trace(part) / len(part)
        equal = np.linalg.norm(part - middle * np.eye(len(part))) <= 4 * _EPS * len(a)
        halves = None if len(part) == 1 or equal else _split(part)
        if halves is None:
            # Directions of equal eigenvalues: any basis of them will do.
            vectors += list(basis.T)
            values += [float(v @ a @ v) for v in basis.T]
            continue
        for half in reversed(halves):
            inner = half.T @ part @ half
            open_.append(((inner + inner.T) / 2, basis @ half))
    values, found = np.array(values), np.array(vectors).T
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], found[:, order]


def _matrix(base: DataFrame, spec, size: int) -> np.ndarray:
    parts = base.mapInArrow(partial(_products, spec=spec), "i int, j int, value double")
    out = np.zeros((size, size))
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("value")).collect():  # one row per entry of a matrix
        out[i, j] = out[j, i] = value
    return out


def whiten(vectors: DataFrame, components: int = 8, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: one row for each vector and leading component.

    Entries are made integers, so counts and sums are exact.  Three passes over the vectors: counts and sums; products of the centred
    vectors, summed across partitions; and the projection with broadcast components.  A fourth takes the covariance of the
    whitened values for ``identity_error``.  Only sums of a vector's length, squared at most, reach the driver, which splits the covariance.

    Rows with a null vector, a null or non-finite entry, or an entry of 2**38 or more are left out; so are vectors whose length is not the
    most frequent one (of equals the longest), and empty ones.  Components whose share of the trace is below about 1e-10 (rounding error) are
    left out, so equal vectors alone give no rows.  Fewer dimensions than components give as many as there are.  Repeated rows and ids count
    each; null ids stay.  ``deviation`` is null where it exceeds 64 bits.  Equal eigenvalues have any basis of their directions.
    """
    spark = vectors.sparkSession
    ship(spark)
    base = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("_vector")).where("_vector IS NOT NULL")
    totals = store(base.mapInArrow(_sums, "dims int, slot int, total decimal(38,0)").groupBy("dims", "slot").agg(F.sum("total").alias("total")), "vector-sums")
    head = totals.where("slot = -1").orderBy(F.desc("total"), F.desc("dims")).select("dims", "total").first()
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if head is None:
        return spark.createDataFrame([], schema)
    dims, n = head.dims, int(head.total)
    sums = [0] * dims
    for slot, total in totals.where((F.col("dims") == dims) & (F.col("slot") >= 0)).select("slot", "total").collect():  # one row per dimension
        sums[slot] = int(total)
    # Quotient and remainder apart: S/n is rounded once.
    mean = np.array([s // n + (s % n) / n for s in sums])
    share = lambda *x: spark.sparkContext.broadcast(x)
    covariance = _matrix(base, share(mean, None), dims) / n
    values, found = leading_components(covariance, min(components, dims))
    trace = float(np.trace(covariance))
    solid = values > max(trace, 0.0) * dims * _EPS * 1e4  # below, an eigenvalue is not known to 0.0001
    values, found = values[solid], found[:, solid]
    if not len(values):
        return spark.createDataFrame([], schema)
    project = found / np.sqrt(values)
    check = _matrix(base, share(mean, project), len(values)) / n
    error = float(np.abs(check - np.eye(len(values))).max())
    rows = base.mapInArrow(partial(_whitened, spec=share(n, sums, mean, project)), "vec_id bigint, component int, deviation bigint, whitened double")
    explained = F.element_at(F.lit([float(v / trace) for v in values]), F.col("component"))
    return rows.select("vec_id", "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", explained.alias("explained"),
                       F.lit(error).alias("identity_error"))
