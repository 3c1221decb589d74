"""Embedding whitening by cyclic Jacobi on a distributed scatter matrix.

The integer vectors are summed in tasks, then centred on the whole part of their mean and multiplied out in
tasks. All of that is integer arithmetic, so the sums don't depend on the order in which tasks end, nor on
tasks that run again; what is left of the mean is taken off at the end, exactly. A task sends one matrix,
and matrices are added up in the square root of their number of tasks before the driver sees them. On the driver,
Jacobi rotations go round all off-diagonal places until none is left; they keep small eigenvalues as
accurate as large ones. The sorted and scaled eigenvectors go to the tasks.

Defined results: entries beyond REACH are held there; vectors of another length than most (of equally common
lengths the smaller) are left out, as they have no covariance with the rest; a `deviation` beyond 64 bits is null; a
component whose eigenvalue isn't above RANK of the largest has a null `whitened` and no part in
`identity_error`; without any such component, that is null; equal rows, and those that share an id, each
count; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

REACH, RANK = 1 << 53, 1e-12
#: Dimensions of which a task and the driver hold a square matrix, at most.
MAX_DIM = 1024
COMPONENTS = 8
_ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def entries(vector: Column, factor: int = 1024, offset: int = 100_000) -> Column:
    """floor(factor * c) + offset of each entry, as double."""
    scaled = lambda c: F.floor(c.cast("double") * factor)
    return F.transform(vector, lambda c: F.least(F.greatest(scaled(c), F.lit(-REACH)), F.lit(REACH)) + F.lit(offset).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and holds no null, NaN or infinite entry."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))


def jacobi(matrix: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns, of a symmetric matrix, by cyclic rotations.

    An off-diagonal entry is gone when it is nothing beside the geometric mean of its diagonal entries.
    """
    a, n = np.array(matrix, float), len(matrix)
    vectors = np.eye(n)
    for _ in range(sweeps):
        turned = False
        for p in range(n - 1):
            for q in range(p + 1, n):
                if abs(a[p, q]) <= 1e-17 * np.sqrt(abs(a[p, p] * a[q, q])) or not a[p, q]:
                    continue
                turned = True
                theta = (a[q, q] - a[p, p]) / (2 * a[p, q])
                t = (1 if theta >= 0 else -1) / (abs(theta) + np.hypot(theta, 1))
                c = 1 / np.hypot(t, 1)
                s = t * c
                shift = t * a[p, q]
                diagonal = a[p, p] - shift, a[q, q] + shift
                row_p, row_q = c * a[p] - s * a[q], s * a[p] + c * a[q]
                a[p], a[:, p], a[q], a[:, q] = row_p, row_p, row_q, row_q
                a[p, p], a[q, q] = diagonal
                a[p, q] = a[q, p] = 0.0
                vectors[:, [p, q]] = np.stack([c * vectors[:, p] - s * vectors[:, q], s * vectors[:, p] + c * vectors[:, q]], axis=1)
        if not turned:
            break
    order = np.argsort(-np.diag(a), kind="stable")
    vectors = vectors[:, order]
    # One sign for all runs: the largest entry is positive.
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(n)]) if n else np.ones(0)
    return np.diag(a)[order], vectors * sign


def _total(rows: DataFrame, of_batch: Callable[[np.ndarray], np.ndarray], dim: int, size: int) -> list[int]:
    """The sum over all rows' x of what of_batch makes of a batch: `size` whole numbers of any length, exact."""

    def packed(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([[str(int(x)) for x in total.ravel()]], pa.list_(pa.string()))], ["sums"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            if len(x):
                more = of_batch(x)
                total = more if total is None else total + more
        if total is not None:
            yield packed(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.column(0):
                more = np.array([int(x) for x in row.as_py()], object)
                total = more if total is None else total + more
        if total is not None:
            yield packed(total)

    parts = rows.select("x").mapInArrow(part, "sums array<string>")
    tasks = rows.rdd.getNumPartitions()
    some = parts.repartition(max(1, int(tasks**0.5))).mapInArrow(added, "sums array<string>").collect()
    return [sum(int(r["sums"][i]) for r in some) for i in range(size)] if some else [0] * size


def _scatter(d: np.ndarray) -> np.ndarray:
    """d' d of whole numbers, exact."""
    most = int(np.abs(d).max(initial=0))
    if most * most * len(d) < 1 << 53:
        f = d.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    if most * most * len(d) < 1 << 63:
        return (d.T @ d).astype(object)
    o = d.astype(object)
    return o.T @ o


def whiten(vectors: DataFrame, scratch: Scratch, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of vectors (vec_id, x: array of whole numbers)."""
    spark = vectors.sparkSession
    kept = scratch.table("kept", vectors.select(F.col("vec_id").cast("long"), F.col("x").cast("array<long>")))
    most = kept.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if most is None or not most["dim"]:
        return spark.createDataFrame([], f"{_ROWS}, identity_error double")
    dim, n = most["dim"], most["n"]
    if dim > MAX_DIM:
        raise ValueError(f"more than {MAX_DIM} dimensions")
    kept = kept.filter(F.size("x") == dim)
    total = _total(kept, lambda x: x.astype(object).sum(0) if np.abs(x).max() * float(len(x)) >= 2**62 else x.sum(0).astype(object), dim, dim)
    mean = [s // n for s in total]
    rest = [s - n * m for s, m in zip(total, mean, strict=True)]
    centre = np.array(mean, np.int64)
    scatter = _total(kept, lambda x: _scatter(x - centre), dim, dim * dim)
    # n * n * covariance is whole: each entry is rounded once.
    cov = np.array([[float(Fraction(n * scatter[i * dim + j] - rest[i] * rest[j], n * n)) for j in range(dim)] for i in range(dim)])
    values, directions = jacobi(cov)
    trace = float(sum(Fraction(n * scatter[i * dim + i] - rest[i] ** 2, n * n) for i in range(dim)))
    use = min(components, dim)
    there = [values[0] > 0 and values[k] > RANK * values[0] for k in range(use)]
    scaled = np.stack([directions[:, k] / np.sqrt(values[k]) if there[k] else np.full(dim, np.nan) for k in range(use)], axis=1)
    explained = [float(values[k] / trace) if trace > 0 else None for k in range(use)]
    off = np.array(rest, float) / n

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            d = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) - centre
            y = (d - off) @ scaled
            # n x - S = n (x - mean) - rest, both whole.
            if (float(np.abs(d).max(initial=0)) + 1) * n * dim**0.5 < 2**31:
                deviation = ((n * d - np.array(rest, np.int64)) ** 2).sum(1).tolist()
            else:
                deviation = [v if v < 1 << 63 else None for v in ((n * d.astype(object) - np.array(rest, object)) ** 2).sum(1)]
            m = batch.num_rows
            flat = y.ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(np.repeat(np.arange(m), use))), pa.array(np.tile(np.arange(1, use + 1, dtype=np.int32), m)), pa.array(np.full(m * use, n)),
                    pa.array([v for v in deviation for _ in range(use)], "int64"), pa.array(flat, mask=np.isnan(flat)), pa.array(explained * m, "float64"),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained"],
            )

    rows = scratch.table("whitened", kept.mapInArrow(applied, _ROWS))
    error = _identity_error(kept, centre, off, scaled[:, there], n, dim) if any(there) else None
    return rows.withColumn("identity_error", F.lit(error).cast("double"))


def _identity_error(kept: DataFrame, centre: np.ndarray, off: np.ndarray, scaled: np.ndarray, n: int, dim: int) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity, from the rows."""
    k = scaled.shape[1]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = (batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) - centre - off) @ scaled
            if len(y):
                mean = y.mean(0)
                out = [len(y)], [mean.tolist()], [((y - mean).T @ (y - mean)).ravel().tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["m", "mean", "scatter"])

    parts = kept.select("x").mapInArrow(moments, "m long, mean array<double>, scatter array<double>")
    # Parts join by their means: scatter about the mean of all = own scatter + m * (own mean - mean of all) squared.
    by = lambda c, x: F.array(*(F.sum(x(F.get(c, F.lit(i)))) for i in range(k if c == "mean" else k * k)))
    first = parts.agg(by("mean", lambda v: v * F.col("m")).alias("s")).first()
    mean = np.array(first["s"]) / n
    about = [F.get("mean", F.lit(i)) - F.lit(float(mean[i])) for i in range(k)]
    sums = [F.sum(F.get("scatter", F.lit(i * k + j)) + F.col("m") * about[i] * about[j]) for i in range(k) for j in range(k)]
    cov = np.array(parts.agg(F.array(*sums).alias("s")).first()["s"]).reshape(k, k) / n
    return float(np.abs(cov - np.eye(k)).max())
