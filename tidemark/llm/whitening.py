"""Whitening of embeddings by the principal components of their integer grid.

Two passes over the distinct grid vectors: the first adds them up exactly, which
gives the mean; the second adds up outer products of centred vectors, one matrix
product for each batch. Sums of tasks are merged as a tree on the executors, so
the driver gets one matrix of dimensions x dimensions however many tasks there are.
A symmetric eigensolver gives the components, which are broadcast (``top`` vectors)
to project every row. A third pass measures the covariance of what came out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Steps of the grid in one unit.
GRID = 256
#: Part of the total variance below which a component counts as constant.
FLAT = 1e-12
_LOW = (1 << 32) - 1


def grid_vectors(rows: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """key and x (array of long: floor of ``GRID`` times each entry) of the usable rows.

    Rows without a vector, or with null or non-finite entries, drop out; so do
    rows whose vectors have another length than most (of equally many, the
    longest) and vectors without entries.
    """
    entries = F.transform(F.col(column), lambda c: c.cast("double"))
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    usable = rows.select(F.col(key).alias("vec_id"), entries.alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", odd) & (F.size("v") > 0))
    x = usable.select("vec_id", F.transform("v", lambda c: F.floor(c * GRID)).alias("x"))
    lengths = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(2).collect()
    return x.where(F.size("x") == lengths[0]["d"]) if len(lengths) > 1 else x


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _merged(vectors: DataFrame, one: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``one`` (a vector of doubles or longs) over the batches of x, by task and then as a tree; None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = one(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([total.dtype.str])], names=["sums", "kind"])

    def add(a: np.ndarray | None, b) -> np.ndarray | None:
        b = np.frombuffer(b["sums"], b["kind"]) if b is not None and not isinstance(b, np.ndarray) else b
        return b if a is None else a if b is None else a + b

    return vectors.select("x").mapInArrow(run, "sums binary, kind string").rdd.treeAggregate(None, add, add)


def exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension, in whole numbers of any size."""

    def halves(x: np.ndarray) -> np.ndarray:
        # Halves of 32 bits each, so that no sum of fewer than 2**31 rows can overflow.
        return np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & _LOW).sum(axis=0)])

    sums = _merged(vectors, halves)
    if sums is None:
        return 0, []
    high, low = np.split(sums[1:], 2)
    return int(sums[0]), [(int(h) << 32) + int(lo) for h, lo in zip(high, low)]


def covariance(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of the vectors, centred before multiplying, with divisor n."""
    mean = np.array([s / n for s in sums])

    def products(x: np.ndarray) -> np.ndarray:
        y = x - mean
        return (y.T @ y).ravel()

    out = _merged(vectors, products).reshape(len(sums), -1) / n
    return (out + out.T) / 2


def components(cov: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` largest eigenvalues and their unit vectors as columns."""
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:top]
    return values[order], vectors[:, order]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The sum over dimensions of (n*x - S)^2, exact for any size of numbers."""
    most = n * max(int(x.max()), -int(x.min())) + max(map(abs, sums))
    if most * most * x.shape[1] < 1 << 63:
        return (np.square(n * x - np.array(sums, np.int64))).sum(axis=1).tolist()
    return [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]


def whiten(rows: DataFrame, top: int = 4, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Each usable row on each of the first ``top`` components (as many as there are dimensions, at most).

    Returns vec_id, component, n, deviation, whitened, explained, identity_error.
    The fit is on each distinct grid vector once, so copies have no weight; all
    rows are projected, repeated ones and those without an id too. A component
    without variance has no unit to whiten by: ``whitened`` is null there, and
    ``explained`` 0, or null if there is no variance at all. A deviation beyond 64
    bits is an error. Without usable rows the result is empty.
    """
    spark = rows.sparkSession
    x = grid_vectors(rows, key, column)
    fit = cut(x.select("x").distinct(), "fit")
    n, sums = exact_sums(fit)
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if n == 0:
        return spark.createDataFrame([], out)
    cov = covariance(fit, n, sums)
    values, vectors = components(cov, top)
    trace = float(np.trace(cov))
    live = values > FLAT * trace
    mean = np.array([s / n for s in sums])
    scale = vectors / np.sqrt(np.where(live, values, 1.0))
    error = identity_error(fit, n, mean, scale[:, live]) if live.any() else None
    explained = [float(v) / trace if t else 0.0 if trace > 0 else None for v, t in zip(values, live)]
    shared = spark.sparkContext.broadcast((mean, scale))
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    k = len(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, onto = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held = _matrix(batch.column(1))
            z, rows_in = (held - centre) @ onto, batch.num_rows
            white = pa.array(z.ravel(), mask=~np.tile(live, rows_in))
            repeat = pa.array(np.repeat(np.arange(rows_in), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(repeat), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_in)), pa.array([n] * (rows_in * k), pa.int64()),
                    pa.array(deviations(held, n, sums), pa.int64()).take(repeat), white, pa.array(explained * rows_in, pa.float64()), pa.array([error] * (rows_in * k), pa.float64()),
                ],
                schema=schema,
            )

    return x.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(project, out)


def identity_error(fit: DataFrame, n: int, mean: np.ndarray, scale: np.ndarray) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    k = scale.shape[1]

    def moments(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ scale
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    sums = _merged(fit, moments) / n
    centre = sums[:k]
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(centre, centre) - np.eye(k)).max())
