"""Whitening of embeddings on the leading components of their covariance (operator 12).

Entries are scaled to integers. Each distinct vector counts once: their number, sums (exact) and centred
covariance come from partial sums of tasks, and only these, of the square of the dimension, reach
the driver. There :mod:`.qdwh` finds the components, and the matrix of ``dimension x components`` goes
back to the tasks, which whiten all rows. A vector that stands for a third of all rows is one vector
after the partial aggregation of each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove, written
from .common import small_batches
from .qdwh import EPS, leading_eigenvectors

SCALE = 256
COMPONENTS = 4
_LIMB = 31
_LONG = 1 << 63


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """Entries as ``floor(scale * entry)``; beyond the range of a long, its ends."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """Whether a vector is there and has only finite entries (at least one)."""
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, lambda c: F.coalesce(odd(c.cast("double")), F.lit(True))), F.lit(False))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    column = batch.column(batch.schema.names.index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dim)


def _summed(fit: DataFrame, partial, dim: int) -> list[float | int]:
    """Sums over the tasks of the vectors that ``partial`` makes of each batch of rows."""

    def task(batches: Iterator[pa.RecordBatch]):
        total = None
        for b in batches:
            if b.num_rows:
                p = partial(_matrix(b, dim))
                total = p if total is None else [x + y for x, y in zip(total, p, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_pydict(
                {"longs": pa.array([total[0].tolist()], pa.list_(pa.int64())), "doubles": pa.array([total[1].tolist()], pa.list_(pa.float64()))}
            )

    parts, path = written(fit.mapInArrow(task, "longs array<long>, doubles array<double>"), "partial")
    one = parts.select(F.posexplode("longs").alias("pos", "v")).groupBy("pos").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    two = parts.select(F.posexplode("doubles").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("v"))
    out = [int(r.v) for r in one.orderBy("pos").collect()], np.array([r.v for r in two.orderBy("pos").collect()])
    remove(fit.sparkSession, path)
    return out


_NO_LONGS, _NO_DOUBLES = np.zeros(0, np.int64), np.zeros(0)


def _exact_sums(fit: DataFrame, dim: int) -> tuple[int, list[int], int]:
    """Number of vectors, exact sums of their entries, and the bits of the largest entry."""

    def partial(x):
        widest = int(max(-int(x.min()), int(x.max()))).bit_length()
        # Sums of upper and lower halves cannot overflow below 2^31 rows of a task.
        return [np.concatenate([[len(x)], (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), np.eye(65, dtype=np.int64)[widest]]), _NO_DOUBLES]

    (n, *rest), _ = _summed(fit, partial, dim)
    return n, [(h << 32) + low for h, low in zip(rest[:dim], rest[dim : 2 * dim], strict=True)], max(np.flatnonzero(rest[2 * dim :]), default=0)


def _covariance(fit: DataFrame, dim: int, n: int, mean: np.ndarray, project: np.ndarray) -> np.ndarray:
    """Covariance of the projected vectors, centred before they are multiplied."""

    def partial(x):
        z = (x - mean) @ project
        return [_NO_LONGS, np.concatenate([z.sum(0), (z.T @ z).ravel()])]

    _, sums = _summed(fit, partial, dim)
    k = project.shape[1]
    rest = sums[:k] / n  # of the rounding of the mean
    cov = sums[k:].reshape(k, k) / n - np.outer(rest, rest)
    return (cov + cov.T) / 2


def deviations(x: np.ndarray, n: int, sums: list[int], bits: int) -> list[int | None]:
    """``sum((n * x - sums) ** 2)`` of each row, exact; None beyond the range of a long."""
    dim = x.shape[1]
    reach = n * (1 << bits) + max(map(abs, sums))
    if dim * reach * reach < _LONG:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(1).tolist()
    if dim << max(2 * bits, bits + _LIMB) < _LONG:
        squares = (x * x).sum(1).astype(object)
        mask = (1 << _LIMB) - 1
        limbs = [np.array([(s >> (_LIMB * i)) & mask for s in sums], np.int64) for i in range(2)]
        dots = sum((x @ limb).astype(object) << (_LIMB * i) for i, limb in enumerate(limbs))
        dots = dots + ((x @ np.array([s >> (2 * _LIMB) for s in sums], np.int64)).astype(object) << (2 * _LIMB))
        out = n * n * squares - 2 * n * dots + sum(s * s for s in sums)
    else:
        d = n * x.astype(object) - np.array(sums, object)
        out = (d * d).sum(1)
    return [v if v < _LONG else None for v in out]


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """For each usable row and component: ``id_col``, ``component`` (from 1, falling eigenvalues), ``n``
    (distinct vectors), ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    Rows whose vector is NULL, empty or holds NULL or non-finite entries are dropped, and so are
    vectors of another length than most rows have (of equally many, the longer). Repeated rows, NULL
    ids and repeated ids keep a row each. A component whose eigenvalue is zero to working precision
    (as all are where there is one distinct vector) has ``whitened`` and ``explained`` 0 and is left out
    of ``identity_error``. ``deviation`` is NULL beyond the range of a long. There are at most as many
    components as dimensions. Other columns are not read; an empty table gives no rows."""
    spark = vectors.sparkSession
    ok = small_batches(vectors).where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), scaled(F.col(vector_col), scale).alias("x"))
    size = ok.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    schema = f"component int, n long, deviation long, whitened double, explained double, identity_error double"
    out_type = f"id {vectors.schema[id_col].dataType.simpleString()}, {schema}"
    names = [F.col("id").alias(id_col), *[c.split()[0] for c in schema.split(", ")]]
    if size is None:
        return spark.createDataFrame([], out_type).select(*names)
    dim = size["dim"]
    ok = ok.where(F.size("x") == dim)
    fit, fit_path = written(ok.select("x").distinct(), "distinct")
    n, sums, bits = _exact_sums(fit, dim)
    mean = np.array([s / n for s in sums])
    cov = _covariance(fit, dim, n, mean, np.eye(dim))
    values, axes = leading_eigenvectors(cov, min(components, dim))
    trace = float(np.trace(cov))
    real = values > dim * EPS * max(trace, 0.0)
    project = np.where(real, axes / np.sqrt(np.where(real, values, 1.0)), 0.0)
    explained = np.where(real, values / (trace or 1.0), 0.0)
    error = 0.0
    if real.any():
        error = float(np.abs(_covariance(fit, dim, n, mean, project[:, real]) - np.eye(int(real.sum()))).max())
    remove(spark, fit_path)

    def task(batches: Iterator[pa.RecordBatch]):
        k = project.shape[1]
        for b in batches:
            rows = b.num_rows
            if not rows:
                continue
            x = _matrix(b, dim)
            ids = b.column(b.schema.names.index("id")).take(pa.array(np.repeat(np.arange(rows), k)))
            far = pa.array(deviations(x, n, sums, bits), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
            columns = [
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n)), far,
                pa.array(((x - mean) @ project).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", *[c.split()[0] for c in schema.split(", ")]])

    return ok.mapInArrow(task, out_type).select(*names)
