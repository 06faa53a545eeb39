"""Quantile bins.

``quantile_edges`` takes exact order statistics of the training rows as edges, all features in the
same two scans (:mod:`.quantiles`). Bins: 0 is a missing value, bin ``b`` holds
``upper[b-1] <= v < upper[b]``. A split at bin ``b`` sends ``v < upper[b]`` to the left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .quantiles import LIMIT, order_statistics

EDGE_SCHEMA = "feature INT, bin INT, upper DOUBLE"


def list_columns(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
    """The entries of the batch's one list column by place; shorter lists lack the last ones."""
    lists = batch.column(0)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if len(sizes) and (sizes == sizes[0]).all():
        yield list(flat.reshape(len(sizes), -1).T)
        return
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    yield [flat[place == i] for i in range(sizes.max(initial=0))]


def edge_ranks(max_bins: int) -> Callable[[int], list[int]]:
    """Ranks of the edges among ``n`` values: ``ceil(j * n / max_bins)``."""
    return lambda n: sorted({-(-j * n // max_bins) for j in range(1, max_bins)} - {0})


def edge_lists(found: dict[int, dict[int, float]], lowest: dict[int, float], n_features: int) -> list[list[float]]:
    """Ascending edges of each feature: equal ones once, none at the least value."""
    return [sorted({v for v in found.get(f, {}).values() if v > lowest[f]}) for f in range(n_features)]


def edge_table(spark: SparkSession, cuts: list[list[float]]) -> DataFrame:
    rows = [(f, b, v) for f, c in enumerate(cuts) for b, v in enumerate(c, 1)]
    return spark.createDataFrame(rows, EDGE_SCHEMA)


def quantile_edges(
    df: DataFrame, max_bins: int = 64, features: str = "features", tolerance: float = 0.0, limit: int = LIMIT
) -> DataFrame:
    """Edge table ``(feature, bin, upper)`` of the rows given (the training rows).

    Edge ``j`` is the value of rank ``ceil(j * n / max_bins)``; equal edges and edges at
    the minimum are dropped, so a 0/1 feature gets two bins. Edges are exact, so they keep to any
    ``tolerance``. ``df`` is read twice: a costly input should be stored first."""
    lists = df.where(F.col(features).isNotNull()).select(F.col(features).cast("array<double>").alias("features"))
    found, lowest = order_statistics(lists, list_columns, edge_ranks(max_bins), limit)
    return edge_table(df.sparkSession, edge_lists(found, lowest, max(found, default=-1) + 1))


def edges_by_feature(edges: DataFrame, n_features: int) -> list[list[float]]:
    """The edge table as one ascending list per feature (at most ``max_bins`` entries each)."""
    lists = [[] for _ in range(n_features)]
    for r in edges.orderBy("feature", "bin").collect():
        lists[r.feature].append(r.upper)
    return lists


def bin_features(
    df: DataFrame, cuts: list[list[float]], features: str = "features", output: str = "bins"
) -> DataFrame:
    """Add the bin numbers of all features, for any split, by the training edges."""
    names = [f"_f{i}" for i in range(len(cuts))]
    wide = df.select(
        "*",
        *[F.get(F.col(features), F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)],
    )
    cutting = [i for i, c in enumerate(cuts) if c]
    if cutting:
        wide = Bucketizer(
            splitsArray=[[-float("inf"), *cuts[i], float("inf")] for i in cutting],
            inputCols=[names[i] for i in cutting],
            outputCols=[f"_b{i}" for i in cutting],
            handleInvalid="keep",
        ).transform(wide)
    kind = "tinyint" if max(len(c) for c in cuts) + 1 <= 127 else "smallint"
    bins = []
    for i, c in enumerate(cuts):
        missing = F.col(names[i]).isNull() | F.isnan(names[i])
        place = F.col(f"_b{i}") + 1 if c else F.lit(1)
        bins.append(F.when(missing, 0).otherwise(place).cast(kind))
    return wide.select(*df.columns, F.array(*bins).alias(output))
