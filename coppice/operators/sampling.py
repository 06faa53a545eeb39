"""Row and feature samples of the boosting rounds."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.hashing import in_row_sample, row_hash


def sample_rows(df: DataFrame, key: str | Column, ratio: float, seed: int, round_no: int) -> DataFrame:
    """Rows that boosting round ``round_no`` trains on."""
    return df.where(in_row_sample(row_hash(key), ratio, seed, round_no))


def sample_size(n_features: int, ratio: float) -> int:
    return max(1, math.floor(round(ratio * n_features, 9)))


def sample_features(n_features: int, ratio: float, seed: int, round_no: int, class_id: int) -> list[int]:
    """Features one tree may use. Feature lists live on the driver, so this does too."""
    def rank(f: int) -> str:
        return hashlib.md5(f"{seed}:{round_no}:{class_id}:{f}".encode()).hexdigest()

    return sorted(sorted(range(n_features), key=rank)[: sample_size(n_features, ratio)])


def sample_tree_features(trees: DataFrame, n_features: int, ratio: float, seed: int) -> DataFrame:
    """The same choice for a table of trees ``(round, class_id)``: one row per kept feature."""
    pairs = trees.select(
        "round", "class_id", F.explode(F.sequence(F.lit(0), F.lit(n_features - 1))).alias("feature")
    )
    rank = F.md5(F.concat_ws(":", F.lit(seed), "round", "class_id", "feature"))
    place = F.row_number().over(W.partitionBy("round", "class_id").orderBy("_rank"))
    return (
        pairs.withColumn("_rank", rank)
        .withColumn("_place", place)
        .where(F.col("_place") <= sample_size(n_features, ratio))
        .select("round", "class_id", "feature")
    )
