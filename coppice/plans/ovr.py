"""Cross-check trainer: one-vs-rest trees of Spark's own library."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def train_ovr(df: DataFrame, rounds: int = 5, max_depth: int = 3, seed: int = 42):
    """Model of the training rows of ``features, label, split``. It has no probabilities."""
    rows = df.where("split = 'train'").select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("features").cast("array<double>")).alias("features"),
    )
    trees = GBTClassifier(maxIter=rounds, maxDepth=max_depth, seed=seed)
    return OneVsRest(classifier=trees).fit(rows)


def predict_ovr(df: DataFrame, model) -> DataFrame:
    """``row_id, label, predicted_class``."""
    rows = df.select(
        "row_id", "label", array_to_vector(F.col("features").cast("array<double>")).alias("features")
    )
    return model.transform(rows).select(
        "row_id", "label", F.col("prediction").cast("int").alias("predicted_class")
    )
