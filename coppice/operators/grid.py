"""Trials of a random hyper-parameter search and their results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hex_to_bigint

# The search space, with the types of its parameters.
SPACE = {
    "max_depth": ("int", [4, 6, 8, 10, 12]),
    "learning_rate": ("double", [0.02, 0.05, 0.1, 0.2, 0.3]),
    "subsample": ("double", [0.6, 0.7, 0.8, 0.9, 1.0]),
    "colsample_bytree": ("double", [0.6, 0.7, 0.8, 0.9, 1.0]),
    "min_child_weight": ("int", [1, 3, 5, 7]),
    "reg_lambda": ("double", [0.5, 1.0, 2.0, 5.0]),
}


def _choice(seed: int, name: str, kind: str, values: list) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("trial"), F.lit(name)))
    place = (hex_to_bigint(digest, 1, 8) % len(values)).cast("int")
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), place).alias(name)


def sample_trials(trials: DataFrame, seed: int = 42, space: dict = SPACE) -> DataFrame:
    """Parameters of every ``trial``. A trial's parameters depend on its number and the
    seed alone, so shards are slices of one grid whatever their size."""
    return trials.select(
        "trial", *[_choice(seed, name, kind, values) for name, (kind, values) in space.items()]
    )


def trial_shard(grid: DataFrame, start: int, count: int) -> DataFrame:
    """The slice ``[start, start + count)`` of the grid."""
    return grid.where((F.col("trial") >= start) & (F.col("trial") < start + count))


def assign_shards(grid: DataFrame, total: int, workers: int) -> DataFrame:
    """Contiguous shards of ``ceil(total / workers)`` trials; the last may be shorter and
    there may be fewer shards than workers."""
    per = max(1, -(-total // workers))
    return grid.withColumn("shard", F.floor(F.col("trial") / per).cast("int"))


def shard_plan(trials: DataFrame, workers: int) -> DataFrame:
    """``(shard, trial_start, trial_count)`` of the trials given, numbered from 0."""
    shards = assign_shards(trials, trials.count(), workers)
    return shards.groupBy("shard").agg(
        F.min("trial").alias("trial_start"), F.count("*").alias("trial_count")
    )


def best_of_shard(results: DataFrame, *by: str) -> DataFrame:
    """Best successful trial by AUC; a tie goes to the lowest trial."""
    ok = results.where("status = 'OK'")
    best = F.max(F.struct("auc", (-F.col("trial")).alias("t"), "trial", "accuracy"))
    return ok.groupBy(*by).agg(best.alias("b")).select(*by, "b.trial", "b.auc", "b.accuracy")


def search_summary(results: DataFrame) -> DataFrame:
    """Best AUC, the accuracy of that trial, and how many trials succeeded, per search."""
    ok = F.col("status") == "OK"
    best = F.max(F.when(ok, F.struct("auc", (-F.col("trial")).alias("t"), "accuracy")))
    return results.groupBy("search_id").agg(
        F.count("*").alias("trials"),
        F.count_if(ok).alias("succeeded"),
        F.sum("train_seconds").alias("train_seconds"),
        best.alias("b"),
    ).select("search_id", "trials", "succeeded", "train_seconds",
             F.col("b.auc").alias("best_auc"), F.col("b.accuracy").alias("best_accuracy"))


def trial_success(results: DataFrame) -> DataFrame:
    """Trials per search and status."""
    return results.groupBy("search_id", "status").agg(F.count("*").alias("n"))


def global_best(shard_results: DataFrame, *by: str) -> DataFrame:
    """Largest ``(auc, version)``: the AUC decides, then the higher version."""
    return shard_results.groupBy(*by).agg(
        F.max(F.struct("auc", "version")).alias("b"), F.count("*").alias("shards")
    ).select(*by, "b.auc", "b.version", "shards")
