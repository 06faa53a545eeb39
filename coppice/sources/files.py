"""Prediction files, per-shard search results and namespaces."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.proba import argmax, confidence

SHARD_RESULT = "version INT, auc DOUBLE, trial_start INT"


def predictions(scored: DataFrame) -> DataFrame:
    """``row_id, predicted_class, predicted_probability`` and, where labels are known,
    ``true_label``."""
    out = [
        F.col("row_id"),
        argmax("proba").alias("predicted_class"),
        confidence("proba").alias("predicted_probability"),
    ]
    if "label" in scored.columns:
        out.append(F.col("label").alias("true_label"))
    return scored.select(*out)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> int:
    """Overwrite ``path`` and return how many rows were written, counted by the same job."""
    seen = Observation()
    writer = df.observe(seen, F.count("*").alias("rows")).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return seen.get["rows"]


def read_predictions(spark: SparkSession, path: str, schema, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def write_shard_results(df: DataFrame, path: str) -> None:
    """Append the results of search shards. They are kept apart by ``search_id``, so a
    later search never reads or removes the files of an earlier one."""
    df.write.mode("append").partitionBy("search_id").json(path)


def read_shard_results(spark: SparkSession, path: str, search_id: str | None = None) -> DataFrame:
    """Results of one search (one partition is listed) or of all."""
    df = spark.read.schema(f"{SHARD_RESULT}, search_id STRING").json(path)
    return df if search_id is None else df.where(F.col("search_id") == search_id)


# SQL state of a missing privilege.
_NOT_ALLOWED = "42501"


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """Make sure that the catalog has the schema ``name``."""
    if spark.catalog.databaseExists(name):
        return
    try:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    except PySparkException as refused:
        if refused.getSqlState() != _NOT_ALLOWED:
            raise
        raise PermissionError(f"{name} does not exist and may not be created by this user") from refused
