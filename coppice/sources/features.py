"""Reading and staging of feature tables.

A feature table has one ``row_id``, one ``features`` array of floats and, where it is
known, one integer ``label``. Rows have no position in Spark, so the key is required.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def feature_array(cols: Sequence[str | Column], lenient: bool = False) -> Column:
    """Float array of the given columns. A text that is no number raises, or becomes
    NULL where ``lenient`` is set."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    cast = (lambda c: c.try_cast("float")) if lenient else (lambda c: c.cast("float"))
    return F.array(*[cast(c) for c in parts])


def composite_key(*cols: Column | str) -> Column:
    return F.concat_ws(":", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


def as_features(
    df: DataFrame,
    feature_cols: Sequence[str | Column],
    key: str | Column,
    label: str | Column | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Wide table to ``row_id, features[, label]``; only the named columns are read."""
    out = [
        (F.col(key) if isinstance(key, str) else key).alias("row_id"),
        feature_array(feature_cols, lenient).alias("features"),
    ]
    if label is not None:
        out.append((F.col(label) if isinstance(label, str) else label).cast("int").alias("label"))
    return df.select(*out)


def load_features(
    spark: SparkSession,
    path: str,
    feature_cols: Sequence[str | Column],
    key: str | Column,
    label: str | Column | None = None,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Scan a parquet, ORC, CSV or JSON table into the feature form. Text formats
    need ``schema``: nothing is inferred by an extra pass."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt in ("csv", "json"):
        raise ValueError(f"{fmt} input needs an explicit schema")
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return as_features(reader.load(path), feature_cols, key, label, lenient)


def stage_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the table to a governed place and return it read from there."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def require_unique_keys(df: DataFrame, *key: str) -> DataFrame:
    """The table itself; raises when a key repeats."""
    repeated = duplicate_keys(df, *key).limit(3).collect()
    if repeated:
        raise ValueError(f"row keys repeat, for example {[tuple(r) for r in repeated]}")
    return df


def preview(df: DataFrame, n_features: int, n: int = 5, last: bool = False) -> DataFrame:
    """The first (or last) ``n`` rows by key as ``label, f0, f1, ...``."""
    order = F.col("row_id").desc() if last else F.col("row_id").asc()
    cols = [F.get("features", F.lit(i)).alias(f"f{i}") for i in range(n_features)]
    label = [F.col("label")] if "label" in df.columns else []
    return df.orderBy(order).limit(n).select("row_id", *label, *cols)


def head_rows(df: DataFrame, n: int, last: bool = False) -> DataFrame:
    """The first (or last) ``n`` rows by key."""
    return df.orderBy(F.col("row_id").desc() if last else F.col("row_id").asc()).limit(n)


def misfit(n_features: int | Column) -> Column:
    """Why a row does not fit a model with so many features; NULL where it does."""
    wanted = n_features if isinstance(n_features, Column) else F.lit(n_features)
    return (
        F.when(F.col("features").isNull(), F.lit("no features"))
        .when(
            F.size("features") != wanted,
            F.concat(F.lit("expected "), wanted, F.lit(" features, got "), F.size("features")),
        )
    )


def split_by_width(df: DataFrame, n_features: int | Column) -> tuple[DataFrame, DataFrame]:
    """Rows that have the model's feature count, and the others with a reason."""
    marked = df.withColumn("reason", misfit(n_features))
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def fitting_rows(df: DataFrame, n_features: int | Column) -> tuple[DataFrame, Observation]:
    """Rows that have the model's feature count; the others are counted as ``refused`` by the action that
    reads them, so that one without any needs no second look at the table."""
    seen = Observation()
    marked = df.withColumn("reason", misfit(n_features)).observe(seen, F.count("reason").alias("refused"))
    return marked.where("reason IS NULL").drop("reason"), seen
