"""Class labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shift_label(df: DataFrame, label: str = "label", by: int = 1) -> DataFrame:
    """Labels that start at ``by`` to labels that start at 0."""
    return df.withColumn(label, (F.col(label) - by).cast("int"))


def class_index(df: DataFrame, label: str = "label") -> DataFrame:
    """The distinct labels in order, numbered from 0: ``(label, class_id)``."""
    classes = df.select(label).where(F.col(label).isNotNull()).distinct()
    return classes.withColumn("class_id", (F.row_number().over(W.orderBy(label)) - 1).cast("int"))


def index_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Add the dense ``class_id`` of any kind of label."""
    return df.join(class_index(df, label), label, "left")


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def num_class(df: DataFrame, label: str = "label") -> DataFrame:
    """``max + 1`` next to the number of labels that really occur."""
    return df.agg(
        (F.max(label) + 1).alias("num_class"),
        F.count_distinct(label).alias("distinct_labels"),
        F.min(label).alias("min_label"),
    )


def require_dense_labels(df: DataFrame, label: str = "label") -> tuple[int, int]:
    """``(number of classes, rows)``; raises unless the labels are exactly 0..K-1."""
    row = df.agg(
        F.max(label).alias("top"),
        F.min(label).alias("low"),
        F.count_distinct(label).alias("k"),
        F.count("*").alias("n"),
        F.count(label).alias("labelled"),
    ).first()
    if not row.n:
        raise ValueError("no training rows")
    if row.labelled < row.n or row.low != 0 or row.top + 1 != row.k:
        raise ValueError(
            f"labels must be 0..K-1 without gaps or nulls: found {row.k} classes from {row.low} "
            f"to {row.top}, {row.n - row.labelled} rows without a label"
        )
    return row.k, row.n
