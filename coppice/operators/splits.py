"""Split gains, best splits and leaf values from histogram cells.

Everything here works on aggregated cells; no window ever holds rows of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GROUP = "tree, node, feature"


def _per_tree(values: float | Sequence[float]) -> str:
    """SQL of a parameter: one number for all trees, or one per tree number."""
    if isinstance(values, (int, float)):
        return f"{float(values)!r}D"
    text = ",".join(repr(float(v)) for v in values)
    return f"get(CAST(split('{text}', ',') AS ARRAY<DOUBLE>), tree)"


def split_gain(
    cells: DataFrame,
    scale: float = 1.0,
    reg_lambda: float | Sequence[float] = 1.0,
    min_child_weight: float | Sequence[float] = 1.0,
) -> DataFrame:
    """All admissible splits with their gain.

    A split at ``bin`` sends lower bins to the left. Rows without a value (bin 0) are
    tried on both sides where there are any; ``missing_left`` says on which.
    """
    lam, weight = _per_tree(reg_lambda), _per_tree(min_child_weight)
    upto = f"OVER (PARTITION BY {_GROUP} ORDER BY bin ROWS UNBOUNDED PRECEDING)"
    group = f"OVER (PARTITION BY {_GROUP})"
    sums = cells.selectExpr(
        "tree", "node", "feature", "bin",
        f"sum(g) {upto} / {scale!r}D AS g_upto",
        f"sum(h) {upto} / {scale!r}D AS h_upto",
        f"sum(g) {group} / {scale!r}D AS g_all",
        f"sum(h) {group} / {scale!r}D AS h_all",
        f"sum(IF(bin = 0, g, 0)) {group} / {scale!r}D AS g_miss",
        f"sum(IF(bin = 0, h, 0)) {group} / {scale!r}D AS h_miss",
    )
    left = "named_struct('missing_left', true, 'g_left', g_upto, 'h_left', h_upto)"
    right = "named_struct('missing_left', false, 'g_left', g_upto - g_miss, 'h_left', h_upto - h_miss)"
    splits = sums.selectExpr(
        "tree", "node", "feature", "bin", "g_all", "h_all",
        f"inline(IF(h_miss > 0, array({left}, {right}), array({left})))",
    ).selectExpr("*", "g_all - g_left AS g_right", "h_all - h_left AS h_right")

    def score(g: str, h: str) -> str:
        # A side without weight is excluded below; this keeps the division defined.
        return f"{g} * {g} / IF({h} + {lam} > 0, {h} + {lam}, 1D)"

    gain = f"({score('g_left', 'h_left')} + {score('g_right', 'h_right')} - {score('g_all', 'h_all')}) * 0.5D"
    return splits.selectExpr("*", f"{gain} AS gain").where(
        f"h_left > 0 AND h_right > 0 AND h_left >= {weight} AND h_right >= {weight} AND gain > 0"
    )


def best_split(gains: DataFrame) -> DataFrame:
    """Best split of each node; equal gains go to the lowest feature, then the lowest bin,
    then missing values to the left."""
    order = (
        "max(struct(gain, -feature AS f, -bin AS b, missing_left, feature, bin, "
        "g_left, h_left, g_right, h_right)) AS s"
    )
    return gains.groupBy("tree", "node").agg(F.expr(order)).selectExpr(
        "tree", "node", "s.feature", "s.bin", "s.missing_left", "s.gain",
        "s.g_left", "s.h_left", "s.g_right", "s.h_right",
    )


def node_totals(cells: DataFrame, scale: float = 1.0) -> DataFrame:
    """Sums of one node, read from any one of its features."""
    any_feature = cells.groupBy("tree", "node", "feature").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h")
    )
    return any_feature.groupBy("tree", "node").agg(
        (F.min_by("g", "feature") / scale).alias("g"), (F.min_by("h", "feature") / scale).alias("h")
    )


def leaf_value(g: Column, h: Column, learning_rate, reg_lambda) -> Column:
    """``-eta * G / (H + lambda)``; 0 where the denominator is 0."""
    below = h + reg_lambda
    return F.when(below > 0, -g * learning_rate / F.when(below > 0, below)).otherwise(0.0)


def leaf_values(
    cells: DataFrame,
    scale: float = 1.0,
    learning_rate: float | Sequence[float] = 0.1,
    reg_lambda: float | Sequence[float] = 1.0,
) -> DataFrame:
    """Value of every node if it were a leaf, with its cover."""
    value = leaf_value(F.col("g"), F.col("h"), F.expr(_per_tree(learning_rate)), F.expr(_per_tree(reg_lambda)))
    return node_totals(cells, scale).select(
        "tree", "node", value.alias("leaf_value"), F.col("h").alias("cover")
    )
