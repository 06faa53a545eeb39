"""Scoring rows with an ensemble.

A model is packed once into flat arrays, which go to the workers as broadcast variables: a worker
loads them once and keeps them, and they do not travel with every task; a stream that stays on its
model neither reads nor sends it again. Inside a task all rows of a batch walk down a tree together,
one look-up per level. Many trees of a single split are summed up beforehand: their sum is a step
function of each feature, which takes one search in its thresholds instead of a walk for each tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.proba import with_softmax
from .blocks import lists, matrix

# Nodes of one broadcast variable (about 40 bytes each). A larger ensemble has several, which one
# expression goes through; the result does not depend on it. The driver reads so many nodes at a time.
MAX_NODES = 4_000_000
# From how many trees of at most one split on these are summed up.
STEPS_FROM = 1_000
_FIELDS = ("round", "class_id", "node_id", "is_leaf", "feature", "threshold", "missing_left", "leaf_value")


@dataclass
class Forest:
    """Trees of consecutive rounds as flat arrays; children are stored as indices."""

    root: np.ndarray
    class_id: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int


@dataclass
class Steps:
    """Sum of trees of at most one split: for some pairs of class and feature the thresholds, the sum of
    leaf values for each interval between them, and the sum for a missing value."""

    class_id: list[int]
    feature: list[int]
    thresholds: list[np.ndarray]
    sums: list[np.ndarray]
    missing: list[float]


@dataclass
class _Trees:
    """What the driver has read of an ensemble: a forest, and round and level of each of its nodes."""

    forest: Forest
    round: np.ndarray
    level: np.ndarray

    def ends(self) -> np.ndarray:
        return np.append(self.forest.root[1:], len(self.level))

    def take(self, trees: np.ndarray) -> _Trees:
        """Some of the trees, in the same order."""
        f, size = self.forest, self.ends() - self.forest.root
        chosen = np.repeat(trees, size)
        at = np.cumsum(chosen) - 1
        here, level = np.flatnonzero(chosen), self.level[chosen]
        arrays = [x[here] for x in (f.feature, f.threshold, f.missing_left)]
        forest = Forest(at[f.root[trees]], f.class_id[trees], *arrays, at[f.left[here]], f.value[here], int(level.max(initial=0)))
        return _Trees(forest, self.round[chosen], level)

    def cut(self, max_nodes: int) -> Iterator[Forest]:
        """Forests of at most so many nodes, each of whole rounds and of one round at least."""
        rounds = self.round[self.forest.root]
        if not len(rounds):
            return
        first = np.flatnonzero(np.append(True, rounds[1:] != rounds[:-1]))
        starts, ends = self.forest.root[first], np.append(self.forest.root[first[1:]], len(self.level))
        every, i = np.arange(len(rounds)), 0
        while i < len(first):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + max_nodes, "right")))
            last = first[j] if j < len(first) else len(rounds)
            yield self.take((every >= first[i]) & (every < last)).forest
            i = j


def _read(nodes: DataFrame, first_round: int, last_round: int) -> _Trees:
    """The trees of some rounds."""
    chosen = nodes.where(F.col("round").between(first_round, last_round))
    t = chosen.select(*_FIELDS).orderBy("round", "class_id", "node_id").toArrow()
    col = {n: t.column(n).to_numpy(zero_copy_only=False) for n in _FIELDS if n not in ("is_leaf", "missing_left")}
    leaf = t.column("is_leaf").to_numpy(zero_copy_only=False).astype(bool)
    node = col["node_id"].astype(np.int64)
    if len(node) and not ((col["round"][1:] != col["round"][:-1]) | (col["class_id"][1:] != col["class_id"][:-1]) | (node[1:] != node[:-1])).all():
        raise ValueError("the model table holds a node more than once")
    tree = np.flatnonzero(node == 0)
    number = np.cumsum(node == 0) - 1
    # Heap numbers are ascending inside a tree, so (tree, node) is a sorted key.
    stride = int(node.max(initial=0)) * 2 + 3
    key = number * stride + node
    left = np.searchsorted(key, number * stride + 2 * node + 1)
    here = np.arange(len(node))
    missing = t.column("missing_left").fill_null(True).to_numpy(zero_copy_only=False).astype(bool)
    level = np.floor(np.log2(node + 1)).astype(np.int8)
    forest = Forest(
        tree.astype(np.int64),
        col["class_id"][tree].astype(np.int64),
        np.where(leaf, 0, np.nan_to_num(col["feature"])).astype(np.int64),
        np.where(leaf, np.inf, np.nan_to_num(col["threshold"], nan=np.inf, neginf=-np.inf, posinf=np.inf)),
        missing | leaf,
        # A leaf is its own left child.
        np.where(leaf, here, left).astype(np.int64),
        np.where(leaf, np.nan_to_num(col["leaf_value"].astype(float)), 0.0),
        int(level.max(initial=0)),
    )
    return _Trees(forest, col["round"], level)


def _stumps(f: Forest) -> np.ndarray:
    """Trees of at most one split as rows ``class, feature, threshold, below, above, missing``. A tree that is a
    leaf is its value on both sides."""
    left, right = f.left[f.root], f.left[f.root] + (f.left[f.root] != f.root)
    below, above = f.value[left], f.value[right]
    missing = np.where(f.missing_left[f.root], below, above)
    return np.stack([f.class_id, f.feature[f.root], f.threshold[f.root], below, above, missing])


def _summed(stumps: np.ndarray) -> Steps:
    """The step functions of trees of at most one split, added up in the order of their thresholds."""
    stumps = stumps[:, np.lexsort(stumps[:3][::-1])]
    steps = Steps([], [], [], [], [])
    new = (stumps[:2, 1:] != stumps[:2, :-1]).any(axis=0)
    for part in np.split(stumps, np.flatnonzero(new) + 1, axis=1):
        k, feature, t, below, above, missing = part
        last = np.flatnonzero(np.append(t[1:] != t[:-1], True))
        steps.class_id.append(int(k[0]))
        steps.feature.append(int(feature[0]))
        steps.thresholds.append(t[last])
        steps.sums.append(below.sum() + np.append(0.0, np.cumsum(above - below)[last]))
        steps.missing.append(float(missing.sum()))
    return steps


def step_margins(x: np.ndarray, steps: Steps, n_class: int) -> np.ndarray:
    """What ``forest_margins`` gives for the trees that were summed up."""
    out = np.zeros((n_class, len(x)))
    for k, feature, t, sums, missing in zip(*vars(steps).values()):
        v = x[:, feature].astype(np.float64)
        out[k] += np.where(np.isnan(v), missing, sums[np.searchsorted(t, v, "right")])
    return out.T


def forest_margins(x: np.ndarray, forest: Forest, n_class: int) -> np.ndarray:
    """Sum of leaf values per class for a matrix of rows; NaN is a missing value."""
    out = np.zeros((n_class, len(x)))
    values, row = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    any_missing = np.isnan(values).any()
    for root, k in zip(forest.root, forest.class_id):
        at = np.full(len(x), root)
        for _ in range(forest.depth):
            v = values.take(row + forest.feature.take(at))
            go = v >= forest.threshold.take(at)
            if any_missing:
                go |= np.isnan(v) & ~forest.missing_left.take(at)
            at = forest.left.take(at) + go
        out[k] += forest.value.take(at)
    return out.T


def _probabilities(features: pa.Array, parts: list[Broadcast], n_class: int, n_features: int) -> np.ndarray:
    if features.null_count or len(features.flatten()) != len(features) * n_features:
        raise ValueError(f"every row needs {n_features} features")
    x, m = matrix(features, n_features), 0.0
    for part in parts:
        arrays = part.value
        m = (step_margins(x, Steps(**arrays), n_class) if "sums" in arrays else forest_margins(x, Forest(**arrays), n_class)) + m
    m = np.exp(m - m.max(axis=1, keepdims=True))
    return m / m.sum(axis=1, keepdims=True)


def proba_column(parts: list[Broadcast], n_class: int, n_features: int, features: str) -> Column:
    """Expression for the probabilities. Only the feature column goes to Python, once for the whole ensemble."""

    @F.arrow_udf("array<double>")
    def scored(x: pa.Array) -> pa.Array:
        return lists(_probabilities(x, parts, n_class, n_features))

    return scored(features)


def _round_groups(nodes: DataFrame, max_nodes: int) -> list[tuple[int, int]]:
    """Ranges of rounds with at most ``max_nodes`` nodes, or of one round."""
    t = nodes.groupBy("round").agg(F.count("*").alias("n")).orderBy("round").toArrow()
    rounds, upto = t.column("round").to_numpy(), np.cumsum(t.column("n").to_numpy())
    groups, i = [], 0
    while i < len(rounds):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + max_nodes, "right")))
        groups.append((int(rounds[i]), int(rounds[j - 1])))
        i = j
    return groups


@dataclass
class Packed:
    """A model ready for scoring: broadcast parts of an ensemble, in order."""

    parts: list[Broadcast]
    n_class: int
    n_features: int

    def release(self) -> None:
        """Give the workers' and the driver's copies back; nothing may be scored with it afterwards."""
        for p in self.parts:
            p.destroy()


def packed(nodes: DataFrame, n_class: int, n_features: int, max_nodes: int = MAX_NODES) -> Packed:
    """Reads the model table and sends the trees out, one part at a time. Trees of at most one split, where
    they are many, are one part."""
    groups = _round_groups(nodes, max(max_nodes, MAX_NODES))
    if not groups:
        raise ValueError("the model has no trees")
    sc = nodes.sparkSession.sparkContext
    # Plain arrays: workers need not have this package to read them.
    parts, stumps = [], []
    for first, last in groups:
        trees = _read(nodes, first, last)
        small = np.maximum.reduceat(trees.level, trees.forest.root) <= 1
        if small.sum() >= STEPS_FROM:
            stumps.append(_stumps(trees.take(small).forest))
            trees = trees.take(~small)
        parts += [sc.broadcast(vars(f)) for f in trees.cut(max_nodes)]
    if stumps:
        parts.append(sc.broadcast(vars(_summed(np.concatenate(stumps, axis=1)))))
    return Packed(parts, n_class, n_features)


def score_packed(df: DataFrame, model: Packed) -> DataFrame:
    """Add ``proba``, lazily and in one narrow stage whatever the size of the ensemble, on tables
    and streams alike. Thresholds compare raw features, so no edge table is needed."""
    return df.withColumn("proba", proba_column(model.parts, model.n_class, model.n_features, "features"))


def score_routed(df: DataFrame, models: list[Packed], which: Column) -> DataFrame:
    """``score_packed`` where each row has a model of its own, ``which`` of them: one pass over all rows."""
    known = [(m.parts, m.n_class, m.n_features) for m in models]

    @F.arrow_udf("array<double>")
    def scored(x: pa.Array, which: pa.Array) -> pa.Array:
        mine = which.to_numpy(zero_copy_only=False)
        ends = np.cumsum(np.array([n_class for _, n_class, _ in known])[mine])
        out = np.zeros(ends[-1] if len(ends) else 0)
        for k in np.unique(mine):
            at = np.flatnonzero(mine == k)
            out[ends[at, None] + np.arange(-known[k][1], 0)] = _probabilities(x.take(pa.array(at)), *known[k])
        return pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), out)

    return df.withColumn("proba", scored("features", which))


def score(
    df: DataFrame, nodes: DataFrame, n_class: int, n_features: int, max_nodes: int = MAX_NODES
) -> DataFrame:
    """``score_packed`` with the trees of a model table."""
    return score_packed(df, packed(nodes, n_class, n_features, max_nodes))


def score_native(df: DataFrame, nodes: DataFrame, n_class: int) -> DataFrame:
    """The same as one nested CASE per tree, without Python. The expression grows with the
    ensemble, which makes it the form for small ones."""
    rows = nodes.collect()
    by_tree: dict[tuple[int, int], dict[int, object]] = {}
    for r in rows:
        by_tree.setdefault((r["round"], r.class_id), {})[r.node_id] = r

    def branch(tree: dict, node: int) -> Column:
        n = tree[node]
        if n.is_leaf:
            return F.lit(float(n.leaf_value))
        v = F.get("features", F.lit(n.feature))
        known = v.isNotNull() & ~F.isnan(v)
        right = known & (v >= F.lit(n.threshold))
        if not n.missing_left:
            right = right | ~known
        return F.when(right, branch(tree, n.right_id)).otherwise(branch(tree, n.left_id))

    margins = [F.lit(0.0)] * n_class
    for (_, k), tree in sorted(by_tree.items()):
        margins[k] = margins[k] + branch(tree, 0)
    return with_softmax(df, margins)
