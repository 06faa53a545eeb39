"""Gradient histograms: sums of first and second derivatives per (tree, node, feature, bin).

``grad_histogram`` is the plain DataFrame form, ``node_histograms`` gives the cells of any nodes.
Training runs ``level_splits``, one pass per level. Of two sibling nodes only the lighter one is
summed over the rows: the sums of the other are those of their parent, which the last level has
kept, less the lighter one's. Tasks send packed sums of node and feature slice; the reducer of a
slice adds them up one by one as they come, so that what it holds does not depend on the number of
tasks, and searches both children. All sums are fixed-point BIGINT, so that they, and with them the
trees, do not depend on the order in which rows or partial results arrive, and a difference is
exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import PRIME
from ..functions.proba import MIN_HESSIAN
from .blocks import Block, joined, unpack

CELLS = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("tree", "node", "feature", "bin")]
    + [T.StructField(c, T.LongType()) for c in ("g", "h")]
)


def fixed_scale(n_rows: int) -> float:
    """Largest power of two, at most 2^30, with which sums over ``n_rows`` fit a BIGINT."""
    return float(2 ** min(30, 61 - math.ceil(math.log2(max(n_rows, 2)))))


def grad_histogram(df: DataFrame) -> DataFrame:
    """Histogram of rows ``(bins, node, g, h)``, where ``node``, ``g`` and ``h`` hold one
    entry per tree of the round."""
    trees = df.select(
        "bins", F.posexplode(F.arrays_zip("node", "g", "h")).alias("tree", "entry")
    )
    cells = trees.select(
        "tree",
        F.col("entry.node").alias("node"),
        F.col("entry.g").alias("g"),
        F.col("entry.h").alias("h"),
        F.posexplode("bins").alias("feature", "bin"),
    )
    return cells.groupBy("tree", "node", "feature", F.col("bin").cast("int").alias("bin")).agg(
        F.sum("g").alias("g"), F.sum("h").alias("h")
    )


@dataclass
class Grown:
    """The part of one round's trees that is already decided, in arrays by level.

    Position ``p`` at level ``l`` has the children ``2p`` (left) and ``2p + 1``, if it is split.
    """

    n_trees: int
    split: list[np.ndarray] = field(default_factory=list)
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    missing_right: list[np.ndarray] = field(default_factory=list)

    def add_level(self) -> None:
        shape = (self.n_trees, 1 << len(self.feature))
        self.split.append(np.zeros(shape, bool))
        self.feature.append(np.zeros(shape, np.int32))
        self.cut.append(np.zeros(shape, np.int16))
        self.missing_right.append(np.zeros(shape, bool))


def descend(
    bins: np.ndarray, rows: np.ndarray, tree: int, grown: Grown, enter: list[np.ndarray] | None = None
) -> Iterator[tuple[int, int, np.ndarray]]:
    """Rows of each node of ``tree`` where the descent ends, as (level, position, rows). It ends at nodes
    that are not split. With ``enter`` only the positions marked there, by level, are entered, and it
    ends at the last level. ``bins`` is (features, rows); rows are halved level by level and keep
    their order, so a level costs a look at one bin for each row that is still on the way."""
    here = [(0, rows)]
    depth = len(grown.split) if enter is None else len(enter) - 1
    for level in range(depth + 1):
        below = []
        for at, r in here:
            if level == depth or not grown.split[level][tree, at]:
                yield level, at, r
                continue
            b = bins[grown.feature[level][tree, at]].take(r)
            go = b > grown.cut[level][tree, at]
            if grown.missing_right[level][tree, at]:
                go |= b == 0
            for child, side in ((2 * at, ~go), (2 * at + 1, go)):
                if enter is None or enter[level + 1][child]:
                    below.append((child, r[side]))
        here = below


@dataclass
class Pass:
    """What one pass over the rows computes."""

    n_features: int
    n_bins: int
    n_class: int
    scale: float
    grown: Grown
    # Per trial: hash coefficients and cutoff of the row sample.
    samples: list[tuple[int, int, int]]
    # Per tree: features it may use, ascending, and position -> slot in the output (-1: not wanted).
    features: list[list[int]]
    slots: dict[int, np.ndarray]


# Rows whose blocks a task joins before it sums, so that a node's share of them is worth a call.
GROUP_ROWS = 1 << 17


def grouped(blocks: Iterator[Block], rows: int = GROUP_ROWS) -> Iterator[Block]:
    """Blocks joined to larger ones."""
    waiting, n = [], 0
    for block in blocks:
        waiting.append(block)
        n += len(block.label)
        if n >= rows:
            yield joined(waiting)
            waiting, n = [], 0
    if waiting:
        yield joined(waiting)


def _task_sums(batches: Iterator[pa.RecordBatch], todo: Pass):
    """What the rows of one task add up to: per tree the wanted nodes and the sums of both
    derivatives, as arrays of (used feature, node and bin)."""
    wanted = {t: np.flatnonzero(s >= 0) for t, s in todo.slots.items()}
    g_sum = {t: np.zeros((len(todo.features[t]), len(p) * todo.n_bins), np.int64) for t, p in wanted.items()}
    h_sum = {t: np.zeros_like(a) for t, a in g_sum.items()}
    enter = {}
    for t, s in todo.slots.items():
        marks = [s >= 0]
        while len(marks[0]) > 1:
            marks.insert(0, marks[0].reshape(-1, 2).any(axis=1))
        enter[t] = marks
    n_trees = len(todo.samples) * todo.n_class
    blocks = (k for batch in batches for k in unpack(batch, todo.n_features, todo.n_bins, n_trees))
    for block in grouped(blocks):
        for trial, (a, b, cutoff) in enumerate(todo.samples):
            first = trial * todo.n_class
            trees = [t for t in range(first, first + todo.n_class) if t in wanted]
            if not trees:
                continue
            inside = np.flatnonzero((block.row_hash * a + b) % PRIME < cutoff)
            m = block.margin[:, first : first + todo.n_class]
            p = np.exp(m - m.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for t in trees:
                parts = [(todo.slots[t][at], r) for _, at, r in descend(block.bins, inside, t, todo.grown, enter[t]) if len(r)]
                if not parts:
                    continue
                rows = np.concatenate([r for _, r in parts])
                base = np.repeat(np.array([s for s, _ in parts]) * todo.n_bins, [len(r) for _, r in parts])
                pk = p[rows, t - first]
                g = np.rint((pk - (block.label[rows] == t - first)) * todo.scale)
                # The floor holds after scaling: a second derivative is at least one unit.
                h = np.maximum(np.rint(np.maximum(pk * (1 - pk), MIN_HESSIAN) * todo.scale), 1)
                size = g_sum[t].shape[1]
                for i, f in enumerate(todo.features[t]):
                    cell = base + block.bins[f].take(rows)
                    g_sum[t][i] += np.bincount(cell, g, size).astype(np.int64)
                    h_sum[t][i] += np.bincount(cell, h, size).astype(np.int64)
    return wanted, g_sum, h_sum


def _task_cells(batches: Iterator[pa.RecordBatch], todo: Pass) -> Iterator[pa.RecordBatch]:
    """One row per cell."""
    wanted, g_sum, h_sum = _task_sums(batches, todo)
    for t, at in wanted.items():
        used = np.asarray(todo.features[t], np.int32)
        i, cell = np.nonzero((g_sum[t] != 0) | (h_sum[t] != 0))
        arrays = [
            np.full(len(i), t, np.int32),
            at[cell // todo.n_bins].astype(np.int32),
            used[i],
            (cell % todo.n_bins).astype(np.int32),
            g_sum[t][i, cell],
            h_sum[t][i, cell],
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a) for a in arrays], names=["tree", "node", "feature", "bin", "g", "h"]
        )


def node_histograms(blocks: DataFrame, todo: Pass) -> DataFrame:
    """Histogram cells of the wanted nodes over all sampled rows.

    The margins of a block are those of the classes of trial 0, of trial 1, and so on.
    Memory of a task is bounded by the number of wanted nodes, which the caller limits.
    Sums inside a task are exact: they stay far below 2^53. Each task emits a cell at most once."""
    cells = blocks.select("bins", "margin", "label", "row_hash").mapInArrow(
        lambda batches: _task_cells(batches, todo), CELLS
    )
    return cells.groupBy("tree", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


# A row of a level: sums of one node and feature slice. ``cell`` numbers the cells that are not empty.
# In what tasks send, ``node`` is the parent whose lighter child the sums are of (at the root the root
# itself) and ``kept`` tells the parent's own sums, which the level before has left.
_PARTS = "tree INT, node INT, slice INT, kept BOOLEAN, cell BINARY, g BINARY, h BINARY"
FOUND = (
    "feature INT, bin INT, missing_left BOOLEAN, gain DOUBLE, g_left DOUBLE, h_left DOUBLE, "
    "g_right DOUBLE, h_right DOUBLE, g_all DOUBLE, h_all DOUBLE"
)
LEVEL = f"tree INT, node INT, slice INT, {FOUND}, cell BINARY, g BINARY, h BINARY"
SPLIT_COLUMNS = ["tree", "node", "slice", *[c.split()[0] for c in FOUND.split(", ")]]
# Bytes of dense sums that one reducer holds, and of packed sums that come to it, at most about.
REDUCER_BYTES, ARRIVING_BYTES = 64 << 20, 256 << 20


def _packed(g: np.ndarray, h: np.ndarray) -> tuple[bytes, bytes, bytes]:
    cell = np.flatnonzero(h)
    return cell.astype(np.int32).tobytes(), g[cell].tobytes(), h[cell].tobytes()


def slices_of(n_used: int, n_slices: int) -> list[tuple[int, int]]:
    """Ranges of a tree's features that are reduced together."""
    ends = [n_used * k // n_slices for k in range(n_slices + 1)]
    return [(a, b) for a, b in zip(ends, ends[1:]) if a < b]


def _task_parts(batches: Iterator[pa.RecordBatch], todo: Pass, parent: dict[tuple[int, int], int], n_slices: int):
    """One row per node summed and feature slice."""
    wanted, g_sum, h_sum = _task_sums(batches, todo)
    for t, at in wanted.items():
        used = len(todo.features[t])
        g, h = (s[t].reshape(used, len(at), todo.n_bins) for s in (g_sum, h_sum))
        out = []
        for k, node in enumerate(at):
            for s, (a, b) in enumerate(slices_of(used, n_slices)):
                part = _packed(g[a:b, k].ravel(), h[a:b, k].ravel())
                if part[0]:
                    out.append((t, parent[t, int(node)], s, False, *part))
        if out:
            yield _batch(out, _PART_TYPE)


def search_nodes(
    g: np.ndarray, h: np.ndarray, features: list[int], scale: float, lam: float, weight: float
) -> list[tuple]:
    """Best split of each of some nodes of one tree from their (node, feature, bin) sums, by the rules of
    ``splits.split_gain`` and ``splits.best_split``, and the nodes' totals. Features ascend."""
    g, h = g / scale, h / scale
    g_upto, h_upto = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    g_all, h_all = g_upto[:, :, -1:], h_upto[:, :, -1:]

    def score(a, b):
        below = b + lam
        return a * a / np.where(below > 0, below, 1.0)

    every = np.arange(len(g))
    best: list = [None] * len(g)
    for missing_left in (True, False):
        gl = g_upto if missing_left else g_upto - g[:, :, :1]
        hl = h_upto if missing_left else h_upto - h[:, :, :1]
        gr, hr = g_all - gl, h_all - hl
        gain = (score(gl, hl) + score(gr, hr) - score(g_all, h_all)) * 0.5
        ok = (hl > 0) & (hr > 0) & (hl >= weight) & (hr >= weight) & (gain > 0)
        if not missing_left:
            ok &= h[:, :, :1] > 0
        # The first of equal gains is that of the lowest feature and then the lowest bin.
        first = np.where(ok, gain, -1.0).reshape(len(g), -1).argmax(axis=1)
        i, b = np.unravel_index(first, gain.shape[1:])
        for k in np.flatnonzero(ok[every, i, b]):
            at = k, i[k], b[k]
            rank = (gain[at], -features[i[k]], -b[k], missing_left)
            if best[k] is None or rank > best[k][0]:
                best[k] = (rank, int(features[i[k]]), int(b[k]), missing_left, *(float(x[at]) for x in (gain, gl, hl, gr, hr)))
    return [
        (*(best[k][1:] if best[k] else (None,) * 8), float(g_all[k, 0, 0]), float(h_all[k, 0, 0])) for k in range(len(g))
    ]


@dataclass
class Level:
    """One level's part of a round: which nodes are summed over the rows, and what follows from them."""

    todo: Pass
    # Parent -> (child that is summed, the other one), or the root -> (root, None).
    pairs: dict[tuple[int, int], tuple[int, int | None]]
    n_slices: int
    reg_lambda: list[float]
    min_child_weight: list[float]
    # Whether the sums are kept for the next level.
    keep: bool


def _reduce(batches: Iterator[pa.RecordBatch], level: Level) -> Iterator[pa.RecordBatch]:
    """Sums what has come for each parent and slice, and searches both children."""
    todo, sums = level.todo, {}
    for batch in batches:
        columns = [batch.column(c) for c in ("cell", "g", "h")]
        keys = zip(*(batch.column(c).to_pylist() for c in ("tree", "node", "slice", "kept")))
        for i, (tree, node, s, kept) in enumerate(keys):
            if (tree, node) not in level.pairs:
                continue
            a, b = slices_of(len(todo.features[tree]), level.n_slices)[s]
            if (tree, s, node) not in sums:
                sums[tree, s, node] = np.zeros((2, 2, (b - a) * todo.n_bins), np.int64)
            cell, g, h = (np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(columns, (np.int32, np.int64, np.int64)))
            into = sums[tree, s, node][int(kept)]
            into[0][cell] += g
            into[1][cell] += h
    by_slice: dict[tuple[int, int], list] = {}
    for tree, s, node in sorted(sums):
        of = sums.pop((tree, s, node))
        small, other = level.pairs[tree, node]
        by_slice.setdefault((tree, s), []).append((small, of[0]))
        if other is not None:
            by_slice[tree, s].append((other, of[1] - of[0]))
    for (tree, s), nodes in by_slice.items():
        a, b = slices_of(len(todo.features[tree]), level.n_slices)[s]
        shape = (len(nodes), b - a, todo.n_bins)
        g, h = (np.stack([x[k] for _, x in nodes]).reshape(shape) for k in (0, 1))
        found = search_nodes(g, h, todo.features[tree][a:b], todo.scale, level.reg_lambda[tree], level.min_child_weight[tree])
        rows = []
        for (node, of), split in zip(nodes, found):
            rows.append((tree, node, s, *split, *(_packed(*of) if level.keep else (b"", b"", b""))))
        yield _batch(rows, _LEVEL_TYPE)


def level_splits(blocks: DataFrame, level: Level, kept: DataFrame | None, n_tasks: int) -> DataFrame:
    """Best split within each feature slice of every node of the level, with the node's totals, and the
    sums (``LEVEL``). A node without a split has NULLs. ``blocks`` are ``bins, margin, label, row_hash`` of
    training rows; ``kept`` has the rows of the level before, at the root there are none."""
    todo, pairs = level.todo, level.pairs
    parent = {(t, small): p for (t, p), (small, _) in pairs.items()}
    parts = blocks.mapInArrow(lambda batches: _task_parts(batches, todo, parent, level.n_slices), _PART_ROWS)
    if kept is not None:
        rows = kept.select("tree", "node", "slice", F.lit(True).alias("kept"), "cell", "g", "h")
        parts = parts.union(rows)
    node_bytes = todo.n_features * todo.n_bins * 16
    arriving = len(pairs) * node_bytes * (n_tasks + 1)
    reducers = max(-(-len(pairs) * 2 * node_bytes // REDUCER_BYTES), -(-arriving // ARRIVING_BYTES))
    # The search of many nodes is worth more than one task.
    reducers = max(reducers, min(n_tasks, -(-len(pairs) // 32)))
    reducers = min(reducers, len(pairs) * level.n_slices)
    return parts.repartition(reducers, "tree", "node", "slice").mapInArrow(lambda batches: _reduce(batches, level), _LEVEL_ROWS)


def slice_count(n_tasks: int, n_features: int, n_bins: int) -> int:
    """Feature slices of a node: so many that what all tasks send of one keeps to ``ARRIVING_BYTES``."""
    return max(1, min(n_features, -(-n_tasks * n_features * n_bins * 20 // ARRIVING_BYTES)))


def merged_splits(rows: list) -> list:
    """The best of the slices of each node, by gain, then lowest feature, lowest bin, missing values to the
    left. Rows have ``SPLIT_COLUMNS``."""
    best: dict[tuple[int, int], tuple] = {}
    for r in rows:
        rank = (r.gain is not None, r.gain or 0.0, -(r.feature or 0), -(r.bin or 0), bool(r.missing_left))
        if (r.tree, r.node) not in best or rank > best[r.tree, r.node][0]:
            best[r.tree, r.node] = (rank, r)
    return [best[k][1] for k in sorted(best)]


def _arrow(schema: str) -> pa.Schema:
    kinds = {"INT": pa.int32(), "BOOLEAN": pa.bool_(), "DOUBLE": pa.float64(), "BINARY": pa.binary()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])


def _spark(schema: str) -> T.StructType:
    """The schema without asking the JVM to parse it, which every level would do again."""
    kinds = {"INT": T.IntegerType(), "BOOLEAN": T.BooleanType(), "DOUBLE": T.DoubleType(), "BINARY": T.BinaryType()}
    return T.StructType([T.StructField(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])


_PART_TYPE, _LEVEL_TYPE = _arrow(_PARTS), _arrow(LEVEL)
_PART_ROWS, _LEVEL_ROWS = _spark(_PARTS), _spark(LEVEL)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
