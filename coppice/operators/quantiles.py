"""Exact order statistics of many columns in two scans.

A scan leaves, for each column, a list of chunks ``(least, greatest, count)``. Whatever the rows were
grouped by, at most ``sum of counts with least <= x`` and at least ``sum of counts with greatest <= x``
values are not above ``x``, so that the value of any rank lies between two known ends. Lists are put
together by writing one behind the other and kept short by joining neighbours, which widens the
ends but never makes them wrong. Where both ends are one value, as for columns of few values, the
rank is found; the next scan looks at values between the ends of the others only and counts what
lies below them. Each scan narrows an interval by a factor of hundreds, so the second one finds all
up to some thousand million rows, and a third is taken where it does not.

The result is exact and does not depend on partitions. A task holds ``limit`` chunks for each
interval, a reducer those of one interval of one column from all tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Chunks that a task keeps of one column in the first scan, and how many times as many of one
# interval in later ones, where intervals are narrow.
LIMIT, LATER = 4096, 16
# Chunks of all tasks that a reducer should get at most, and least number from one task.
REDUCER_CHUNKS, LEAST = 4_000_000, 128
_PENDING = 1 << 16

_CHUNKS = "feature INT, part INT, below BIGINT, least BINARY, greatest BINARY, n BINARY"
_ENDS = "feature INT, rank BIGINT, lo DOUBLE, hi DOUBLE, least DOUBLE"


def chunk_limit(n_tasks: int) -> int:
    return max(LEAST, min(LIMIT, REDUCER_CHUNKS // max(1, n_tasks)))


def merged(least: np.ndarray, greatest: np.ndarray, n: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chunks with equal ones summed, and, where they are more than about ``limit``, neighbours joined.
    A single value that holds a chunk's share of all stays by itself."""
    order = np.lexsort((least, greatest))
    least, greatest, n = least[order], greatest[order], n[order]
    new = np.ones(len(n), bool)
    new[1:] = (least[1:] != least[:-1]) | (greatest[1:] != greatest[:-1])
    at = np.flatnonzero(new)
    least, greatest, n = least[at], greatest[at], np.add.reduceat(n, at) if len(at) else n
    if len(n) <= limit:
        return least, greatest, n
    total = int(n.sum())
    cell = (np.cumsum(n) - n) // max(1, -(-total // limit))
    alone = (least == greatest) & (n * limit >= total)
    new = np.ones(len(n), bool)
    new[1:] = (cell[1:] != cell[:-1]) | alone[1:] | alone[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(n)) - 1
    return np.minimum.reduceat(least, at), greatest[last], np.add.reduceat(n, at)


class _Kept:
    """Chunks of one interval in one task, and values that are not in them yet."""

    def __init__(self, limit: int):
        self.limit, self.below, self.waiting, self.n_waiting = limit, 0, [], 0
        self.chunks = (np.zeros(0), np.zeros(0), np.zeros(0, np.int64))

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.n_waiting += len(values)
        if self.n_waiting >= max(_PENDING, self.limit):
            self.settle()

    def settle(self) -> None:
        if self.n_waiting:
            v = np.concatenate(self.waiting).astype(np.float64)
            one = np.ones(len(v), np.int64)
            self.chunks = merged(*(np.concatenate(p) for p in zip(self.chunks, (v, v, one))), self.limit)
        self.waiting, self.n_waiting = [], 0


def _scan(blocks: Iterable[list[np.ndarray]], parts: dict[int, list[tuple[float, float]]] | None, limit: int):
    """Chunks of each column (``parts`` None) or of its intervals, both ends included, from one task's
    rows. A block is a list of columns; NaN is a missing value."""
    kept: dict[tuple[int, int], _Kept] = {}
    for columns in blocks:
        for f, column in enumerate(columns):
            if parts is not None and f not in parts:
                continue
            values = column[~np.isnan(column)]
            if parts is None:
                kept.setdefault((f, 0), _Kept(limit)).add(values)
                continue
            values = np.sort(values)
            for i, (lo, hi) in enumerate(parts[f]):
                a, b = np.searchsorted(values, lo, "left"), np.searchsorted(values, hi, "right")
                k = kept.setdefault((f, i), _Kept(limit))
                k.below += int(a)
                if b > a:
                    k.add(values[a:b])
    out = []
    for (f, i), k in kept.items():
        k.settle()
        least, greatest, n = k.chunks
        out.append((f, i, k.below, least.tobytes(), greatest.tobytes(), n.tobytes()))
    if out:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["feature", "part", "below", "least", "greatest", "n"])


def _ends(key, group: pa.Table, ranks_of: Callable[[int, int, int], list[int]]) -> pa.Table:
    """Both ends of each rank wanted of one interval."""
    feature, part = (k.as_py() for k in key)
    read = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in group.column(name).to_pylist()])
    least, greatest, n = read("least", np.float64), read("greatest", np.float64), read("n", np.int64)
    below = sum(group.column("below").to_pylist())
    ranks = np.array(ranks_of(feature, part, int(n.sum())), np.int64)
    ends = []
    for values in (least, greatest):
        order = np.argsort(values, kind="stable")
        # Of empty intervals there are no ranks; a zero without a sign is as good as one with it.
        ends.append(values[order][np.searchsorted(np.cumsum(n[order]), ranks - below)] + 0.0 if len(ranks) else values[:0])
    lowest = float(least.min()) if len(least) else float("nan")
    return pa.table(
        {
            "feature": pa.array([feature] * len(ranks), pa.int32()),
            "rank": pa.array(ranks),
            "lo": pa.array(ends[0]),
            "hi": pa.array(ends[1]),
            "least": pa.array([lowest] * len(ranks), pa.float64()),
        }
    )


def _scanner(columns, parts, limit: int):
    return lambda batches: _scan((block for b in batches if b.num_rows for block in columns(b)), parts, limit)


def _reducer(ranks_of):
    return lambda key, group: _ends(key, group, ranks_of)


def order_statistics(
    rows: DataFrame,
    columns: Callable[[pa.RecordBatch], Iterator[list[np.ndarray]]],
    wanted: Callable[[int], list[int]],
    limit: int = LIMIT,
) -> tuple[dict[int, dict[int, float]], dict[int, float]]:
    """For each column the values of the ranks (from 1) that ``wanted`` names for its number of values, and
    its least value. ``columns`` turns an Arrow batch of ``rows`` into blocks of columns. Columns
    without values are left out. The driver gets one row for each column and rank."""
    found: dict[int, dict[int, float]] = defaultdict(dict)
    lowest: dict[int, float] = {}
    parts, inside = None, {}
    while True:
        size = limit if parts is None else limit * LATER

        ranks = (lambda f, i, n: wanted(n)) if parts is None else (lambda f, i, n, inside=inside: inside[f, i])
        chunks = rows.mapInArrow(_scanner(columns, parts, size), _CHUNKS)
        ends = chunks.groupBy("feature", "part").applyInArrow(_reducer(ranks), _ENDS)
        opened: dict[int, dict[tuple[float, float], list[int]]] = defaultdict(lambda: defaultdict(list))
        for r in ends.collect():
            if parts is None:
                lowest[r.feature] = r.least
            if r.lo == r.hi:
                found[r.feature][r["rank"]] = r.lo
            else:
                opened[r.feature][r.lo, r.hi].append(r["rank"])
        if not opened:
            return found, lowest
        parts = {f: sorted(spans) for f, spans in opened.items()}
        inside = {(f, i): sorted(opened[f][span]) for f, spans in parts.items() for i, span in enumerate(spans)}
