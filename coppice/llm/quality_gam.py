"""Quality classifier: a generalised additive model with pairwise interactions (operator 6).

Every text becomes a row of statistics of its bytes, words, lines and word windows. Each statistic
is cut into bins, and boosting visits the statistics in turn, round after round: a shallow tree on
the statistic's histogram of residuals adds to that statistic's lookup table. Then the pairs of
statistics whose joint histogram explains most of what is left get two-dimensional tables in the
same way. A score is the sum of table entries through the logistic function; neither label,
language, source nor id enters it.

The model is fitted on at most ``max_rows`` labelled rows, those with the least hash of the id; all
else covers every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import SPACE, byte_class, flat, hash_windows, hash_words, slices, small_batches, text_of, words

STATISTICS = (
    "log_words", "word_length", "word_spread", "symbols", "bangs", "upper", "digits", "marks_at_end",
    "same_as_before", "top_word", "distinct", "repeated_windows", "repeated_lines", "line_words",
    "no_letter", "short_words", "non_ascii", "sentence_words",
)
MAX_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 6
RATE, RIDGE, LEAST_ROWS = 0.15, 1.0, 5
_SYMBOLS, _MARKS = b"#*$%&|<>", b".,;:!?"


def _sums(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[at[1:]] - total[at[:-1]]).astype(float)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text; all zero for a text without words."""
    buf, at = flat(texts)
    n = len(texts)
    starts, ends, counts = words(buf, at, byte_class(SPACE, negate=True))
    first = np.concatenate([[0], np.cumsum(counts)])
    size = ends - starts
    total = np.maximum(counts, 1).astype(float)
    n_bytes = np.maximum(np.diff(at), 1).astype(float)
    share = lambda members: _sums(byte_class(members)[buf], at) / n_bytes
    upper = _sums((buf >= 65) & (buf <= 90), at)
    lower = _sums((buf >= 97) & (buf <= 122), at)
    per_word = lambda mask: _sums(mask, first) / total
    mean = _sums(size, first) / total
    spread = np.sqrt(np.maximum(_sums(size * size, first) / total - mean**2, 0))
    h = hash_words(buf, starts, ends, lower=True)
    wins = hash_windows(h, 5)
    letter = ((buf | 32) >= 97) & ((buf | 32) <= 122) | (buf >= 128)
    letters = np.concatenate([[0], np.cumsum(letter)])
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    same[first[:-1][counts > 0]] = False
    marks = byte_class(_MARKS)[buf[ends - 1]] if len(ends) else np.zeros(0, bool)
    top, distinct, repeated = np.zeros(n), np.ones(n), np.zeros(n)
    for i in np.flatnonzero(counts):
        a, b = first[i], first[i + 1]
        _, each = np.unique(h[a:b], return_counts=True)
        top[i], distinct[i] = each.max() / (b - a), len(each) / (b - a)
        if b - a > 5:
            repeated[i] = 1 - len(np.unique(wins[a : b - 4])) / (b - a - 4)
    lines, line_ends, n_lines = words(buf, at, byte_class(b"\n", negate=True))
    line_hash = hash_words(buf, lines, line_ends, lower=False)
    line_first = np.concatenate([[0], np.cumsum(n_lines)])
    copies = np.zeros(n)
    for i in np.flatnonzero(n_lines > 1):
        copies[i] = 1 - len(np.unique(line_hash[line_first[i] : line_first[i + 1]])) / n_lines[i]
    stops = byte_class(b".!?")[buf[ends - 1]] if len(ends) else np.zeros(0, bool)
    out = np.column_stack([
        np.log1p(counts), mean, spread, share(_SYMBOLS), share(b"!"), upper / np.maximum(upper + lower, 1),
        share(b"0123456789"), per_word(marks), per_word(same), top, distinct, repeated, copies,
        np.log1p(counts / np.maximum(n_lines, 1)), per_word(letters[ends] == letters[starts]), per_word(size <= 3),
        _sums(buf >= 128, at) / n_bytes, np.log1p(counts / np.maximum(_sums(stops, first), 1)),
    ])
    out[counts == 0] = 0
    return out


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and the statistics of every row."""
    inner = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = statistics(text_of(part.column(1)))
                cols = [pa.array(x[:, k]) for k in range(x.shape[1])]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], ["id", *STATISTICS])

    fields = ", ".join(f"{name} double" for name in STATISTICS)
    return inner.mapInArrow(run, f"id {inner.schema['id'].dataType.simpleString()}, {fields}")


@dataclass
class AdditiveModel:
    """Cut points per statistic, a lookup table per statistic, and tables per pair."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        for j, cut in enumerate(self.cuts):
            margin += self.tables[j][np.searchsorted(cut, x[:, j], side="right")]
        for (i, j), cells in zip(self.pairs, self.pair_tables, strict=True):
            margin += cells[
                np.searchsorted(self.pair_cuts[i], x[:, i], side="right"),
                np.searchsorted(self.pair_cuts[j], x[:, j], side="right"),
            ]
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Up to ``bins - 1`` cut points, half-way between neighbouring values at the quantiles."""
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) < 2:
        return np.zeros(0)
    reached = np.cumsum(counts)[:-1]
    at = np.unique(np.searchsorted(reached, np.arange(1, bins) * len(values) / bins).clip(0, len(distinct) - 2))
    return (distinct[at] + distinct[at + 1]) / 2


def _leaf(g, h):
    return g / (h + RIDGE)


def _shallow(g: np.ndarray, h: np.ndarray, n: np.ndarray, splits: int = 2) -> np.ndarray:
    """Leaf values over the bins of a tree with at most ``splits`` splits, grown best first."""
    parts = [(0, len(g))]
    for _ in range(splits):
        best = None
        for a, b in parts:
            if b - a < 2:
                continue
            cg, ch, cn = np.cumsum(g[a:b]), np.cumsum(h[a:b]), np.cumsum(n[a:b])
            gain = cg[:-1] ** 2 / (ch[:-1] + RIDGE) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + RIDGE)
            gain -= cg[-1] ** 2 / (ch[-1] + RIDGE)
            gain[(cn[:-1] < LEAST_ROWS) | (cn[-1] - cn[:-1] < LEAST_ROWS)] = -1
            k = int(np.argmax(gain))
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = (gain[k], a, a + k + 1, b)
        if best is None:
            break
        parts.remove((best[1], best[3]))
        parts += [(best[1], best[2]), (best[2], best[3])]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _grid(cell: np.ndarray, shape: tuple[int, int], *weights: np.ndarray) -> list[np.ndarray]:
    return [np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in weights]


def _cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts both ways once."""
    best, leaves = 0.0, np.zeros_like(g)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            quads = [
                (c[i, j], c[i, -1] - c[i, j], c[-1, j] - c[i, j], c[-1, -1] - c[i, -1] - c[-1, j] + c[i, j])
                for c in (cg, ch)
            ]
            gain = sum(a * a / (b + RIDGE) for a, b in zip(*quads, strict=True))
            if gain > best:
                best, leaves = gain, np.zeros_like(g)
                value = [_leaf(a, b) for a, b in zip(*quads, strict=True)]
                leaves[: i + 1, : j + 1], leaves[: i + 1, j + 1 :] = value[0], value[1]
                leaves[i + 1 :, : j + 1], leaves[i + 1 :, j + 1 :] = value[2], value[3]
    return best, leaves


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """The model of labelled statistics. Without rows every score is one half; with one class only
    the smoothed share of that class."""
    width = x.shape[1]
    none = [np.zeros(0)] * width
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    if len(np.unique(y)) < 2:
        return AdditiveModel(base, none, [np.zeros(1)] * width, none, [], [])
    cuts = [_cut_points(x[:, j], BINS) for j in range(width)]
    binned = [np.searchsorted(cuts[j], x[:, j], side="right") for j in range(width)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    margin = np.full(len(y), base)

    def residual():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    counts = [np.bincount(binned[j], minlength=len(tables[j])) for j in range(width)]
    for _ in range(ROUNDS):
        for j in range(width):
            g, h = residual()
            step = RATE * _shallow(
                np.bincount(binned[j], g, len(tables[j])), np.bincount(binned[j], h, len(tables[j])), counts[j]
            )
            tables[j] += step
            margin += step[binned[j]]
    pair_cuts = [_cut_points(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(pair_cuts[j], x[:, j], side="right") for j in range(width)]
    g, h = residual()
    ranked = []
    for i in range(width):
        for j in range(i + 1, width):
            shape = (len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1)
            ranked.append((-_cross_tree(*_grid(coarse[i] * shape[1] + coarse[j], shape, g, h))[0], i, j))
    pairs = [(i, j) for _, i, j in sorted(ranked)[:PAIRS]]
    shapes = [(len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1) for i, j in pairs]
    cells = [coarse[i] * s[1] + coarse[j] for (i, j), s in zip(pairs, shapes, strict=True)]
    pair_tables = [np.zeros(s) for s in shapes]
    for _ in range(PAIR_ROUNDS):
        for k, shape in enumerate(shapes):
            g, h = residual()
            step = RATE * _cross_tree(*_grid(cells[k], shape, g, h))[1]
            pair_tables[k] += step
            margin += step.ravel()[cells[k]]
    return AdditiveModel(base, cuts, tables, pair_cuts, pairs, pair_tables)


def held_out(id_col: str):
    """Whether the label of a row is kept from the fit: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = MAX_ROWS,
    threshold: float = 0.5,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` of every row, and the columns of ``carry``, which
    are computed from the row and tell rows apart whose ids do not.

    Rows with a NULL id or label do not enter the fit; of repeated ids one row with the largest
    label does. A NULL or empty text has all statistics zero and is scored as such. The statistics
    are written to the folder of ``spark.checkpoint.dir`` once and read for the fit and the scores."""
    carry = carry or {}
    key = F.struct(F.col(id_col).alias("id"), *[c.alias(f"also_{n}") for n, c in carry.items()])
    described, _ = written(describe(docs.select(key.alias("__key"), text_col), "__key", text_col), "statistics")
    # The rows with their labels; the key's parts are told apart again for the result.
    labelled = described.withColumn("key", F.col("id")).withColumn("id", F.col("key.id"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
    known = known.where(F.col("y").isNotNull() & ~held_out("id")).groupBy("id").agg(F.max("y").alias("y"))
    rows = labelled.join(known, "id").select("id", "y", *STATISTICS).orderBy(F.xxhash64("id"), "id", *STATISTICS).limit(max_rows).toArrow()
    x = np.column_stack([rows.column(s).to_numpy() for s in STATISTICS]) if rows.num_rows else np.zeros((0, len(STATISTICS)))
    ids = rows.column("id").to_pylist()
    once = [k for k in range(len(ids)) if not k or ids[k] != ids[k - 1]]
    model = fit(x[once], rows.column("y").to_numpy()[once] if once else np.zeros(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(k + 1).to_numpy() for k in range(len(STATISTICS))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["id", "score"])

    kind = described.schema["id"].dataType.simpleString()
    scored = described.mapInArrow(run, f"id {kind}, score double")
    return scored.select(
        F.col("id.id").alias(id_col),
        held_out("id.id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *[F.col(f"id.also_{n}").alias(n) for n in carry],
    )
