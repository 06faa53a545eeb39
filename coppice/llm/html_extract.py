"""Main text of web pages by a recurrent block labeller (operator 10).

A page is a sequence of leaf blocks. Each block is read as a vector: the sum of learned vectors of
its element path (tags, class, id and role words, hashed), the mean of learned vectors of its hashed
words, and a few measures (length, links, punctuation, place). A bidirectional LSTM in numpy runs
over the whole sequence and gives every block the probability of belonging to the article.

The labeller is trained where it is used, on pages of a seeded grammar (``page_grammar``) whose
blocks are known; that takes seconds and gives the same weights each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, byte_class, flat, hash_words, slices, small_batches, text_of, words
from .html_blocks import Block, blocks
from .page_grammar import Grammar

PATH_CELLS, PATH_WIDTH = 2_048, 16
WORD_CELLS, WORD_WIDTH = 1_024, 4
MEASURES, HIDDEN_UNITS = 8, 20
TRAIN_PAGES, EPOCHS, BATCH, RATE = 4_000, 5, 32, 8e-3
# Blocks that one batch of sequences holds, padding included; a longer page is a batch of its own.
BATCH_BLOCKS = 20_000
_INSIDE = byte_class(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))


def _cell(word: str) -> int:
    return crc32(word.encode()) % PATH_CELLS


def _path_cells(block: Block) -> frozenset[int]:
    """Cells of the words on a block's path, and of its last one once more as such. What an element adds
    is worked out once for all blocks below it, and one that adds nothing shares its parent's cells."""
    if block.element is None:
        return frozenset((0,))
    chain, at = [], block.element
    while at is not None and at.cells is None:
        chain.append(at)
        at = at.above
    cells = at.cells if at is not None else frozenset()
    for element in reversed(chain):
        own = {_cell(w) for w in (element.tag, *element.names)}
        cells = cells if own <= cells else cells | own
        element.cells = cells
    return cells | {_cell("/" + (block.element.names or [block.element.tag])[-1])}


class Inputs:
    """Blocks of several pages as arrays: path cells and word cells (ragged), and measures."""

    def __init__(self, pages: list[list[Block]]):
        self.sizes = np.array([len(p) for p in pages], np.int64)
        flat_blocks = [b for p in pages for b in p]
        n = len(flat_blocks)
        path = [sorted(_path_cells(b)) for b in flat_blocks]
        self.path_of = np.repeat(np.arange(n), [len(p) for p in path])
        self.path = np.array([c for p in path for c in p], np.int64)
        buf, at = flat(pa.array([b.text for b in flat_blocks], pa.large_string()))
        starts, ends, counts = words(buf, at, _INSIDE)
        self.word_of = np.repeat(np.arange(n), counts)
        self.word = (hash_words(buf, starts, ends, lower=True) % U(WORD_CELLS)).astype(np.int64)
        self.word_share = 1 / np.maximum(counts, 1)[self.word_of]
        chars = np.array([len(b.text) for b in flat_blocks], float)
        last = np.array([b.text[-1] in ".!?:" for b in flat_blocks], float)
        links = np.array([min(1.0, b.link_chars / len(b.text)) for b in flat_blocks])
        marks = np.concatenate([[0], np.cumsum(byte_class(b".,;:!?")[buf])])
        first = np.concatenate([[0], np.cumsum(self.sizes)])
        place = (np.arange(n) - np.repeat(first[:-1], self.sizes) + 0.5) / np.repeat(np.maximum(self.sizes, 1), self.sizes)
        self.measures = np.column_stack([
            np.log1p(chars) / 5, np.log1p(counts) / 4, links, last, 5 * np.diff(marks[at]) / np.maximum(chars, 1),
            place, (counts <= 3), np.minimum(chars / np.maximum(counts, 1), 20) / 10,
        ]) if n else np.zeros((0, MEASURES))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block vectors, with its gradients for training."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        width, h = PATH_WIDTH + WORD_WIDTH + MEASURES, HIDDEN_UNITS
        self.p = {"path": r.normal(0, 0.3, (PATH_CELLS, PATH_WIDTH)), "word": r.normal(0, 0.3, (WORD_CELLS, WORD_WIDTH))}
        for d in "fb":
            self.p[d + "x"] = r.normal(0, width**-0.5, (width, 4 * h))
            self.p[d + "h"] = r.normal(0, h**-0.5, (h, 4 * h))
            self.p[d + "c"] = np.concatenate([np.ones(h), np.zeros(3 * h)])
        self.p["out"] = r.normal(0, h**-0.5, 2 * h)
        self.p["skip"] = r.normal(0, 0.1, width)
        self.p["bias"] = np.zeros(1)

    def vectors(self, x: Inputs) -> np.ndarray:
        n = int(x.sizes.sum())
        path, word = np.zeros((n, PATH_WIDTH)), np.zeros((n, WORD_WIDTH))
        for k in range(PATH_WIDTH):
            path[:, k] = np.bincount(x.path_of, self.p["path"][x.path, k], n)
        for k in range(WORD_WIDTH):
            word[:, k] = np.bincount(x.word_of, self.p["word"][x.word, k] * x.word_share, n)
        return np.concatenate([path, word, x.measures], axis=1)

    @staticmethod
    def _steps(sizes: np.ndarray, backward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Row of each page's block at each step, and whether there is one."""
        first = np.cumsum(sizes) - sizes
        t = np.arange(int(sizes.max(initial=0)))
        there = t[:, None] < sizes[None, :]
        at = first + (sizes - 1 - t[:, None] if backward else t[:, None])
        return np.where(there, at, 0), there

    def _run(self, v: np.ndarray, sizes: np.ndarray, d: str, keep: bool):
        at, there = self._steps(sizes, d == "b")
        h, c = np.zeros((len(sizes), HIDDEN_UNITS)), np.zeros((len(sizes), HIDDEN_UNITS))
        out = np.zeros((len(v), HIDDEN_UNITS))
        drive = v @ self.p[d + "x"] + self.p[d + "c"]
        tape = []
        u = HIDDEN_UNITS
        for rows, on in zip(at, there, strict=True):
            z = drive[rows] + h @ self.p[d + "h"]
            gate = _sigmoid(z[:, : 3 * u])
            f, i, o, g = gate[:, :u], gate[:, u : 2 * u], gate[:, 2 * u :], np.tanh(z[:, 3 * u :])
            new_c = f * c + i * g
            new_h = o * np.tanh(new_c)
            if keep:
                tape.append((h, c, f, i, o, g, new_c))
            m = on[:, None]
            h, c = np.where(m, new_h, h), np.where(m, new_c, c)
            out[rows[on]] = h[on]
        return out, tape, at, there

    def forward(self, x: Inputs, keep: bool = False):
        v = self.vectors(x)
        sides = {d: self._run(v, x.sizes, d, keep) for d in "fb"}
        both = np.concatenate([sides["f"][0], sides["b"][0]], axis=1)
        return _sigmoid(both @ self.p["out"] + v @ self.p["skip"] + self.p["bias"][0]), v, both, sides

    def gradients(self, x: Inputs, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        prob, v, both, sides = self.forward(x, keep=True)
        err = (prob - y) / max(1, len(y))
        grads = {"out": both.T @ err, "skip": v.T @ err, "bias": np.array([err.sum()])}
        dv = err[:, None] * self.p["skip"]
        dboth = err[:, None] * self.p["out"]
        u = HIDDEN_UNITS
        for d, part in (("f", dboth[:, :u]), ("b", dboth[:, u:])):
            _, tape, at, there = sides[d]
            dh, dc = np.zeros((len(x.sizes), u)), np.zeros((len(x.sizes), u))
            wh, gh = self.p[d + "h"], np.zeros_like(self.p[d + "h"])
            dz_all = np.zeros((len(v), 4 * u))
            for t in range(len(tape) - 1, -1, -1):
                h, c, f, i, o, g, new_c = tape[t]
                m, rows = there[t][:, None], at[t]
                own = np.where(m, dh + part[rows], 0)
                tanh = np.tanh(new_c)
                cell = np.where(m, dc + own * o * (1 - tanh**2), 0)
                dz = np.concatenate([cell * c * f * (1 - f), cell * g * i * (1 - i), own * tanh * o * (1 - o), cell * i * (1 - g**2)], axis=1)
                gh += h.T @ dz
                dz_all[rows[there[t]]] = dz[there[t]]
                dh, dc = np.where(m, dz @ wh.T, dh), np.where(m, cell * f, dc)
            grads[d + "h"], grads[d + "x"], grads[d + "c"] = gh, v.T @ dz_all, dz_all.sum(0)
            dv += dz_all @ self.p[d + "x"].T
        for name, cells, of, weight, low, width, total in (
            ("path", x.path, x.path_of, None, 0, PATH_WIDTH, PATH_CELLS),
            ("word", x.word, x.word_of, x.word_share, PATH_WIDTH, WORD_WIDTH, WORD_CELLS),
        ):
            grads[name] = np.column_stack([
                np.bincount(cells, dv[of, low + k] * (1 if weight is None else weight), total) for k in range(width)
            ])
        eps = 1e-9
        loss = -np.mean(y * np.log(prob + eps) + (1 - y) * np.log(1 - prob + eps)) if len(y) else 0.0
        return float(loss), grads

    def probabilities(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Of each page's blocks; pages of like length run side by side."""
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        out: list = [None] * len(pages)
        start = 0
        while start < len(order):
            stop = start + 1
            while stop < len(order) and (stop + 1 - start) * len(pages[order[stop]]) <= BATCH_BLOCKS:
                stop += 1
            chunk = order[start:stop]
            x = Inputs([pages[k] for k in chunk])
            prob = self.forward(x)[0]
            for k, part in zip(chunk, np.split(prob, np.cumsum(x.sizes)[:-1]), strict=True):
                out[k] = part
            start = stop
        return out


def training_pages(n: int, seed: int) -> list[tuple[list[Block], np.ndarray]]:
    """Blocks of grammar pages and whether each is article."""
    grammar, out = Grammar(seed), []
    for _ in range(n):
        found = blocks(grammar.page())
        y = np.array([grammar.KEEP in b.text for b in found], float)
        for b in found:
            b.text = b.text.replace(grammar.KEEP, "").replace(grammar.DROP, "").strip() or "."
        out.append((found, y))
    return out


def train(n_pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = 5) -> Labeller:
    """The labeller, fitted with Adam steps of falling size."""
    model, data, r = Labeller(), training_pages(n_pages, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    s = {k: np.zeros_like(v) for k, v in model.p.items()}
    total, step = epochs * -(-n_pages // BATCH), 0
    batches = []
    by_size = sorted(range(n_pages), key=lambda k: len(data[k][0]))
    for a in range(0, n_pages, BATCH):
        part = [data[k] for k in by_size[a : a + BATCH]]
        batches.append((Inputs([p for p, _ in part]), np.concatenate([y for _, y in part])))
    for _ in range(epochs):
        for k in r.permutation(len(batches)):
            step += 1
            rate = RATE * (1 - step / (total + 1))
            _, grads = model.gradients(*batches[k])
            for name, g in grads.items():
                m[name] = 0.9 * m[name] + 0.1 * g
                s[name] = 0.99 * s[name] + 0.01 * g * g
                model.p[name] -= rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.99**step)) + 1e-8)
    return model


def extract_text(
    pages: DataFrame, html_col: str = "html", threshold: float = 0.5, model: Labeller | None = None
) -> DataFrame:
    """All columns of ``pages`` but ``html_col``, and ``text`` (the article's blocks, one a line),
    ``n_chars`` and ``n_blocks`` (blocks of the whole page).

    A NULL or empty page, or one without an article, has an empty text. A column of ``pages`` with
    the name of an output column is replaced. The whole page is read, however long."""
    made = ("text", "n_chars", "n_blocks")
    kept = [c for c in pages.columns if c != html_col and c not in made]
    inner = small_batches(pages).select(*kept, F.col(html_col).cast("string").alias("__html"))
    weights = (model or train()).p
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[:-1]), "text string, n_chars long, n_blocks long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller()
        labeller.p = weights
        for batch in batches:
            for part in slices(batch, "__html"):
                found = [blocks(h) for h in text_of(part.column(len(kept))).to_pylist()]
                prob = labeller.probabilities(found)
                texts = ["\n".join(b.text for b, p in zip(f, q, strict=True) if p >= threshold) for f, q in zip(found, prob, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(k) for k in range(len(kept))),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([len(f) for f in found], pa.int64()),
                    ],
                    [*kept, *made],
                )

    return inner.mapInArrow(run, fields)
