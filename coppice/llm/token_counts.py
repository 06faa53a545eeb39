"""Token counts by rank-synchronous array merging (operator 3).

Texts are cut into pre-tokens as the tokenizer file says. The pre-tokens of an Arrow batch that the
worker has not met yet are held together as ragged arrays of symbol ids; each step finds every
sequence's lowest-ranked adjacent pair and merges it in all sequences at once, until none has a
pair left. What survives is counted, and a text's count is the sum over its pre-tokens.

Where all pairs that can arise from a merge rank behind it, all its places in a sequence are merged
in one step; otherwise only the first place is, which keeps the order of the library.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker, slices, small_batches, text_of

# Pre-tokens whose counts a worker keeps; the store is emptied when it is full.
KEPT = 1_000_000
_NONE = np.int64(1) << np.int64(40)
# The byte-level alphabet of these files: printable Latin-1 bytes stand for themselves, the others
# for the code points from 256 on. The three ranges are fixed values.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte."""
    rest = [b for b in range(256) if b not in _PRINTABLE]
    return {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(rest)}


class MergeTable:
    """Ranked merges as sorted arrays; built from a tokenizer file with a byte-level alphabet."""

    def __init__(self, spec: dict, pattern: str):
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.width = np.int64(max(vocab.values()) + 1)
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.made = made
        # Least rank at which a symbol is part of a pair: what its making can set off.
        used = np.full(int(self.width), _NONE)
        np.minimum.at(used, left, np.arange(len(pairs)))
        np.minimum.at(used, right, np.arange(len(pairs)))
        self.safe = used[made] > np.arange(len(pairs))
        self.byte = np.array([vocab[c] for _, c in sorted(byte_alphabet().items())], np.int64)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols that are left of each byte string."""
        size = np.array([len(p) for p in pieces], np.int64)
        out = size.copy()
        sym = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        seq = np.repeat(np.arange(len(pieces)), size)
        while len(sym):
            rank = self.ranks(sym[:-1], sym[1:])
            rank[seq[:-1] != seq[1:]] = _NONE
            heads = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            padded = np.concatenate([rank, [_NONE]])
            best = np.minimum.reduceat(padded, heads)
            length = np.diff(np.concatenate([heads, [len(sym)]]))
            alive = best < _NONE
            out[seq[heads]] = length
            if not alive.any():
                break
            low = np.repeat(best, length)
            hit = np.flatnonzero((padded == low) & (low < _NONE))
            # Of overlapping places every second one, from the left; of unsafe merges the first place.
            fresh = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (seq[hit[1:]] != seq[hit[:-1]])])
            starts = np.flatnonzero(fresh)
            nth = np.arange(len(hit)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(hit)]])))
            first = np.concatenate([[True], seq[hit[1:]] != seq[hit[:-1]]])
            hit = hit[np.where(self.safe[low[hit]], nth % 2 == 0, first)]
            sym[hit] = self.made[low[hit]]
            keep = np.repeat(alive, length)
            keep[hit + 1] = False
            sym, seq = sym[keep], seq[keep]
        return out

    def tokens(self, texts: list[str]) -> list[int]:
        """Tokens of each text; the texts' new pre-tokens are counted together."""
        cut, extra = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            extra.append(len(parts) - 1)
            cut.append([p for part in parts for p in self.pattern.findall(part)])
        new = list({p for pieces in cut for p in pieces if p not in self.known})
        if new:
            if len(self.known) + len(new) > KEPT:
                self.known.clear()
                new = list({p for pieces in cut for p in pieces})
            raw = [p.encode() for p in new]
            self.known.update(zip(new, self.count(raw).tolist(), strict=True))
        get = self.known.__getitem__
        return [n + sum(map(get, pieces)) for n, pieces in zip(extra, cut, strict=True)]


def load(path: str, pattern: str) -> MergeTable:
    with open(path, encoding="utf-8") as f:
        return MergeTable(json.load(f), pattern)


def token_counts(
    docs: DataFrame,
    path: str,
    pattern: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    A NULL or empty text has 0 bytes and 0 tokens; ids may be NULL or repeat, each row has its own
    result; other columns are not read. ``path`` names a byte-level BPE file of the ``tokenizers``
    format at the same place on every executor, ``pattern`` its pre-token pattern. Strings of the
    file's special tokens count as one token each."""
    docs = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = per_worker(f"merges:{path}:{pattern}", lambda: load(path, pattern))
        for batch in batches:
            for part in slices(batch, "text"):
                texts = text_of(part.column(1))
                n_bytes = pa.compute.binary_length(texts).cast(pa.int64())
                counts = pa.array(merges.tokens(texts.to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), n_bytes, counts], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema["id"].dataType.simpleString()
    counted = docs.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
