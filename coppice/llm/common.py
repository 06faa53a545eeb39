"""Helpers the operators share: Arrow batches as flat numpy byte arrays, word hashes, tables kept
between stages, and per-worker caches.

All functions treat a NULL text as empty, take whole texts, and need memory in proportion to one
slice of a batch (``SLICE_BYTES``) or to one single text if that is longer.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 2 << 20
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
U = np.uint64
# Words beyond this length are hashed with a digest instead of byte by byte.
_LONG_WORD = 64
_GOLDEN = U(0x9E3779B97F4A7C15)


def per_worker(name: str, make: Callable):
    """``make()``, kept for the life of a Python worker. Task functions travel by value, so that
    the globals of this module last for one task only."""
    cache = sys.modules.setdefault("_coppice_worker", types.ModuleType("_coppice_worker")).__dict__
    if name not in cache:
        cache[name] = make()
    return cache[name]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Bytes of one Arrow batch. A task holds a batch in the JVM and in Python, there next to what it
# makes of it, so Spark's default of 64 MB takes several times that of an executor.
BATCH_BYTES = "8m"
_BATCH_KEY, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def small_batches(df: DataFrame) -> DataFrame:
    """``df`` itself, with the session's limit for Arrow batches lowered to ``BATCH_BYTES`` where it
    has its default value; a limit that was set stays. Results do not depend on it."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY, None) == _DEFAULT:
        conf.set(_BATCH_KEY, BATCH_BYTES)
    return df


def text_of(column) -> pa.Array:
    """A string column as one array without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``size`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    col = text_of(batch.column(batch.schema.names.index(text)))
    ends = np.cumsum(pc.binary_length(col).to_numpy(zero_copy_only=False).astype(np.int64))
    start, n = 0, batch.num_rows
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after the other, and where each text starts (one more at the end)."""
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if buffers[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_class(members: bytes, negate: bool = False) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return ~out if negate else out


def words(buf: np.ndarray, at: np.ndarray, inside: np.ndarray):
    """Maximal runs of bytes in the class ``inside`` that do not cross a text's border: where each
    starts and ends, and how many each text has."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at) - 1, np.int64)
    mask = inside[buf]
    border = at[(at > 0) & (at < len(buf))]
    before = np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    before[border] = False
    after = np.empty_like(mask)
    after[-1], after[:-1] = False, mask[1:]
    after[border - 1] = False
    starts, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, at))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection on 64 bits."""
    x = np.atleast_1d(x)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _byte_codes(lower: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each word; ``lower`` takes A-Z as a-z."""
    codes = _byte_codes(lower)
    size = ends - starts
    out = size.astype(np.uint64) * _GOLDEN
    which = np.flatnonzero(size <= _LONG_WORD)
    left, pos, h = size[which], starts[which], out[which]
    k = 0
    while len(which):
        more = left > k
        if not more.all():
            out[which[~more]] = h[~more]
            which, left, pos, h = which[more], left[more], pos[more], h[more]
        h = h * U(0x2545F4914F6CDD1D) + codes[buf[pos + k]] if len(which) else h
        k += 1
    for i in np.flatnonzero(size > _LONG_WORD):
        raw = buf[starts[i] : ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(raw.lower() if lower else raw, digest_size=8).digest(), "little")
    return mix(out)


def hash_windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes, also across texts."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, n, np.uint64) * _GOLDEN
    for k in range(n):
        out = mix(out + h[k : k + m])
    return out


def sets_of_shingles(texts: pa.Array, n: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``n``-word shingles, A-Z lower-cased, words
    between white space; of a text with fewer words its whole word sequence as one."""
    buf, at = flat(texts)
    starts, ends, counts = words(buf, at, byte_class(SPACE, negate=True))
    h = hash_words(buf, starts, ends, lower=True)
    wins = hash_windows(h, n)
    first = np.concatenate([[0], np.cumsum(counts)])
    out = []
    for i, c in enumerate(counts):
        a = first[i]
        if c >= n:
            s = np.sort(wins[a : a + c - n + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            out.append(hash_windows(h[a : a + c], int(c)) if c else np.zeros(0, np.uint64))
    return out
