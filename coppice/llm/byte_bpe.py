"""Byte-level BPE encoding and decoding (operator 5).

A rank file is turned into a model of the ``tokenizers`` library: each byte is mapped to its
character, and every way to join two entries to a third becomes a merge in order of that third's
rank. The distinct pre-tokens of an Arrow batch are encoded in one call; a text's ids and offsets
are put together from them. Offsets count bytes; :func:`char_offsets` turns them into characters,
where a token that begins inside a character starts at that character. Decoding reverses the byte
table, joins the bytes, and so restores characters that were split between tokens; bytes that are
no UTF-8 (a cut id sequence) come back as U+FFFD in the text and unchanged in the bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, StructType

from .common import flat, per_worker, slices, small_batches, text_of
from .token_counts import byte_alphabet

# Ids that one output batch holds at most, or one text's.
BATCH_IDS = 1 << 18
# Pre-tokens whose ids a worker keeps, emptied when full, and that one call of the library gets.
KEPT, _CALL = 200_000, 10_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Encoder:
    """Text to ids, by the ``tokenizers`` library."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        letter = byte_alphabet()
        shown = {token: "".join(letter[b] for b in token) for token in ranks}
        merges = sorted(
            (rank, shown[token[:k]], shown[token[k:]])
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        )
        model = models.BPE({shown[t]: r for t, r in ranks.items()}, [m[1:] for m in merges], ignore_merges=True)
        self.model = Tokenizer(model)
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern = regex.compile(pattern)
        # Ids of a pre-token as the bytes of 32-bit numbers.
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the texts' new pre-tokens go to the library in one call."""
        cut = [self.pattern.findall(t) for t in texts]
        new = list({p for pieces in cut for p in pieces if p not in self.known})
        if new:
            if len(self.known) + len(new) > KEPT:
                self.known.clear()
                new = list({p for pieces in cut for p in pieces})
            for start in range(0, len(new), _CALL):
                part = new[start : start + _CALL]
                found = self.model.encode_batch_fast(part, add_special_tokens=False)
                self.known.update((p, np.array(e.ids, np.int32).tobytes()) for p, e in zip(part, found, strict=True))
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, pieces)), np.int32) for pieces in cut]


class Decoder:
    """Ids to bytes, by the reversed byte table."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        by_id = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        self.length = np.array([len(t) for t in by_id], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids one after the other."""
        size = self.length[ids]
        at = np.cumsum(size) - size
        return self.bytes[np.repeat(self.start[ids] - at, size) + np.arange(int(size.sum()))]


def char_offsets(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Index of the character that holds each byte position of a UTF-8 text (its length at the end)."""
    first = np.concatenate([np.cumsum((text & 0xC0) != 0x80), [0]])
    first[-1] = first[-2] + 1 if len(text) else 1
    return first[at] - 1


def _encoder(path: str, pattern: str) -> Encoder:
    return per_worker(f"encoder:{path}:{pattern}", lambda: Encoder(path, pattern))


def _decoder(path: str) -> Decoder:
    return per_worker(f"decoder:{path}", lambda: Decoder(path))


def _lists(sizes: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))


def _parts(ids: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for k, one in enumerate(ids):
        if k > start and held + len(one) > BATCH_IDS:
            yield start, k
            start, held = k, 0
        held += len(one)
    if start < len(ids):
        yield start, len(ids)


def encode(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", offsets: bool = False, round_trip: bool = False
) -> DataFrame:
    """All columns of ``docs`` but ``text_col``, and ``ids``; with ``offsets`` also ``char_start``,
    the character of the text at which each token starts; with ``round_trip`` also whether the ids,
    decoded, are the text again, byte for byte. A column of ``docs`` with the name of an
    output column is replaced. A NULL or empty text has no ids. ``path`` and ``pattern`` name a rank
    file and its pre-token pattern; each match of the pattern is encoded by itself."""
    made = ["ids"] + ["char_start"] * offsets + ["round_trip"] * round_trip
    kept = [c for c in docs.columns if c not in (text_col, *made)]
    inner = small_batches(docs).select(*kept, F.col(text_col).cast("string").alias("__text"))
    schema = StructType(inner.schema.fields[:-1]).add("ids", ArrayType(IntegerType()))
    if offsets:
        schema = schema.add("char_start", ArrayType(IntegerType()))
    if round_trip:
        schema = schema.add("round_trip", BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(path, pattern), _decoder(path)
        for batch in batches:
            for part in slices(batch, "__text"):
                texts = text_of(part.column(len(kept)))
                ids = encoder.encode(texts.to_pylist())
                buf, at = flat(texts)
                for a, b in _parts(ids):
                    sizes = np.array([len(x) for x in ids[a:b]], np.int64)
                    values = np.concatenate(ids[a:b])
                    cols = [part.column(k).slice(a, b - a) for k in range(len(kept))] + [_lists(sizes, values, pa.int32())]
                    if offsets:
                        starts, done = [], 0
                        for k, n in zip(range(a, b), sizes, strict=True):
                            size = decoder.length[values[done : done + n]]
                            starts.append(char_offsets(buf[at[k] : at[k + 1]], np.cumsum(size) - size))
                            done += n
                        cols.append(_lists(sizes, np.concatenate(starts), pa.int32()))
                    if round_trip:
                        same = [np.array_equal(decoder.decode(ids[k]), buf[at[k] : at[k + 1]]) for k in range(a, b)]
                        cols.append(pa.array(same, pa.bool_()))
                    yield pa.RecordBatch.from_arrays(cols, schema.names)

    return inner.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """All columns of ``encoded``, and ``decoded_bytes`` (binary) and ``decoded`` (text) made from
    the ids; NULL ids give empty ones. Ids outside the file raise."""
    kept = [c for c in encoded.columns if c not in ("decoded_bytes", "decoded")]
    inner = small_batches(encoded).select(*kept)
    schema = StructType([*inner.schema.fields]).add("decoded_bytes", BinaryType())
    where = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _decoder(path)
        for batch in batches:
            lists = batch.column(where)
            sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes, dtype=np.int64)
            start = 0
            while start < len(sizes):
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + BATCH_IDS, side="right")))
                ids = pa.compute.list_flatten(lists.slice(start, stop - start)).to_numpy(zero_copy_only=False)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(codec.length)):
                    raise ValueError("an id is not in the rank file")
                raw = codec.decode(ids)
                per_id = np.concatenate([[0], np.cumsum(codec.length[ids])])
                cuts = per_id[np.concatenate([[base], ends[start:stop]]) - base].astype(np.int32)
                out = pa.Array.from_buffers(
                    pa.binary(), stop - start, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw))]
                )
                cols = [batch.column(k).slice(start, stop - start) for k in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*cols, out], schema.names)
                start = stop

    out = inner.mapInArrow(run, schema)
    return out.withColumn("decoded", F.make_valid_utf8(F.col("decoded_bytes").cast("string")))
