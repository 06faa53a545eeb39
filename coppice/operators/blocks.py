"""Training rows packed into blocks.

A boosting pass reads every row many times and needs only four things of it: bins,
label, margins and the sampling hash. One row of a block table holds these for some
thousands of training rows, as contiguous bytes. Moving a block between Spark and
numpy costs about as much as moving one row would, and the cached table is compact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ARROW_ROWS, READ_ROWS, own_session

BLOCKS = "is_train BOOLEAN, n INT, bins BINARY, label BINARY, row_hash BINARY, margin BINARY"
FIXED = ("is_train", "n", "bins", "label", "row_hash")
# Blocks that Python gets at once. Spark counts rows of an Arrow batch, and one of these is thousands of
# training rows: by the usual setting a batch would be all of a task.
BATCH_BLOCKS = 16
# Bytes of a block with its margins, at most about. Many blocks are held at once where they are read, cached
# or sent, so that it is their size, and not the number of rows, that memory depends on.
BLOCK_BYTES = 128 << 10
# How tables of blocks are written. By itself Parquet looks at the size of a page and of a row group no sooner
# than after 100 rows, here blocks, and holds 128 MB of a group.
WRITTEN = {"parquet.block.size": str(32 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}


def read_blocks(table: DataFrame, path: str) -> DataFrame:
    """The written blocks ``table``, read in a session of their own, where a Python worker and the reader of a
    file hold ``BATCH_BLOCKS`` of them at a time, however many its task has."""
    own = own_session(table.sparkSession)
    own.conf.set(ARROW_ROWS, BATCH_BLOCKS)
    own.conf.set(READ_ROWS, BATCH_BLOCKS)
    return own.read.schema(table.schema).parquet(path)


def block_rows(n_features: int, n_bins: int, n_margins: int) -> int:
    """Training rows of a block of ``BLOCK_BYTES``."""
    return max(1, BLOCK_BYTES // (n_features * bin_type(n_bins).itemsize + 12 + 8 * n_margins))


def bin_type(n_bins: int) -> np.dtype:
    """Smallest unsigned type for bin numbers below ``n_bins``."""
    return np.dtype(np.uint8 if n_bins <= 256 else np.uint16)


@dataclass
class Block:
    """``bins`` is (features, rows); ``margin`` is (rows, trees), zeros before round 0."""

    bins: np.ndarray
    label: np.ndarray
    row_hash: np.ndarray
    margin: np.ndarray


def joined(blocks: list[Block]) -> Block:
    """Blocks joined to one."""
    if len(blocks) == 1:
        return blocks[0]
    take = lambda name, axis=0: np.concatenate([getattr(b, name) for b in blocks], axis=axis)
    return Block(take("bins", 1), take("label"), take("row_hash"), take("margin"))


def lists(values: np.ndarray) -> pa.Array:
    """2-D array as a list column."""
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(values).ravel())


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """List column of equal lengths as a 2-D array, without copying its values."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def to_blocks(rows: DataFrame, n_features: int, n_bins: int) -> DataFrame:
    """Pack ``is_train, label, row_hash, bins`` and, if there is one, a ``margin`` array.
    A block holds rows of one partition and of one split."""
    kind = bin_type(n_bins)
    with_margin = "margin" in rows.columns
    cols = ["is_train", "label", "row_hash", "bins"] + (["margin"] if with_margin else [])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            train = batch.column("is_train").to_numpy(zero_copy_only=False).astype(bool)
            bins = matrix(batch.column("bins"), n_features).astype(kind)
            label = batch.column("label").to_numpy().astype(np.int32)
            hashes = batch.column("row_hash").to_numpy().astype(np.int64)
            if with_margin:
                flat = batch.column("margin")
                margin = matrix(flat, len(flat.flatten()) // len(flat)).astype(np.float64)
            out = []
            for flag in (True, False):
                at = np.flatnonzero(train == flag)
                if len(at):
                    out.append((
                        flag, len(at), np.ascontiguousarray(bins[at].T).tobytes(), label[at].tobytes(),
                        hashes[at].tobytes(), margin[at].tobytes() if with_margin else b"",
                    ))
            kinds = [pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            arrays = [pa.array(values, k) for values, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*FIXED, "margin"])

    return rows.select(*cols).mapInArrow(pack, BLOCKS)


# Rows before they are binned: ``features`` as (features, rows) of the element type; ``labels`` the
# different ones, ``unlabelled`` rows without one, ``narrow`` and ``wide`` the least and greatest width.
RAW = (
    "is_train BOOLEAN, n INT, features BINARY, label BINARY, row_hash BINARY, "
    "labels ARRAY<INT>, unlabelled INT, narrow INT, wide INT"
)


def to_raw_blocks(rows: DataFrame) -> DataFrame:
    """Pack ``is_train, label, row_hash, features``, without their values where rows have not the same
    number of features. A NULL array has the width 0, a NULL entry is NaN, a missing label -1."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            train = batch.column("is_train").to_numpy(zero_copy_only=False).astype(bool)
            lists = batch.column("features")
            width = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            even = (width == width[0]).all()
            x = matrix(lists, width[0]) if even and width[0] else None
            missing = batch.column("label").is_null().to_numpy(zero_copy_only=False)
            label = pc.fill_null(batch.column("label"), -1).to_numpy().astype(np.int32)
            hashes = batch.column("row_hash").to_numpy().astype(np.int64)
            out = []
            for flag in (True, False):
                at = np.flatnonzero(train == flag)
                if len(at):
                    values = np.ascontiguousarray(x[at].T).tobytes() if x is not None else b""
                    out.append((
                        flag, len(at), values, label[at].tobytes(), hashes[at].tobytes(), np.unique(label[at][~missing[at]]),
                        int(missing[at].sum()), int(width[at].min()), int(width[at].max()),
                    ))
            kinds = [pa.bool_(), pa.int32(), *[pa.binary()] * 3, pa.list_(pa.int32()), *[pa.int32()] * 3]
            arrays = [pa.array(values, k) for values, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in RAW.split(", ")])

    return rows.select("is_train", "label", "row_hash", "features").mapInArrow(pack, RAW)


def raw_columns(kind: np.dtype) -> Callable[[pa.RecordBatch], Iterator[list[np.ndarray]]]:
    """The feature columns of each raw block of a batch (``n, features``)."""

    def read(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
        for n, values in zip(batch.column("n").to_pylist(), batch.column("features")):
            yield list(np.frombuffer(values.as_buffer(), kind).reshape(-1, n))

    return read


def bin_blocks(raw: DataFrame, cuts: list[list[float]], kind: np.dtype, rows: int) -> DataFrame:
    """Raw blocks as blocks of at most ``rows`` rows: the bins of all features by their edges, margins empty."""
    n_bins = max(len(c) for c in cuts) + 2
    read, edges = raw_columns(kind), [np.array(c) for c in cuts]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = zip(*(batch.column(c) for c in ("is_train", "n", "label", "row_hash")))
            for columns, (flag, n, label, hashes) in zip(read(batch), rest):
                x = np.array([np.where(np.isnan(v), 0, np.searchsorted(c, v, "right") + 1) for c, v in zip(edges, columns)])
                x = x.astype(bin_type(n_bins))
                y, z = np.frombuffer(label.as_buffer(), np.int32), np.frombuffer(hashes.as_buffer(), np.int64)
                out = []
                for a in range(0, n.as_py(), rows):
                    part = slice(a, a + rows)
                    out.append((flag.as_py(), len(y[part]), x[:, part].tobytes(), y[part].tobytes(), z[part].tobytes(), b""))
                kinds = [pa.bool_(), pa.int32(), *[pa.binary()] * 4]
                arrays = [pa.array(values, k) for values, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*FIXED, "margin"])

    return raw.select("is_train", "n", "features", "label", "row_hash").mapInArrow(pack, BLOCKS)


def unpack(batch: pa.RecordBatch | dict, n_features: int, n_bins: int, n_trees: int) -> Iterator[Block]:
    """The blocks of an Arrow batch (or of a dict of its columns), as views of its buffers."""
    column = batch.column if isinstance(batch, pa.RecordBatch) else batch.__getitem__
    bins, label, hashes, margin = (column(c) for c in ("bins", "label", "row_hash", "margin"))

    def view(array: pa.Array, i: int, dtype) -> np.ndarray:
        return np.frombuffer(array[i].as_buffer(), dtype)

    for i in range(len(bins)):
        y = view(label, i, np.int32)
        m = view(margin, i, np.float64)
        yield Block(
            view(bins, i, bin_type(n_bins)).reshape(n_features, len(y)),
            y,
            view(hashes, i, np.int64),
            m.reshape(len(y), n_trees) if len(m) else np.zeros((len(y), n_trees)),
        )


def from_blocks(blocks: DataFrame, n_trees: int) -> DataFrame:
    """One row per training row again: ``label, margin``."""

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = np.concatenate([np.frombuffer(b.as_buffer(), np.int32) for b in batch.column("label")])
            m = np.concatenate([np.frombuffer(b.as_buffer(), np.float64) for b in batch.column("margin")])
            yield pa.RecordBatch.from_arrays([pa.array(y), lists(m.reshape(len(y), n_trees))], names=["label", "margin"])

    return blocks.select("label", "margin").mapInArrow(open_, "label INT, margin ARRAY<DOUBLE>")


def without_margin(blocks: DataFrame) -> DataFrame:
    """Blocks as they are before round 0: no margins, no losses yet."""
    return blocks.select(
        *FIXED, F.lit(bytearray()).alias("margin"), F.array().cast("array<double>").alias("loss")
    )
