"""Balanced shards by Karmarkar-Karp differencing (operator 9).

Rows with equal texts are a group that stays together. A partial partition holds one total for each
shard. Differencing combines, again and again, the two partial partitions with the largest spread
(largest less smallest total), the larger totals of one with the smaller ones of the other. That
runs on Spark in two levels: groups are dealt into cells by hash, each cell differences its own
groups to one partial partition, and the cells' partial partitions, one short row each, are
differenced in the same way. The number of cells grows with the number of groups up to
``MAX_CELLS``; the driver sees the cells' totals only.

A group of more than an even share of a shard cannot be balanced whole: it is dealt by id into
equal pieces of at most ``1 / PIECES`` of a share. There are fewer than ``PIECES`` times as many of
these groups as shards, which bounds the list of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import written

GROUPS_PER_CELL, MAX_CELLS = 20_000, 4_096
# A split group's pieces are at most this part of an even share.
PIECES = 4
# Rows of a shard whose slots are counted in one task, and least number of such lots.
LOT_ROWS, MIN_LOTS = 500_000, 64


def difference(parts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Differences partial partitions (totals per shard) until one is left. Returns its totals and,
    for each part, where each of its shards went."""
    shards = len(parts[0])
    heap, nodes = [], []

    def push(totals: np.ndarray, children):
        nodes.append(children)
        heapq.heappush(heap, (-int(totals.max() - totals.min()), len(nodes) - 1, totals))

    for p in parts:
        push(np.asarray(p, np.int64), None)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        up, down = np.argsort(x, kind="stable"), np.argsort(-y, kind="stable")
        to = np.empty(shards, np.int64)
        to[down] = up
        total = x.copy()
        total[up] += y[down]
        push(total, (a, b, to))
    root = heap[0]
    place: list = [None] * len(nodes)
    place[root[1]] = np.arange(shards)
    for k in range(len(nodes) - 1, -1, -1):
        if nodes[k] is not None:
            a, b, to = nodes[k]
            place[a], place[b] = place[k], place[k][to]
    return root[2], place[: len(parts)]


def difference_sizes(sizes: list[int], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Differences single sizes; returns the totals and each size's shard."""
    parts = []
    for s in sizes:
        p = np.zeros(shards, np.int64)
        p[0] = s
        parts.append(p)
    totals, place = difference(parts)
    return totals, np.array([p[0] for p in place], np.int64)


def _one_cell(key, group, shards: int):
    """The groups of a cell with their local shards and, in the first row, the cell's totals."""
    group = group.sort_by([("bytes", "descending"), ("text_hash", "ascending"), ("piece", "ascending")])
    totals, local = difference_sizes(group.column("bytes").to_pylist(), shards)
    head = [totals.tolist()] + [None] * (group.num_rows - 1)
    return pa.table(
        {
            "cell": pa.array([key[0].as_py()] * group.num_rows, pa.int32()),
            "text_hash": group.column("text_hash"),
            "size": group.column("size"),
            "text_crc32": group.column("text_crc32"),
            "piece": group.column("piece"),
            "local": pa.array(local, pa.int32()),
            "totals": pa.array(head, pa.list_(pa.int64())),
        }
    )


def kk_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``size`` (bytes of the text and 16), ``text_crc32``, ``law`` (``bytes``),
    ``shard``, ``slot`` (gapless from 0 within a shard) and ``grown_shard`` (NULL under this law).

    A NULL text has no bytes and the checksum of an empty one, and shares its group. NULL and
    repeated ids keep one row each. An empty table gives no rows; shards may stay empty where there
    are fewer groups than shards. Other columns are not read. Group and cell tables are written to
    the folder of ``spark.checkpoint.dir``."""
    spark = docs.sparkSession
    raw = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit("").cast("binary"))
    rows, _ = written(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(raw).cast("long") + 16).alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.xxhash64(raw).alias("text_hash"),
        ).withColumn(
            # Rows without an id are told apart by their place, else one text's could not be split.
            "deal", F.xxhash64(F.coalesce(F.col("id").cast("string"), F.concat(F.lit("#"), F.monotonically_increasing_id())))
        ),
        "sizes",
    )
    same = ["text_hash", "size", "text_crc32"]
    groups, _ = written(rows.groupBy(*same).agg(F.count("*").alias("n")), "groups")
    total, n_groups, n_rows = groups.agg(F.sum(F.col("n") * F.col("size")), F.count("*"), F.sum("n")).first()
    n_lots = max(MIN_LOTS, (n_rows or 0) // (shards * LOT_ROWS))
    share = max(1, (total or 0) // shards)
    # Fewer than shards groups can hold more than a share each, so this table is small.
    large = groups.where(F.col("n") * F.col("size") > share).select(
        *same, F.least(F.col("n"), F.ceil(F.col("n") * F.col("size") * PIECES / share)).cast("int").alias("pieces")
    )
    large = F.broadcast(spark.createDataFrame(large.limit(shards).collect(), large.schema))
    dealt = rows.join(large, same, "left").withColumn(
        "piece", F.coalesce(F.pmod("deal", F.col("pieces")).cast("int"), F.lit(0))
    ).drop("pieces")
    pieces = dealt.groupBy(*same, "piece").agg(F.sum("size").alias("bytes"))
    cells = min(MAX_CELLS, max(1, -(-(n_groups or 0) // GROUPS_PER_CELL)))
    local, _ = written(
        pieces.withColumn("cell", F.pmod(F.xxhash64("text_hash", "piece"), F.lit(cells)).cast("int"))
        .groupBy("cell")
        .applyInArrow(
            lambda key, group: _one_cell(key, group, shards),
            "cell int, text_hash long, size long, text_crc32 long, piece int, local int, totals array<long>",
        ),
        "cells",
    )
    partial = sorted((r.cell, r.totals) for r in local.where("totals IS NOT NULL").select("cell", "totals").collect())
    places = difference([np.array(t, np.int64) for _, t in partial])[1] if partial else []
    # At most MAX_CELLS rows.
    final = spark.createDataFrame(
        [(cell, [int(v) for v in place]) for (cell, _), place in zip(partial, places, strict=True)], "cell int, place array<int>"
    )
    named = local.join(F.broadcast(final), "cell").select(*same, "piece", F.get("place", F.col("local")).alias("shard"))
    placed = dealt.join(named, [*same, "piece"]).withColumn("lot", F.pmod("deal", F.lit(n_lots)).cast("int"))
    placed, _ = written(placed.select("id", "size", "text_crc32", "deal", "shard", "lot"), "placed")
    lots = placed.groupBy("shard", "lot").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("lot")) - F.col("n")
    lots = lots.select("shard", "lot", before.alias("offset"))
    within = F.row_number().over(Window.partitionBy("shard", "lot").orderBy("id", "deal", "text_crc32"))
    return (
        placed.withColumn("rank", within)
        .join(F.broadcast(lots), ["shard", "lot"])
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
