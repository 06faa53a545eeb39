"""Exact n-gram Jaccard join by universe partitioning (operator 1).

Two texts link when the Jaccard similarity of their shingle sets reaches ``num / den``. Sets
``x``, ``y`` of sizes ``s <= t`` then differ in at most ``(s + t)(den - num)/(den + num)`` shingles.
Within a size band the universe of shingles is dealt into ``m`` segments by hash. A probe (the
larger set of a pair) gives every segment an allowance ``a`` of 0, 1 or 2 that sums to more than
that bound, so that by the pigeonhole principle some segment differs in at most ``a - 1`` shingles:
``a = 1`` looks the segment's whole content up, ``a = 2`` also every content with one shingle
deleted, ``a = 0`` nothing. Long contents are cheap, because few sets share them, so allowances go
to the longest first and short or empty segments are left out. The smaller set is indexed in each
band in which a partner may probe: each segment's content, and the one-deletion neighbourhoods of
those long enough to be asked for.

Hot groups. Equal sets have one class id, a hash of the set, and meet as one. Sets under one
signature are not paired with each other but with one of them, the one that shares signatures with
most other sets: of a text and its edited copies that is the text itself. Pairs are verified on the
whole sets and give components. Only where a signature still holds several components are their
cross pairs looked at, and of those only pairs that pass exact lower bounds on the difference (of
sizes, and of parities of the shingles in hashed cells) are emitted; a signature with many members
is dealt out in blocks.

Rows: a NULL or empty text, or one without words, has an empty set and links with nothing.
Repeated ids and NULL ids keep one row each; the component id is the least id that is not NULL.
Shingles and classes are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import U, mix, sets_of_shingles, slices, small_batches, text_of
from .components import components

# Least content size at which a segment may get the allowance 2.
DELETION_SIZE = 9
# Postings that one bucket holds on average.
BUCKET_POSTINGS = 400_000
# Class ids that a task remembers, so as not to post a set again.
KEPT_CLASSES = 200_000
# Members of a signature that meet in one task in the second pass.
BLOCK = 2_048
_PROBE, _DELETED = 1, 2


def bands(top: int, num: int, den: int) -> list[tuple[int, int, int]]:
    """Size bands ``[low, high)`` up to size ``top`` with their number of segments, which leaves a
    probe a few segments to skip beyond the one more than the bound that it needs."""
    out, low = [], 1
    while low <= top:
        high = max(low + 1, -(-low * 3 // 2))
        need = 2 * (high - 1) * (den - num) // (den + num) + 1
        out.append((low, high, need + (need + 19) // 20 + 1))
        low = high
    return out


def class_id(s: np.ndarray) -> np.int64:
    """Hash of a whole set; 0 for the empty one."""
    if not len(s):
        return np.int64(0)
    h = mix(np.bitwise_xor.reduce(mix(s), keepdims=True) + mix(np.add.reduce(s, keepdims=True) + U(len(s))))[0]
    return h.view(np.int64) if h else np.int64(1)


def parities(s: np.ndarray) -> bytes:
    """Whether each hashed cell holds an odd number of shingles, as bits; two to four cells for each
    shingle, a power of two. Sets that differ in ``d`` shingles differ in at most ``d`` bits."""
    cells = 64
    while cells < 2 * len(s):
        cells *= 2
    odd = np.bincount((s & U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of bit words brought to ``width`` words: what the smaller number of cells gives."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    width = min(a.shape[-1], b.shape[-1])
    return np.bitwise_count(fold(a, width) ^ fold(b, width)).sum(-1, dtype=np.int64)


def _segments(tokens: np.ndarray, doc: np.ndarray, n_docs: int, band: int, m: int):
    """Per document and segment: number of shingles and sum of their hashes; and each shingle's cell."""
    salt = mix(np.array([band + 1], np.uint64))[0]
    cell = doc * m + (((mix(tokens + salt) >> U(32)) * U(m)) >> U(32)).astype(np.int64)
    code = mix(tokens ^ salt)
    sums = np.zeros(n_docs * m, np.uint64)
    order = np.argsort(cell, kind="stable")
    if len(order):
        at = cell[order]
        heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        sums[at[heads]] = np.add.reduceat(code[order], heads)
    return np.bincount(cell, minlength=n_docs * m), sums, cell, code


def allowances(counts: np.ndarray, sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Allowance of each segment of each probe: the longest segments first, 2 from
    ``DELETION_SIZE`` shingles on and else 1, until they sum to more than the bound."""
    need = 2 * sizes * (den - num) // (den + num) + 1
    order = np.argsort(-counts, axis=1, kind="stable")
    worth = np.where(np.take_along_axis(counts, order, 1) >= DELETION_SIZE, 2, 1)
    given = np.where(np.cumsum(worth, 1) - worth < need[:, None], worth, 0)
    out = np.empty_like(given)
    np.put_along_axis(out, order, given, 1)
    return out


def signatures(sets: list[np.ndarray], ids: np.ndarray, num: int, den: int):
    """Postings of the sets: signature, class id and flags. Equal sets give equal postings."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if not len(sizes) or not sizes.max():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    keys, who, flags = [], [], []
    for band, (low, high, m) in enumerate(bands(int(sizes.max()) * den // num, num, den)):
        # Own sets of the band, and smaller ones whose largest partner reaches it.
        here = np.flatnonzero((sizes < high) & (sizes * den // num >= low) & (sizes > 0))
        if not len(here):
            continue
        tokens = np.concatenate([sets[i] for i in here])
        doc = np.repeat(np.arange(len(here)), sizes[here])
        counts, sums, cell, code = _segments(tokens, doc, len(here), band, m)
        own = sizes[here] >= low
        a = np.zeros((len(here), m), np.int64)
        if own.any():
            a[own] = allowances(counts.reshape(-1, m)[own], sizes[here][own], num, den)
        a = a.ravel()
        place = mix(np.arange(m, dtype=np.uint64) + (U(band + 1) << U(32)))
        cells = np.arange(len(here) * m)
        keys.append(mix(sums + place[cells % m]))
        who.append(ids[here[cells // m]])
        flags.append(np.where(a > 0, _PROBE, 0))
        # One shingle deleted: asked for by allowance 2, indexed where such a probe can reach.
        cut = np.flatnonzero((a[cell] == 2) | (counts[cell] > DELETION_SIZE))
        keys.append(mix(sums[cell[cut]] - code[cut] + place[cell[cut] % m]))
        who.append(ids[here[doc[cut]]])
        flags.append(np.where(a[cell[cut]] == 2, _PROBE | _DELETED, _DELETED))
    return np.concatenate(keys), np.concatenate(who), np.concatenate(flags).astype(np.uint64)


def _describe(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = sets_of_shingles(text_of(part.column(1)), n)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_id(s) for s in sets], pa.int64()),
                    pa.array([parities(s) for s in sets], pa.binary()),
                ],
                ["id", "n_shingles", "cls", "cells"],
            )


def _postings(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int, buckets: int):
    """Postings dealt by signature; one packed row per bucket and slice. Copies of a set that the
    task has met give nothing again, so that a large group of copies costs one set per task."""
    met: set[int] = set()
    for batch in batches:
        for part in slices(batch, "text"):
            unique = {}
            for s in sets_of_shingles(text_of(part.column(1)), n):
                if (cls := int(class_id(s))) not in met:
                    unique[cls] = s
            if len(met) > KEPT_CLASSES:
                met.clear()
            met.update(unique)
            key, who, flag = signatures(list(unique.values()), np.array(list(unique), np.int64), num, den)
            bucket = (((key >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            value = (((key & U(0x3FFFFFFF)) << U(2)) | flag).astype(np.uint32)[order]
            who, bucket = who[order], bucket[order]
            heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
            ends = [*heads[1:], len(bucket)] if len(bucket) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bucket[h] for h in heads], pa.int64()),
                    pa.array([who[h:e].tobytes() for h, e in zip(heads, ends, strict=True)], pa.binary()),
                    pa.array([value[h:e].tobytes() for h, e in zip(heads, ends, strict=True)], pa.binary()),
                ],
                ["bucket", "who", "value"],
            )


def _meet(key, group):
    """Of one bucket: the pairs (run -1) that have a signature to themselves, and the members of
    signatures with more sets, each with their number. Signatures without a probe are left out."""
    who = np.frombuffer(b"".join(group.column("who").to_pylist()), np.int64)
    value = np.frombuffer(b"".join(group.column("value").to_pylist()), np.uint32)
    sig, flag = value >> np.uint32(2), (value & np.uint32(3)).astype(np.uint8)
    order = np.lexsort((who, sig))
    sig, who, flag = sig[order], who[order], flag[order]
    new = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (who[1:] != who[:-1])]))
    probe = np.maximum.reduceat(flag & _PROBE, new) > 0
    whole = np.minimum.reduceat(flag & _DELETED, new) == 0
    sig, who = sig[new], who[new]
    heads = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    size = np.diff(np.concatenate([heads, [len(sig)]]))
    live = (size > 1) & np.logical_or.reduceat(probe, heads) & np.logical_or.reduceat(whole, heads)
    pair, many = heads[live & (size == 2)], np.repeat(live & (size > 2), size)
    run = (np.int64(key[0].as_py()) << np.int64(30)) | sig[many].astype(np.int64)
    return pa.table(
        {
            "run": pa.array(np.concatenate([np.full(len(pair), -1, np.int64), run])),
            "a": pa.array(np.concatenate([who[pair], who[many]])),
            "b": pa.array(np.concatenate([who[pair + 1], np.repeat(size, size)[many]])),
        }
    )


def _close(group, first: np.ndarray, second: np.ndarray | None, num: int, den: int):
    """Pairs of two blocks of one run, or within one, of different components, that the bounds
    leave. The block whose rows are walked leaves its commonest component out where it can."""
    cls, comp = group.column("cls").to_numpy(), group.column("comp").to_numpy()
    size = group.column("n_shingles").to_numpy()
    raw = group.column("cells").to_pylist()
    width = np.array([len(r) for r in raw])
    words_of = {
        w: (np.flatnonzero(width == w), np.frombuffer(b"".join(r for r in raw if len(r) == w), np.uint64).reshape(-1, w // 8))
        for w in np.unique(width)
    }
    walk, other = first, np.ones(len(cls), bool)
    if second is not None:
        other = np.zeros(len(cls), bool)
        other[second] = True
    else:
        names, counts = np.unique(comp, return_counts=True)
        walk = first[comp[first] != names[np.argmax(counts)]]
    out = []
    for i in walk:
        mine = np.frombuffer(raw[i], np.uint64)
        for rows, bits in words_of.values():
            total = size[i] + size[rows]
            ok = other[rows] & (comp[rows] != comp[i]) & (np.abs(size[rows] - size[i]) * (den + num) <= total * (den - num))
            if ok.any():
                at = np.flatnonzero(ok)
                at = at[bits_apart(bits[at], mine) * (den + num) <= total[at] * (den - num)]
                out += [(min(cls[i], c), max(cls[i], c)) for c in cls[rows[at]]]
    return out


def _cross(key, group, num, den):
    """Cross pairs of one block, or of one pair of blocks, of a run."""
    _, i, j = (k.as_py() for k in key)
    block = group.column("block").to_numpy()
    first, second = np.flatnonzero(block == i), np.flatnonzero(block == j)
    pairs = sorted(set(_close(group, first, None if i == j else second, num, den)))
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def _whole_sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = sets_of_shingles(text_of(part.column(1)), n)
            cls = np.array([class_id(s) for s in sets], np.int64)
            keep = np.flatnonzero(cls == part.column(0).to_numpy())
            at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in keep])]).astype(np.int32)
            held = np.concatenate([sets[i] for i in keep]) if len(keep) else np.zeros(0, np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(held.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(cls[keep]), lists], ["cls", "shingles"])


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links among candidate pairs: size and count bounds first, then the whole sets of the classes
    that are left, made from one text of each."""
    side = lambda k: classes.select(F.col("cls").alias(k), F.col("n_shingles").alias(f"n{k}"), F.col("cells").alias(f"v{k}"))

    def bound(batches):
        for batch in batches:
            c = {k: batch.column(i) for i, k in enumerate(batch.schema.names)}
            total = c["na"].to_numpy() + c["nb"].to_numpy()
            near = np.abs(c["na"].to_numpy() - c["nb"].to_numpy()) * (den + num) <= total * (den - num)
            for k in np.flatnonzero(near):
                x, y = (np.frombuffer(c[v][int(k)].as_buffer(), np.uint64) for v in ("va", "vb"))
                near[k] = bits_apart(x, y) * (den + num) <= total[k] * (den - num)
            ok = pa.array(near)
            yield pa.RecordBatch.from_arrays([c["a"], c["b"]], ["a", "b"]).filter(ok)

    left = pairs.distinct().join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "va", "vb")
    left, _ = written(left.mapInArrow(bound, "a long, b long"), "pairs")
    wanted = left.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = wanted.join(classes.select("cls", "rep"), "cls")
    sets = docs.join(wanted, docs["id"].eqNullSafe(wanted["rep"])).select("cls", "text")
    sets, _ = written(
        sets.mapInArrow(lambda it: _whole_sets(it, n), "cls long, shingles array<long>").dropDuplicates(["cls"]), "sets"
    )
    full = left.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a")
    full = full.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b")
    full = full.withColumn("common", F.size(F.array_intersect("x", "y")))
    alike = den * F.col("common") >= num * (F.size("x") + F.size("y") - F.col("common"))
    return written(full.where(alike).select("a", "b"), "links")[0]


def _first_pairs(met: DataFrame) -> DataFrame:
    """Pairs with a signature to themselves, and of every other signature its members with the one
    among them that meets most other sets."""
    runs = met.where("run >= 0").select("run", F.col("a").alias("cls"), F.col("b").alias("size"))
    weight = runs.groupBy("cls").agg(F.sum("size").alias("weight"))
    hubs = runs.join(weight, "cls").groupBy("run").agg(F.max(F.struct("weight", "cls"))["cls"].alias("hub"))
    spokes = runs.join(hubs, "run").where("cls != hub")
    spokes = spokes.select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b"))
    return met.where("run < 0").select("a", "b").union(spokes)


def _second_pairs(runs: DataFrame, comp: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of different components under one signature, block by block."""
    known = runs.join(comp, F.col("a") == comp["node"], "left").select(
        "run", F.col("a").alias("cls"), F.coalesce("component", "a").alias("comp")
    )
    mixed = known.groupBy("run").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
    mixed = mixed.where("lo < hi").select("run", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = known.join(mixed, "run").join(classes.select("cls", "n_shingles", "cells"), "cls")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).select(
        "run", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "cls", "comp", "n_shingles", "cells",
    )
    return rows.groupBy("run", "i", "j").applyInArrow(
        lambda key, group: _cross(key, group, num, den), "a long, b long"
    )


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 4, den: int = 5
) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` of every row (see the module). Two texts link
    when ``den`` times the intersection is at least ``num`` times the union of their sets of
    ``n``-word shingles. Intermediate tables go to the folder of ``spark.checkpoint.dir``."""
    docs = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = docs.schema["id"].dataType
    described, _ = written(
        docs.mapInArrow(
            lambda it: _describe(it, n), f"id {id_type.simpleString()}, n_shingles long, cls long, cells binary"
        ),
        "shingles",
    )
    classes, _ = written(
        described.where("n_shingles > 0").groupBy("cls").agg(
            F.min("id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("cells").alias("cells")
        ),
        "classes",
    )
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, total * 9 * (den - num) // (2 * (den + num)) // BUCKET_POSTINGS)
    met = docs.mapInArrow(
        lambda it: _postings(it, n, num, den, buckets), "bucket long, who binary, value binary"
    ).groupBy("bucket").applyInArrow(_meet, "run long, a long, b long")
    met, _ = written(met, "met")
    first = _verified(_first_pairs(met), classes, docs, n, num, den)
    comp = components(first)
    second = _verified(_second_pairs(met.where("run >= 0"), comp, classes, num, den), classes, docs, n, num, den)
    comp = components(first.union(second))
    # Least id of each component: through the classes, so that a class with many rows counts once.
    linked = comp.join(classes, F.col("node") == F.col("cls"), "right").select(
        "cls", "rep", F.coalesce("component", "cls").alias("component")
    )
    least_id = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = linked.join(least_id, "component").select("cls", "component_id")
    return described.join(named, "cls", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.coalesce("component_id", "id").alias("component_id"),
    )
