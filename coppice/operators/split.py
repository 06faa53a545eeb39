"""Exact seeded subsample and stratified train/test split.

Rows are ranked by the md5 of ``seed:key``; the smallest ranks are taken. A rank
inside each class would put a class into one task, so the rank is never computed for
all rows: counting rows by the first hex digits of the digest gives the digits at
which the quota of a class is reached. While many rows share exactly these digits, the
next ones are counted among them; the few that are left are ordered. What remains is one
digest per class, and the split is a row-local comparison with it.

Rows without a label, and rows of a class that the split does not know, take no seat and
are never trained on; they are marked ``unlabelled``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.hashing import seeded_md5
from ..session import written

# Hex digits counted in one step, and rows of one class that are ordered at the end.
_DIGITS = 4
ORDER_ROWS = 1_000_000


def test_quota(counts: DataFrame, label: str, test_size: float) -> DataFrame:
    """Test rows per class from ``(label, n)``: ``ceil(test_size * N)`` seats in all,
    each class its floor share, the left-over seats by largest remainder, ties to the
    lower label. Decimal arithmetic throughout."""
    size = F.lit(Decimal(str(test_size))).cast("decimal(18,9)")
    everything = W.partitionBy()
    n = F.col("n").cast("decimal(20,0)")
    seats = F.ceil(F.sum(n).over(everything) * size).cast("bigint")
    share = (
        counts.withColumn("_seats", seats)
        .withColumn("_exact", n * size)
        .withColumn("_floor", F.floor("_exact").cast("bigint"))
    )
    rank = F.row_number().over(
        W.orderBy((F.col("_exact") - F.col("_floor")).desc(), F.col(label).asc())
    )
    spare = F.col("_seats") - F.sum("_floor").over(everything)
    return share.select(
        label, "n", (F.col("_floor") + F.when(rank <= spare, 1).otherwise(0)).alias("quota")
    )


def _cells(ranked: DataFrame, by: list[str], upto: int = _DIGITS) -> DataFrame:
    """Rows per group and digest prefix; combined before the shuffle."""
    prefix = F.substring("_rank", 1, upto).alias("_prefix")
    return ranked.groupBy(*by, prefix).agg(F.count("*").alias("_n"))


def _boundary(cells: DataFrame, by: list[str], quota: DataFrame) -> DataFrame:
    """The prefix at which each group's quota is reached: ``(by..., _prefix, _take, _n)``."""
    upto = W.partitionBy(*by).orderBy("_prefix").rowsBetween(W.unboundedPreceding, 0)
    cells = cells.withColumn("_upto", F.sum("_n").over(upto))
    cells = cells.join(quota, by) if by else cells.crossJoin(F.broadcast(quota.limit(1)))
    return cells.where("_upto >= quota AND _upto - _n < quota AND quota > 0").select(
        *by, "_prefix", (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_take"), "_n"
    )


def _cuts(ranked: DataFrame, cells: DataFrame, by: list[str], quota: DataFrame, order_rows: int) -> DataFrame:
    """Largest digest that is still inside the quota, per group: ``(by..., cut)``."""
    digits = _DIGITS
    edge, _ = written(_boundary(cells, by, quota), "boundary")
    prefix = lambda n: F.substring("_rank", 1, n).alias("_prefix")
    while True:
        inside = ranked.select(*by, "_rank", prefix(digits)).join(edge, [*by, "_prefix"])
        crowded = edge.agg(F.max("_n").alias("n")).first().n
        if not crowded or crowded <= order_rows or digits >= 32:
            break
        digits += _DIGITS
        left = edge.select(*by, F.col("_take").alias("quota"))
        edge, _ = written(_boundary(_cells(inside.select(*by, "_rank"), by, digits), by, left), "boundary")
    place = F.row_number().over(W.partitionBy(*by, "_prefix").orderBy("_rank"))
    return (
        inside.withColumn("_place", place)
        .where("_place = _take")
        .select(*by, F.col("_rank").alias("cut"))
    )


def split_cuts(
    df: DataFrame, key: str | Column, label: str = "label", test_size: float = 0.2, seed: int = 42,
    order_rows: int = ORDER_ROWS,
) -> DataFrame:
    """The split in one row per class: test rows are those with a digest up to ``cut`` (empty
    for a class without test rows). Two scans of key and label: one counts, one orders the rows
    at the boundary. The table is written, so that every use of it reads the same rows."""
    ranked = df.where(F.col(label).isNotNull()).select(label, seeded_md5(seed, key).alias("_rank"))
    cells, _ = written(_cells(ranked, [label]), "cells")
    counts = cells.groupBy(label).agg(F.sum("_n").alias("n"))
    quota = test_quota(counts, label, test_size).select(label, "quota")
    cuts = _cuts(ranked, cells, [label], quota, order_rows)
    every = quota.select(label).join(cuts, label, "left").select(label, F.coalesce("cut", F.lit("")).alias("cut"))
    return written(every, "cuts")[0]


def stratified_split(
    df: DataFrame,
    key: str | Column,
    label: str = "label",
    test_size: float = 0.2,
    seed: int = 42,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Add ``split`` (``train``, ``test`` or ``unlabelled``): exact per class and a function of
    key, seed and class sizes only, so any later job regenerates it; with the ``cuts`` of an
    earlier split also when rows were added since. The cuts, one row per class, are broadcast: a join by
    label would deal the rows of a class to one task."""
    if cuts is None:
        cuts = split_cuts(df, key, label, test_size, seed)
    joined = df.join(F.broadcast(cuts), label, "left")
    test = seeded_md5(seed, key) <= F.col("cut")
    side = F.when(F.col("cut").isNull(), "unlabelled").when(test, "test").otherwise("train")
    return joined.select(*df.columns, side.alias("split"))


def held_out(df: DataFrame, key: str | Column, label: str = "label", test_size: float = 0.2,
             seed: int = 42, cuts: DataFrame | None = None) -> DataFrame:
    """Only the rows no training with the same settings has seen, those without a label included."""
    return stratified_split(df, key, label, test_size, seed, cuts).where("split != 'train'").drop("split")


def three_way_split(
    df: DataFrame, key: str | Column, label: str = "label", test_size: float = 0.2,
    validation_size: float = 0.2, seed: int = 42,
) -> DataFrame:
    """``train`` / ``validation`` / ``test``. The test rows are those of
    :func:`stratified_split`; the validation share is taken from the remaining rows."""
    first = stratified_split(df, key, label, test_size, seed)
    rest = first.where("split = 'train'").drop("split")
    cuts = split_cuts(rest, key, label, validation_size, seed + 1)
    joined = first.join(F.broadcast(cuts), label, "left")
    chosen = (F.col("split") == "train") & (seeded_md5(seed + 1, key) <= F.col("cut"))
    return joined.select(
        *df.columns, F.when(chosen, "validation").otherwise(F.col("split")).alias("split")
    )


def subsample_cut(
    df: DataFrame, key: str | Column, n: int, seed: int = 42, order_rows: int = ORDER_ROWS
) -> str | None:
    """Largest digest of a subsample of ``n`` rows; None where it takes every row."""
    if n <= 0:
        return None
    ranked = df.select(seeded_md5(seed, key).alias("_rank"))
    quota = df.sparkSession.createDataFrame([(n,)], "quota bigint")
    cut = _cuts(ranked, _cells(ranked, []), [], quota, order_rows).first()
    return cut.cut if cut else None


def within(df: DataFrame, key: str | Column, cut: str | None, seed: int = 42) -> DataFrame:
    """The rows of a subsample by its cut."""
    return df if cut is None else df.where(seeded_md5(seed, key) <= F.lit(cut))


def subsample(df: DataFrame, key: str | Column, n: int, seed: int = 42, order_rows: int = ORDER_ROWS) -> DataFrame:
    """Exactly ``n`` rows without replacement; everything unless ``0 < n < rows``."""
    return within(df, key, subsample_cut(df, key, n, seed, order_rows), seed)


def split_overlap(a: DataFrame, b: DataFrame, *key: str) -> DataFrame:
    """Number of keys of ``a`` that are also in ``b``."""
    return a.join(b, list(key), "left_semi").agg(F.count("*").alias("overlap"))


def split_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy("split", *by).agg(F.count("*").alias("n"))
