"""Merkle manifest of a dataset by slot pivots (operator 11).

A leaf is the digest of a document's fields. Inside a group (source) leaves stand in the order of
their keys; every ``FANOUT`` consecutive nodes become one parent until one node, the subroot, is left,
and the subroots in the order of their groups give the root in the same way. One level is one
aggregation: rows are grouped by parent, conditional aggregates spread the children into ``FANOUT``
slot columns, and the parent's digest is the hash of the concatenated columns. Going down again, the
columns left and right of a child's own are its siblings; a parent hands its own siblings further up
to its children with them, so that in the end each document carries its whole path of proof.

Positions come from :mod:`.ranks`: no task orders a whole group, however large one is. The pivot of
the lowest level holds everything a document needs later, so documents cross the network twice (by
range and by parent), parents above them once for each level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove, written
from .ranks import ranked

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def encoded(field: Column) -> Column:
    """``-`` for NULL, else UTF-8 byte count, colon and value."""
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in fields]), 256)


def ascii_lower(text: Column) -> Column:
    """A-Z as a-z, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _slots(digest=lambda c: c) -> list[Column]:
    return [digest(F.col(f"s{k}")) for k in range(FANOUT)]


def _pivot(nodes: DataFrame, level: int, digest=lambda c: c) -> DataFrame:
    """Parents of ``nodes`` (``grp``, ``n`` leaves of the group, ``pos``, ``node``): one row each with the
    children in slot columns, whether the group has one node only (which then stays as it is), and
    the digest. ``digest`` takes it from a slot."""
    slot = F.pmod("pos", F.lit(FANOUT))
    parents = nodes.groupBy("grp", "n", F.shiftright("pos", FANOUT.bit_length() - 1).alias("parent")).agg(
        *[F.max(F.when(slot == k, F.col("node"))).alias(f"s{k}") for k in range(FANOUT)]
    )
    alone = F.col("n") <= FANOUT**level
    joined = F.sha2(F.concat_ws("", *_slots(digest)), 256)
    return parents.withColumn("alone", alone).withColumn("digest", F.when(alone, digest(F.col("s0"))).otherwise(joined))


def _grow(nodes: DataFrame, largest: int, name: str, digest=lambda c: c) -> list[tuple[DataFrame, str]]:
    """Stored levels from the lowest up, at least one; in the last each group has one row."""
    levels = []
    while not levels or largest > FANOUT ** len(levels):
        levels.append(written(_pivot(nodes, len(levels), digest), f"{name}-{len(levels)}"))
        nodes = levels[-1][0].select("grp", "n", F.col("parent").alias("pos"), F.col("digest").alias("node"))
        digest = lambda c: c
    return levels


def _descend(above: DataFrame, levels: list[tuple[DataFrame, str]], carried: list[str], digest=lambda c: c) -> DataFrame:
    """The lowest children with their ``path``; ``above`` has ``grp``, ``pos``, ``path`` and the carried
    columns of the last level's rows. ``digest`` takes a digest from a slot of the lowest level."""
    for k, (level, _) in reversed(list(enumerate(levels))):
        of = digest if k == 0 else lambda c: c
        slots = _slots(of)
        children = F.array(
            *[
                F.struct(
                    F.lit(i).alias("slot"),
                    F.col(f"s{i}").alias("node"),
                    F.concat_ws("", *slots[:i]).alias("left"),
                    F.concat_ws("", *slots[i + 1 :]).alias("right"),
                )
                for i in range(FANOUT)
            ]
        )
        below = level.join(above.withColumnRenamed("pos", "parent"), ["grp", "parent"])
        below = below.select("grp", "parent", "alone", "path", *carried, F.explode(children).alias("child")).where("child.node IS NOT NULL")
        own = F.array(F.struct(F.col("child.left").alias("left"), F.col("child.right").alias("right")))
        above = below.select(
            "grp",
            (F.col("parent") * FANOUT + F.col("child.slot")).alias("pos"),
            F.col("child.node").alias("node"),
            F.when(F.col("alone"), F.col("path")).otherwise(F.concat(own, F.col("path"))).alias("path"),
            *carried,
        )
    return above


def merkle_manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    group: str = "source",
    key: str = "doc_id",
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """``key``, the columns of ``also`` (computed from each document), ``leaf``, ``subroot``, ``root`` and
    ``path``, the siblings from the leaf up to the root as structs (``left``, ``right``) of concatenated
    digests.

    NULLs are fields like others: rows without a group are a group of their own before all others, rows
    without a key stand before those with one. Rows of equal group and key are ordered by their
    leaves; where these are equal too the rows are the same. Other columns are not read. An empty
    table gives no rows. Levels are stored below the folder of ``spark.checkpoint.dir``."""
    also = also or {}
    leaves, leaves_path = written(
        docs.select(
            F.col(group).alias("__g"), F.struct(
                F.col(key).alias("key"), leaf_digest([F.col(c) for c in fields]).alias("leaf"),
                *[c.alias(f"also_{n}") for n, c in also.items()],
            ).alias("node"),
        ),
        "leaves",
    )
    spark = docs.sparkSession
    order = [F.asc_nulls_first("__g"), F.asc_nulls_first("node.key"), F.col("node.leaf")]
    rows, rows_path = ranked(leaves, order, "rank", "ranked")
    groups, groups_path = written(rows.groupBy("__g").agg(F.min("rank").alias("start"), F.count("*").alias("n")), "groups")
    groups, _ = ranked(groups, [F.asc_nulls_first("__g")], "grp", "groups")
    largest, n_groups = groups.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    named = groups.withColumnRenamed("__g", "__of")
    nodes = rows.join(named, F.col("__g").eqNullSafe(F.col("__of"))).select("grp", "n", (F.col("rank") - F.col("start")).alias("pos"), "node")
    in_slot = lambda c: c["leaf"]
    lower = _grow(nodes, largest, "level", in_slot)
    for path in (leaves_path, rows_path, groups_path):
        remove(spark, path)
    subroots = lower[-1][0].select(
        F.lit(0).cast("long").alias("grp"), F.lit(n_groups).cast("long").alias("n"), F.col("grp").alias("pos"), F.col("digest").alias("node")
    )
    upper = _grow(subroots, n_groups, "top")
    top = upper[-1][0].select("grp", F.col("parent").alias("pos"), F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    roots = _descend(top, upper, ["root"]).select(
        F.col("pos").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", F.col("node").alias("subroot"), "root"
    )
    paths = _descend(roots, lower, ["subroot", "root"], in_slot)
    return paths.select(
        F.col("node.key").alias(key), *[F.col(f"node.also_{n}").alias(n) for n in also], F.col("node.leaf").alias("leaf"),
        "subroot", "root", "path",
    )
