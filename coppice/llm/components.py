"""Connected components of a table of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every larger (or every not larger) neighbour of a node with the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    around = both.join(least, "a")
    if large:
        return around.where("b > a and b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    own = least.select("a", F.col("m").alias("b"))
    return around.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node of it) of every node of ``links`` (``a``, ``b``).
    Each round is written to the shared folder; the number of rounds grows with the logarithm of
    the longest chain. A hub's links are dealt out by the adaptive join, not gathered."""
    edges, path = written(links.where("a != b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        new, new_path = written(_star(_star(edges, True), False), "edges")
        remove(links.sparkSession, path)
        # xor of row hashes: equal sums and counts of the whole link table end the rounds
        state = new.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        edges, path = new, new_path
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
