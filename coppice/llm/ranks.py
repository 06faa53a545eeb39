"""Positions of rows in a total order, without one task that sees all rows.

Rows are dealt out by range, ordered inside each range and stored with their place in it; the only
thing gathered is one count per range, that is per shuffle partition. Rows that are equal in every
ordering column are told apart by their place in the input table, so that a run of equal rows of any
length is spread over ranges like other rows. The input has to be a stored table: its rows then come
in the same order whenever a task runs again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

# monotonically_increasing_id() has the partition above and the row in it below this bit.
_ROW_BITS = 33


def ranked(stored: DataFrame, order: list[Column], rank: str, name: str) -> tuple[DataFrame, str]:
    """``stored`` with the column ``rank`` (0, 1, ... in the order given), and the path of the table
    below it. An empty table gives an empty table."""
    spark = stored.sparkSession
    keys = [*order, F.col("__tie")]
    placed, path = written(
        stored.withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__at", F.monotonically_increasing_id())
        .drop("__tie"),
        name,
    )
    part = F.shiftright("__at", _ROW_BITS)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n")).collect()  # one row per range
    before, starts = 0, []
    for p, n in sorted(tuple(r) for r in counts):
        starts.append((p, before))
        before += n
    starts = spark.createDataFrame(starts, "__part long, __before long")
    within = F.col("__at").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .withColumn(rank, F.col("__before") + within)
        .drop("__part", "__before", "__at"),
        path,
    )
