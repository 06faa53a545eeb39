"""Mixing sources to target weights by hash-threshold histograms (operator 13).

A source's budget is its share of all words. Whole passes over a source are taken as often as they
fit; for the rest, documents are taken in the order of a hash until the rest is used up. Nothing is
sorted: words are summed by source and hash bucket, the running sum over buckets shows in which
bucket a budget ends, and only the documents of that bucket are summed again by the next digits of
their hash, until the bucket is one document. What comes out is a threshold for each source, and
taking a document is a comparison of its own hash with it. Thresholds are nested: a larger budget
takes every document that a smaller one takes.

Where the document at the threshold does not fit what is left, the documents behind it that fit are
searched in the same way, so that a source misses its target by less than ``TOLERANCE`` or by less
than any document left. Each such round fixes one more pair of thresholds and a size limit.

Hot sources are aggregated before they are shuffled; all sources share each pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import remove, written
from .ranks import ranked

# Most times that a document is taken.
REPEATS = 3
# Weights by the rank of a source, again from the start behind the last.
WEIGHTS = (1, 2, 3)
# Part of a source's budget that may stay open while documents that fit are left.
TOLERANCE = 0.001
# Hex digits by which a bucket is refined, and those of a whole order key (a digest, then the place of
# the row in the stored table, which tells apart rows that are equal in all columns read).
DIGITS, KEY_DIGITS = 3, 48
# Sorts behind every key digit.
BEHIND = "g"
WORD = r"[^\x20\x09-\x0D]+"


def order_digest(seed: str, *parts: Column) -> Column:
    """Digest that orders documents: of the seed and the parts, ``-`` for NULL."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))


def shares(sources: DataFrame) -> DataFrame:
    """``sources`` (``weight``, ``total``) with ``target`` (double) and ``budget`` (its whole part). A share
    ends at ``REPEATS`` times the source; what is over goes to the others by weight, until no share
    is above. Each round is one aggregate over the sources and caps at least one."""
    capped = F.lit(False)
    while True:
        state = sources.withColumn("capped", capped)
        words, fixed, weight, n = state.agg(
            F.coalesce(F.sum("total"), F.lit(0)),
            F.coalesce(F.sum(F.when(F.col("capped"), F.col("total") * REPEATS)), F.lit(0)),
            F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight"))), F.lit(0)),
            F.count(F.when(F.col("capped"), 1)),
        ).first()
        left, weight = words - fixed, max(1, weight)
        # total * REPEATS < weight_s * left / weight, without a division
        over = F.col("total").cast("decimal(38,0)") * (REPEATS * weight) < F.col("weight").cast("decimal(38,0)") * left
        again = capped | over
        if sources.agg(F.count(F.when(again, 1))).first()[0] == n:
            share = F.col("weight") * F.lit(left).cast("long")
            return state.select(
                *sources.columns,
                F.when(F.col("capped"), (F.col("total") * REPEATS).cast("double")).otherwise(share.cast("double") / F.lit(float(weight))).alias("target"),
                F.when(F.col("capped"), F.col("total") * REPEATS).otherwise(F.expr(f"weight * {left}L div {weight}L")).alias("budget"),
            )
        # The limits of a round hold in later ones, as what is left for a weight only grows.
        capped = over


def _first_over(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """For each source of ``state`` (``src``, ``left``) the first candidate (``src``, ``key``, ``size``) at
    which the running sum exceeds ``left``: a ``prefix`` of its key that no other candidate has, and
    the sum ``before`` it. No row where all candidates fit."""
    digits, open_at = DIGITS, state.select("src", "left", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before"))
    while True:
        inside = candidates.join(open_at, "src").where(F.col("key").startswith(F.col("prefix")))
        buckets = inside.groupBy("src", "left", "before", F.substring("key", 1, digits).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count("*").alias("rows")
        )
        upto = F.col("before") + F.sum("words").over(Window.partitionBy("src").orderBy("bucket"))
        first = (
            buckets.withColumn("upto", upto)
            .where("upto > left")
            .groupBy("src", "left")
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "rows")).alias("b"))
            .select("src", "left", F.col("b.bucket").alias("prefix"), F.col("b.before").alias("before"), F.col("b.rows").alias("rows"))
        )
        first, _ = written(first, "boundary")
        most = first.agg(F.max("rows")).first()[0]
        if most is None or most == 1 or digits >= KEY_DIGITS:
            return first.select("src", "prefix", "before")
        open_at, digits = first, digits + DIGITS


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``id_col``, ``size`` (words), ``source_size``, ``target`` (of the source) and ``taken`` (words that the
    mix takes of the document, repeats counted).

    A NULL text has no words and is taken zero times; rows without a source are a source of their own,
    the last one. Repeated rows count each for itself, NULL ids are ids like others. A source without
    words has the target 0. The order depends on id and text alone, not on partitions. Other columns
    are not read; an empty table gives no rows. Tables of one short row for each document are stored
    below the folder of ``spark.checkpoint.dir``."""
    spark = docs.sparkSession
    text = F.col(text_col)
    rows, _ = written(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.concat(order_digest(seed, F.col(id_col), text), F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")).alias("key"),
        ),
        "sizes",
    )
    totals, totals_path = written(rows.groupBy("source").agg(F.sum("size").alias("total")), "sources")
    sources, sources_path = ranked(totals, [F.asc_nulls_last("source")], "src", "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod("src", F.lit(len(WEIGHTS))) + 1).cast("int"))
    sources, _ = written(shares(sources.withColumn("weight", weight.cast("long"))), "sources")
    remove(spark, totals_path)
    remove(spark, sources_path)
    of = sources.withColumnRenamed("source", "__of")
    named = lambda *cols: rows.join(of.select("__of", *cols), F.col("source").eqNullSafe(F.col("__of")))

    # Sources whose budget is not a whole number of passes.
    state = sources.select("src", F.expr("if(total = 0, 0, budget % total)").alias("left"), "budget").where("left > 0")
    state = state.withColumns({"after": F.lit(""), "most": F.lit(1 << 62)})
    rounds: list[DataFrame] = []
    while True:
        state, _ = written(state, "thresholds")
        if state.isEmpty():
            break
        limits = state.select("src", "after", "most")
        words = named("src").where("size > 0").join(limits, "src").where("key > after and size <= most")
        first = _first_over(words.select("src", "key", "size"), state.select("src", "left"))
        ends = state.join(first, "src", "left")
        rounds.append(ends.select("src", "after", F.coalesce("prefix", F.lit(BEHIND)).alias("until"), "most"))
        left = F.col("left") - F.col("before")
        state = (
            ends.where("prefix IS NOT NULL")
            .select("src", left.alias("left"), "budget", F.concat("prefix", F.lit(BEHIND)).alias("after"), left.alias("most"))
            .where(F.col("left") > F.col("budget") * tolerance)
        )
    out = named("src", "total", "target", "budget")
    passes = F.expr("if(total = 0, 0, budget div total)")
    if rounds:
        picks = reduce(DataFrame.union, rounds).groupBy("src").agg(F.collect_list(F.struct("after", "until", "most")).alias("spans"))
        out = out.join(picks, "src", "left")
        extra = F.exists("spans", lambda s: (F.col("key") > s["after"]) & (F.col("key") < s["until"]) & (F.col("size") <= s["most"]))
        passes = passes + F.when(extra, 1).otherwise(0)
    return out.select(
        F.col("id").alias(id_col),
        "size",
        F.col("total").alias("source_size"),
        "target",
        (F.col("size") * passes).cast("long").alias("taken"),
    )
