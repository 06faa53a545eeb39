"""Evaluation of scored rows ``(row_id, label, proba)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.proba import LOG_EPS, argmax, row_log_loss

# Log odds are cut into cells of this width between these bounds; what lies beyond shares the
# outermost cells.
_CELL, _BOUND, _INF = 1 / 1024, 32, float("inf")
# Most different scores of a cell, and how many cells with more are broadcast (some 60 bytes each).
CROWDED, _FEW_CELLS = 200_000, 100_000
# Cells are numbered in the order of their scores: bits of the first numbers, bits that a cut adds at least and at
# most, bits of a number after cells have been numbered anew, and bits that a number may have.
_FIRST_BITS, _LEAST_BITS, _MOST_BITS, _ANEW_BITS, _ALL_BITS = 17, 10, 20, 40, 62


def accuracy(df: DataFrame, *by: str, proba: str = "proba", label: str = "label") -> DataFrame:
    hit = (argmax(proba) == F.col(label)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count("*").alias("n"))


def log_loss(df: DataFrame, *by: str, proba: str = "proba", label: str = "label",
             eps: float = LOG_EPS) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(row_log_loss(proba, label, eps)).alias("log_loss"))


def confusion(df: DataFrame, proba: str = "proba", label: str = "label") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), argmax(proba).alias("predicted_class")).agg(
        F.count("*").alias("n")
    )


def _bucket(score):
    """Cell of a probability on a fixed scale of log odds, which spreads scores near 0 and 1 as
    well. A larger score never has a smaller cell."""
    odds = F.when(score <= 0, -_BOUND).when(score >= 1, _BOUND).otherwise(F.log(score / (1 - score)))
    return F.floor(F.greatest(F.lit(-_BOUND), F.least(F.lit(_BOUND), odds)) / _CELL).cast("int")


def _place(score, lo, hi, parts: int):
    """Which of ``parts`` steps from ``lo`` to ``hi`` a score is in; the two ends never share one."""
    step = F.floor((score - lo) / (hi - lo) * parts)
    return F.when(score >= hi, parts - 1).otherwise(F.least(F.greatest(step, F.lit(0)), F.lit(parts - 2))).cast("bigint")


def _anew(cells: DataFrame) -> DataFrame:
    """The same cells in the same order with the numbers 1, 2, and so on."""
    at = F.row_number().over(W.partitionBy("slot").orderBy("cell")).cast("bigint")
    numbers = cells.select("slot", "cell").distinct().select("slot", "cell", at.alias("_at"))
    return cells.join(numbers, ["slot", "cell"]).select("slot", "score", "n", "pos", F.col("_at").alias("cell"))


def _opened(distinct: DataFrame, crowded: int) -> DataFrame:
    """The different scores with their cells (``_cells``)."""
    return _cells(distinct, crowded)[0]


def _cells(distinct: DataFrame, crowded: int) -> tuple[DataFrame, list[DataFrame]]:
    """The different scores with a ``cell`` number each, in the order of the scores and with at most ``crowded``
    scores in one, and the cells before every cut and after the last, persisted, with their rows ``_n``. Cells
    with more scores are cut between their own least and greatest score, again and again, into so many steps
    that evenly spread scores need one cut. Every cut parts at least those two."""
    cells = distinct.withColumn("cell", (_bucket(F.col("score")) + _BOUND * 1024).cast("bigint"))
    used, seen_cells = _FIRST_BITS, []
    while True:
        if used + _MOST_BITS > _ALL_BITS:
            cells, used = _anew(cells), _ANEW_BITS
        sizes = cells.groupBy("slot", "cell").agg(
            F.count("*").alias("m"), F.min("score").alias("lo"), F.max("score").alias("hi"), F.sum("n").alias("_n")
        ).persist()
        seen_cells.append(sizes)
        full = sizes.where((F.col("m") > crowded) & (F.col("lo") > -_INF) & (F.col("lo") < F.col("hi")) & ~F.isnan("hi"))
        seen = full.agg(F.count("*").alias("n"), F.max("m").alias("m")).first()
        if not seen.n:
            return cells, seen_cells
        bits = max(_LEAST_BITS, min(_MOST_BITS, (seen.m // max(crowded, 1)).bit_length() + 3))
        small = full.select("slot", "cell", "lo", "hi")
        small = F.broadcast(small) if seen.n <= _FEW_CELLS else small
        deeper = F.when(F.col("lo").isNull(), 0).otherwise(_place(F.col("score"), F.col("lo"), F.col("hi"), 1 << bits))
        cells = cells.join(small, ["slot", "cell"], "left").select(
            "slot", "score", "n", "pos", (F.col("cell") * (1 << bits) + deeper).alias("cell")
        )
        used += bits


def auc_per_class(
    df: DataFrame,
    n_class: int,
    proba: str = "proba",
    label: str = "label",
    n_groups: int = 1,
    crowded: int = CROWDED,
) -> DataFrame:
    """Exact one-vs-rest ROC AUC ``(group, class_id, positives, negatives, auc)``.

    It is the rank sum of the positives with average ranks for ties. Equal scores are
    collapsed first. Ranks are prefix sums at two levels: over cells of scores and over the different
    scores inside a cell. Cells begin as steps of a fixed scale of log odds; one that holds more than
    ``crowded`` different scores is opened into finer ones until none does, so that no task orders
    more than these, however scores are spread. The cells do not influence the value.
    ``proba`` may hold several models side by side (``n_groups`` times ``n_class`` entries).
    A class without positives or without negatives gets NULL. One row per model and class passes
    through the driver.
    """
    rows = df.select(F.col(proba).alias("_proba"), F.col(label).alias("_label"))
    scores = rows.select("_label", F.posexplode("_proba").alias("slot", "score"))
    distinct = scores.groupBy("slot", "score").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("_label") == F.col("slot") % n_class).alias("pos"),
    ).persist()
    sizes = []
    try:
        cells, sizes = _cells(distinct, crowded)
        inside = W.partitionBy("slot", "cell").orderBy("score").rowsBetween(W.unboundedPreceding, 0)
        ranked = cells.withColumn("_upto", F.sum("n").over(inside))
        before = W.partitionBy("slot").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
        offsets = sizes[-1].select("slot", "cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
        ranked = ranked.join(offsets, ["slot", "cell"])
        # Twice the average rank, an integer: 2 * rows before + n + 1.
        twice = (2 * (F.col("_offset") + F.col("_upto")) - F.col("n") + 1).cast("decimal(19,0)")
        sums = ranked.groupBy("slot").agg(
            F.sum(F.col("pos").cast("decimal(19,0)") * twice).cast("double").alias("_twice"),
            F.sum("pos").alias("positives"),
            F.sum(F.col("n") - F.col("pos")).alias("negatives"),
        )
        p, q = F.col("positives").cast("double"), F.col("negatives").cast("double")
        auc = F.when((p > 0) & (q > 0), (F.col("_twice") - p * (p + 1)) / (2.0 * p * q))
        out = sums.select(
            F.floor(F.col("slot") / n_class).cast("int").alias("group"),
            (F.col("slot") % n_class).cast("int").alias("class_id"),
            "positives", "negatives", auc.alias("auc"),
        )
        return df.sparkSession.createDataFrame(out.collect(), out.schema)
    finally:
        for kept in [distinct, *sizes]:
            kept.unpersist()


def macro_auc(per_class: DataFrame, *by: str) -> DataFrame:
    """Mean over the classes; raises when a class has no AUC instead of leaving it out."""
    whole = F.count("auc") == F.count("*")
    message = F.lit("AUC is not defined: a class has only positives or only negatives")
    return per_class.groupBy(*by).agg(
        F.when(whole, F.avg("auc")).otherwise(F.raise_error(message).cast("double")).alias("auc_ovr_macro")
    )


def evaluate(df: DataFrame, n_class: int) -> dict[str, float]:
    """Accuracy, macro AUC and log loss of scored rows, which are persisted meanwhile."""
    scored = df.select("label", "proba").persist()
    try:
        row = scored.agg(
            F.avg((argmax("proba") == F.col("label")).cast("double")).alias("accuracy"),
            F.avg(row_log_loss("proba", "label")).alias("log_loss"),
        ).first()
        auc = macro_auc(auc_per_class(scored, n_class)).first().auc_ovr_macro
    finally:
        scored.unpersist()
    return {"accuracy": row.accuracy, "auc_ovr_macro": auc, "log_loss": row.log_loss}


def curve_gap(metrics: DataFrame, train: str = "train_mlogloss", test: str = "test_mlogloss") -> DataFrame:
    """Train and test value of each step side by side, with their difference."""
    wide = metrics.where(F.col("key").isin(train, test)).groupBy("run_id", "step").agg(
        F.max(F.when(F.col("key") == train, F.col("value"))).alias("train_value"),
        F.max(F.when(F.col("key") == test, F.col("value"))).alias("test_value"),
    )
    return wide.withColumn("gap", F.col("test_value") - F.col("train_value"))


def throughput(rows: int, seconds: float) -> float:
    return rows / seconds if seconds > 0 else float("nan")
