import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from coppice.functions.proba import argmax, margin_log_loss, row_log_loss
from coppice.operators import metrics
from coppice.operators.metrics import (
    accuracy, auc_per_class, confusion, curve_gap, evaluate, log_loss, macro_auc, throughput,
)


def plain_auc(score, hit):
    pos, neg = score[hit], score[~hit]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def scored(spark, n=600, k=4, seed=0, digits=2, hot=True):
    rng = np.random.default_rng(seed)
    p = np.round(rng.dirichlet(np.ones(k), n), digits)
    if hot:  # a third of all rows share one score vector
        p[: n // 3] = p[0]
    y = rng.integers(0, k, n)
    df = spark.createDataFrame(
        [(i, int(a), [float(v) for v in r]) for i, (a, r) in enumerate(zip(y, p))],
        "row_id INT, label INT, proba ARRAY<DOUBLE>",
    )
    return df.repartition(4), p, y


@pytest.mark.parametrize("buckets", [1, 7, 64])
@pytest.mark.parametrize("digits", [1, 6])
def test_auc_equals_counting_pairs(spark, buckets, digits):
    df, p, y = scored(spark, digits=digits)
    for r in auc_per_class(df, 4).collect():
        assert r.auc == pytest.approx(plain_auc(p[:, r.class_id], y == r.class_id), abs=1e-12)
        assert r.positives + r.negatives == len(y)


def test_auc_equals_the_library(spark):
    df, p, y = scored(spark, digits=3)
    ours = {r.class_id: r.auc for r in auc_per_class(df, 4).collect()}
    for k in range(4):
        one = df.select((F.col("label") == k).cast("double").alias("label"), F.get("proba", F.lit(k)).alias("rawPrediction"))
        assert ours[k] == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(one), abs=1e-9)


def test_models_side_by_side(spark):
    df, p, y = scored(spark)
    both = df.withColumn("proba", F.concat("proba", F.reverse("proba")))
    for r in auc_per_class(both, 4, n_groups=2).collect():
        s = p if r.group == 0 else p[:, ::-1]
        assert r.auc == pytest.approx(plain_auc(s[:, r.class_id], y == r.class_id), abs=1e-12)


def test_a_class_that_never_occurs(spark):
    df, _, _ = scored(spark)
    per_class = auc_per_class(df.where("label < 3"), 4)
    assert {r.class_id: r.auc is None for r in per_class.collect()} == {0: False, 1: False, 2: False, 3: True}
    with pytest.raises(Exception, match="AUC is not defined"):
        macro_auc(per_class).collect()


def test_log_loss_of_certain_and_wrong_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0])], "label INT, proba ARRAY<DOUBLE>")
    eps = 2.0**-23
    want = [-math.log(1 - eps), -math.log(eps)]
    got = [r[0] for r in df.orderBy("label").select(row_log_loss("proba", "label")).collect()]
    assert got == pytest.approx(want)
    assert log_loss(df).first().log_loss == pytest.approx(sum(want) / 2)


def test_log_loss_from_margins(spark):
    df = spark.createDataFrame([(1, [0.3, -1.0, 800.0])], "label INT, m ARRAY<DOUBLE>")
    assert df.select(margin_log_loss("m", "label")).first()[0] == pytest.approx(801.0)


def test_ties_go_to_the_lowest_class(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([0.25] * 4,)], "p ARRAY<DOUBLE>")
    assert [r[0] for r in df.select(argmax("p")).collect()] == [1, 0]


def test_evaluate(spark):
    df, p, y = scored(spark, k=3, digits=8)
    got = evaluate(df, 3)
    assert got["accuracy"] == pytest.approx((p.argmax(axis=1) == y).mean())
    assert got["auc_ovr_macro"] == pytest.approx(np.mean([plain_auc(p[:, k], y == k) for k in range(3)]))
    assert accuracy(df).first().accuracy == got["accuracy"]
    assert sum(r.n for r in confusion(df).collect() if r.label == r.predicted_class) == (p.argmax(axis=1) == y).sum()


def test_curve_gap_and_throughput(spark):
    rows = [("r", "train_mlogloss", 0, 1.0), ("r", "test_mlogloss", 0, 1.25), ("r", "other", 0, 9.0)]
    df = spark.createDataFrame(rows, "run_id STRING, key STRING, step INT, value DOUBLE")
    assert [(r.step, r.gap) for r in curve_gap(df).collect()] == [(0, 0.25)]
    assert throughput(10, 2.0) == 5.0 and math.isnan(throughput(10, 0.0))


@pytest.mark.parametrize("crowded", [1, 7, 10**6])
def test_auc_does_not_depend_on_cells(spark, crowded):
    rng = np.random.default_rng(4)
    n = 3000
    score = 0.3 + rng.integers(0, 800, n) * 1e-13  # one cell of the scale
    score[::50] = rng.random(n // 50)
    score[::70] = 1e-30 * rng.integers(1, 5, len(score[::70]))
    label = (rng.random(n) + score > 0.8).astype(int)
    df = spark.createDataFrame([(int(y), [1 - float(s), float(s)]) for y, s in zip(label, score)], "label INT, proba ARRAY<DOUBLE>")
    got = {r.class_id: (r.positives, r.negatives, r.auc) for r in auc_per_class(df, 2, crowded=crowded).collect()}
    for k, s in ((0, 1 - score), (1, score)):
        hit = label == k
        above = (s[hit][:, None] > s[~hit][None, :]).sum() + 0.5 * (s[hit][:, None] == s[~hit][None, :]).sum()
        assert got[k] == (hit.sum(), (~hit).sum(), pytest.approx(above / hit.sum() / (~hit).sum(), abs=1e-12))


def test_no_cell_stays_crowded(spark):
    from coppice.operators.metrics import _opened

    values = [0.5 + i * 1e-15 for i in range(1000)] + [float(i) for i in range(-50, 50)] + [float("nan"), float("inf")]
    rows = spark.createDataFrame([(0, v, 1, 0) for v in set(values)], "slot INT, score DOUBLE, n BIGINT, pos BIGINT")
    cells = _opened(rows, 20).collect()
    by = {}
    for r in cells:
        by.setdefault(r.cell, []).append(r.score)
    # The largest finite cell may hold an infinite score or NaN, which no step can part.
    assert all(len(v) <= 20 for v in by.values() if all(math.isfinite(x) for x in v))
    order = [x for c in sorted(by) for x in sorted(v for v in by[c] if math.isfinite(v))]
    assert order == sorted(order)


def test_cells_are_numbered_and_numbered_anew(spark):
    """Numbers in place of texts, a cut as fine as a cell is full; scores of ever smaller distance use up the numbers."""
    scores = [0.5 + 2.0**-k for k in range(2, 52)] + [0.25 + i * 1e-9 for i in range(3000)]
    df = spark.createDataFrame([(0, s, 1, 1) for s in scores], "slot INT, score DOUBLE, n BIGINT, pos BIGINT").persist()
    got = metrics._opened(df, 2)
    assert dict(got.dtypes)["cell"] == "bigint"
    rows = sorted((r.score, r.cell) for r in got.collect())
    cells = [c for _, c in rows]
    assert [s for s, _ in rows] == sorted(scores) and cells == sorted(cells)
    assert max(Counter(cells).values()) <= 2
