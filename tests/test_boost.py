"""The distributed trainer against a plain one on small data."""

import math
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coppice.functions.proba import fixed_point, gradient, hessian, softmax
from coppice.functions.hashing import row_hash
from coppice.operators.binning import bin_features, edges_by_feature, quantile_edges
from coppice.operators.blocks import BATCH_BLOCKS, from_blocks, to_blocks
from coppice.operators.histogram import Grown, Pass, fixed_scale, grad_histogram, node_histograms
from coppice.operators import blocks, histogram
from coppice.operators.sampling import sample_features, sample_tree_features
from coppice.plans import train as training
from coppice.plans.train import TrainParams, boost, prepare, train

PARAMS = TrainParams(n_estimators=3, max_depth=3, learning_rate=0.3, subsample=1.0, colsample_bytree=1.0, max_bins=16)


def make(n=240, seed=0, missing=True):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2).astype(np.float32).astype(float)
    x[:, 3] = rng.integers(0, 2, n)
    y = (x[:, 0] + 0.5 * x[:, 3] > 0.2).astype(int) + (x[:, 1] * x[:, 0] > 0.3)
    if missing:
        x[rng.random((n, 4)) < 0.1] = np.nan
    split = np.where(np.arange(n) % 5 == 0, "test", "train")
    return x, y.astype(int), split


def frame(spark, data, parts=3):
    rows = [
        (i, [None if math.isnan(v) else float(v) for v in r], int(y), str(s))
        for i, (r, y, s) in enumerate(zip(*data))
    ]
    return spark.createDataFrame(rows, "row_id BIGINT, features ARRAY<FLOAT>, label INT, split STRING").repartition(parts)


def plain_edges(x, bins):
    out = []
    for f in range(x.shape[1]):
        v = np.sort(x[~np.isnan(x[:, f]), f])
        ranks = {-(-j * len(v) // bins) for j in range(1, bins)} - {0}
        out.append(sorted({v[r - 1] for r in ranks if v[r - 1] > v[0]}))
    return out


def plain_boost(data, p):
    """Brute force: every split of every node by summing rows."""
    x, y, split = data
    tr = split == "train"
    k = y[tr].max() + 1
    edges = plain_edges(x[tr], p.max_bins)
    miss = np.isnan(x)
    nodes, m, curve = {}, np.zeros((len(x), k)), []

    def grow(r, c, node, inside, every, g, h):
        score = lambda s: g[s].sum() ** 2 / (h[s].sum() + p.reg_lambda)
        best = None
        if node < 2**p.max_depth - 1:
            for f in range(x.shape[1]):
                for b in range(0, len(edges[f]) + 1):
                    if b == 0 and not (inside & miss[:, f]).any():
                        continue
                    below = x[:, f] < (edges[f][b - 1] if b else -np.inf)
                    for left_side in ([True, False] if (inside & miss[:, f]).any() else [True]):
                        left = inside & np.where(miss[:, f], left_side, below)
                        right = inside & ~np.where(miss[:, f], left_side, below)
                        if h[left].sum() < p.min_child_weight or h[right].sum() < p.min_child_weight:
                            continue
                        gain = 0.5 * (score(left) + score(right) - score(inside))
                        rank = (round(gain, 7), -f, -b, left_side)
                        if gain > 1e-9 and (best is None or rank > best[0]):
                            best = (rank, f, b, left_side, np.where(miss[:, f], left_side, below))
        if best is None:
            value = -p.learning_rate * g[inside].sum() / (h[inside].sum() + p.reg_lambda)
            nodes[r, c, node] = ("leaf", value)
            m[every, c] += value
            return
        _, f, b, side, goes_left = best
        nodes[r, c, node] = ("split", f, b)
        grow(r, c, 2 * node + 1, inside & goes_left, every & goes_left, g, h)
        grow(r, c, 2 * node + 2, inside & ~goes_left, every & ~goes_left, g, h)

    for r in range(p.n_estimators):
        e = np.exp(m - m.max(axis=1, keepdims=True))
        proba = e / e.sum(axis=1, keepdims=True)
        for c in range(k):
            grow(r, c, 0, tr.copy(), np.ones(len(x), bool), proba[:, c] - (y == c), proba[:, c] * (1 - proba[:, c]))
        e = np.exp(m - m.max(axis=1, keepdims=True))
        loss = -np.log((e / e.sum(axis=1, keepdims=True))[np.arange(len(x)), y])
        curve.append((loss[tr].mean(), loss[~tr].mean()))
    return nodes, curve


@pytest.mark.parametrize("missing", [False, True])
@pytest.mark.parametrize("looks", [0, 10**12])
def test_trainer_equals_brute_force(spark, missing, looks, monkeypatch):
    monkeypatch.setattr(training, "SUBTRACT_LOOKS", looks)
    data = make(missing=missing)
    model = train(frame(spark, data), PARAMS, "m")
    nodes, curve = plain_boost(data, PARAMS)
    got = {(r["round"], r.class_id, r.node_id): r for r in model.nodes.collect()}
    assert set(got) == set(nodes)
    for key, want in nodes.items():
        r = got[key]
        if want[0] == "leaf":
            assert r.is_leaf and r.leaf_value == pytest.approx(want[1], abs=1e-6)
        else:
            assert (r.feature, r.split_bin) == want[1:]
    for r in model.curves.collect():
        assert (r.train_mlogloss, r.test_mlogloss) == pytest.approx(curve[r.step], abs=1e-6)


def node_rows(model):
    cols = [c for c in model.nodes.columns if c != "model_id"]
    return sorted(model.nodes.select(*cols).collect(), key=lambda r: (r["round"], r.class_id, r.node_id))


def test_result_is_identical_for_any_partitioning_and_checkpoint_rhythm(spark):
    data = make(seed=4)
    p = replace(PARAMS, subsample=0.7, colsample_bytree=0.6)
    one = train(frame(spark, data, 1), p)
    prepared = prepare(frame(spark, data, 11), p.max_bins)
    (two,), rows = boost(prepared, [p], ["x"], checkpoint_every=1)
    rows.unpersist()
    assert node_rows(one) == node_rows(two)


def test_trials_that_share_passes_equal_trials_alone(spark):
    prepared = prepare(frame(spark, make(seed=2)), 16)
    trials = [PARAMS, replace(PARAMS, max_depth=2, learning_rate=0.1, n_estimators=2, reg_lambda=5.0),
              replace(PARAMS, subsample=0.6, colsample_bytree=0.5, min_child_weight=3.0)]
    together, rows = boost(prepared, trials, ["a", "b", "c"])
    rows.unpersist()
    for params, shared in zip(trials, together):
        (alone,), rows = boost(prepared, [params], ["x"])
        rows.unpersist()
        assert node_rows(shared) == node_rows(alone)
        assert shared.curves.count() == params.n_estimators


def test_a_lost_training_goes_on(spark, monkeypatch, tmp_path):
    data, p = make(seed=11), replace(PARAMS, n_estimators=8, max_depth=2, subsample=0.8)
    journal = str(tmp_path / "journal")
    (whole,), rows = boost(prepare(frame(spark, data), p.max_bins), [p], ["m"], checkpoint_every=3)
    rows.unpersist()
    grow, rounds = training._Round.grow, []

    def until_seven(self, *args):
        rounds.append(self.round_no)
        if self.round_no == 7 and len(rounds) == 8:
            raise RuntimeError("driver lost")
        return grow(self, *args)

    monkeypatch.setattr(training._Round, "grow", until_seven)
    with pytest.raises(RuntimeError, match="driver lost"):
        train_with = prepare(frame(spark, data, 5), p.max_bins)
        boost(train_with, [p], ["m"], checkpoint_every=3, journal=journal)
    train_with.release()
    again = prepare(frame(spark, data, 2), p.max_bins)
    (two,), rows = boost(again, [p], ["m"], checkpoint_every=3, journal=journal)
    rows.unpersist()
    assert rounds == [*range(8), 6, 7]
    assert node_rows(whole) == node_rows(two)
    assert [tuple(r) for r in whole.curves.orderBy("step").select("step").collect()] == [(i,) for i in range(8)]
    assert sorted(r.step for r in two.curves.collect()) == list(range(8))
    with pytest.raises(ValueError, match="another training"):
        boost(again, [replace(p, seed=1)], ["m"], journal=journal)


@pytest.mark.parametrize("looks", [0, 10**12])
def test_levels_in_several_passes(spark, monkeypatch, looks):
    monkeypatch.setattr(training, "SUBTRACT_LOOKS", looks)
    prepared = prepare(frame(spark, make(seed=3)), 16)
    (whole,), rows = boost(prepared, [PARAMS], ["x"])
    monkeypatch.setattr(training, "MAX_CELLS", 4 * 17 * 2)
    (parts,), rows = boost(prepared, [PARAMS], ["x"])
    rows.unpersist()
    assert node_rows(whole) == node_rows(parts)


def test_any_number_of_slices_and_reducers_gives_the_same_trees(spark, monkeypatch):
    prepared = prepare(frame(spark, make(seed=6)), 16)
    p = replace(PARAMS, colsample_bytree=0.8, max_depth=4)
    monkeypatch.setattr(training, "SUBTRACT_LOOKS", 0)
    (one,), rows = boost(prepared, [p], ["x"])
    rows.unpersist()
    monkeypatch.setattr(histogram, "ARRIVING_BYTES", 3 * prepared.n_tasks * prepared.n_bins * 20 // 2)
    monkeypatch.setattr(histogram, "REDUCER_BYTES", 1)
    assert histogram.slice_count(prepared.n_tasks, prepared.n_features, prepared.n_bins) == 3
    (many,), rows = boost(prepared, [p], ["x"])
    rows.unpersist()
    assert node_rows(one) == node_rows(many)
    assert histogram.slice_count(10_000, 54, 66) > 1 and histogram.slice_count(10**9, 54, 66) == 54


def test_only_the_lighter_sibling_is_summed(spark, monkeypatch):
    prepared = prepare(frame(spark, make(500, 8)), 16)
    levels = []

    def seen(blocks, level, kept, n_tasks):
        levels.append(level)
        return level_splits(blocks, level, kept, n_tasks)

    monkeypatch.setattr(training, "SUBTRACT_LOOKS", 0)
    level_splits = training.level_splits
    monkeypatch.setattr(training, "level_splits", seen)
    (model,), rows = boost(prepared, [replace(PARAMS, n_estimators=1, max_depth=4)], ["x"])
    rows.unpersist()
    cover = {(r.class_id, r.node_id): r.cover for r in model.nodes.collect()}
    assert len(levels) == 4 and all(other is None for _, other in levels[0].pairs.values())
    for depth, level in enumerate(levels[1:], 1):
        first = (1 << depth) - 1
        for (tree, parent), (small, other) in level.pairs.items():
            assert {small, other} == {2 * parent, 2 * parent + 1}
            assert cover[tree, first + small] <= cover[tree, first + other]
            assert level.todo.slots[tree][small] >= 0 > level.todo.slots[tree][other]


def test_descent_equals_walking_row_by_row():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 9, (3, 500)).astype(np.uint8)
    grown = Grown(1)
    for level in range(3):
        grown.add_level()
        grown.split[level][0] = rng.random(1 << level) < (1 if level == 0 else 0.7)
        grown.feature[level][0] = rng.integers(0, 3, 1 << level)
        grown.cut[level][0] = rng.integers(0, 8, 1 << level)
        grown.missing_right[level][0] = rng.random(1 << level) < 0.5

    def walk(i):
        at = 0
        for level in range(3):
            if not grown.split[level][0, at]:
                return level, at
            b = bins[grown.feature[level][0, at], i]
            at = 2 * at + int(b > grown.cut[level][0, at] or (b == 0 and grown.missing_right[level][0, at]))
        return 3, at

    got = {int(i): (level, at) for level, at, rows in histogram.descend(bins, np.arange(500), 0, grown) for i in rows}
    assert got == {i: walk(i) for i in range(500)}


def test_covers_add_up_and_loss_falls(spark):
    model = train(frame(spark, make(400, 5)), replace(PARAMS, n_estimators=5))
    nodes = {(r["round"], r.class_id, r.node_id): r for r in model.nodes.collect()}
    for (r, c, _), n in nodes.items():
        if not n.is_leaf:
            children = nodes[r, c, n.left_id].cover + nodes[r, c, n.right_id].cover
            assert children == pytest.approx(n.cover, abs=1e-9)
    losses = [r.train_mlogloss for r in model.curves.orderBy("step").collect()]
    assert all(b <= a for a, b in zip(losses, losses[1:]))


def test_a_tree_without_any_split_is_one_leaf(spark):
    x, y, split = make(60)
    x[:] = 1.0
    model = train(frame(spark, (x, y, split)), replace(PARAMS, n_estimators=1))
    rows = model.nodes.collect()
    assert [r.node_id for r in rows] == [0] * model.n_class and all(r.is_leaf for r in rows)
    tr = split == "train"
    for r in rows:
        g = (1 / 3 - (y[tr] == r.class_id)).sum()
        assert r.leaf_value == pytest.approx(-0.3 * g / (2 / 9 * tr.sum() + 1), abs=1e-6)


def test_both_histogram_forms_agree(spark):
    x, y, split = make(300, 7)
    df = frame(spark, (x, y, split))
    cuts = edges_by_feature(quantile_edges(df, 16), 4)
    rows = bin_features(df, cuts).select(
        "bins", "label", F.lit(True).alias("is_train"), row_hash("row_id").alias("row_hash")
    ).withColumn("margin", F.array(*[(F.col("row_hash") % 7 - 3) / 5.0 + k for k in range(3)]))
    packed = to_blocks(rows, 4, 18)
    back = sorted((r.label, tuple(r.margin)) for r in from_blocks(packed, 3).collect())
    assert back == sorted((r.label, tuple(r.margin)) for r in rows.collect())
    scale = 2.0**20
    todo = Pass(4, 18, 3, scale, Grown(3), [(1, 0, 2**31)], [[0, 1, 2, 3]] * 3, {k: np.zeros(1, np.int64) for k in range(3)})
    fast = {(r.tree, r.feature, r.bin): (r.g, r.h) for r in node_histograms(packed, todo).collect()}
    plain = grad_histogram(
        rows.withColumn("p", softmax("margin")).select(
            "bins", F.array_repeat(F.lit(0), 3).alias("node"),
            fixed_point(gradient("p", "label"), scale).alias("g"), fixed_point(hessian("p"), scale).alias("h"),
        )
    )
    slow = {(r.tree, r.feature, r.bin): (r.g, r.h) for r in plain.collect()}
    assert set(fast) == set(slow)
    # exp may differ in the last bit between the two, hence one unit per row.
    assert all(abs(a - b) <= 300 for key in fast for a, b in zip(fast[key], slow[key]))


def test_feature_samples_agree(spark):
    trees = spark.createDataFrame([(r, c) for r in range(4) for c in range(3)], "round INT, class_id INT")
    got = {}
    for r in sample_tree_features(trees, 54, 0.6, 9).collect():
        got.setdefault((r["round"], r.class_id), []).append(r.feature)
    for (r, c), features in got.items():
        assert sorted(features) == sample_features(54, 0.6, 9, r, c) and len(features) == 32
    assert len(sample_features(3, 0.1, 1, 0, 0)) == 1


def test_scale_leaves_room_for_the_sums():
    for n in (1, 10**6, 10**9, 5 * 10**11, 10**13):
        assert fixed_scale(n) * n < 2**62 and fixed_scale(n) >= 2**17


def test_bad_input_is_refused(spark):
    x, y, split = make(60)
    with pytest.raises(ValueError, match="labels"):
        train(frame(spark, (x, np.where(y == 1, 5, y), split)), PARAMS)
    with pytest.raises(ValueError, match="no training rows"):
        train(frame(spark, (x, y, np.full(60, "test"))), PARAMS)
    with pytest.raises(ValueError, match="max_depth"):
        train(frame(spark, (x, y, split)), replace(PARAMS, max_depth=0))


def test_python_gets_few_blocks_at_once(spark):
    """The usual limit counts rows of a batch, of which one holds thousands of training rows."""
    df = frame(spark, make(6000, 3)).repartition(1)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "50")
    try:
        prepared = prepare(df.sortWithinPartitions("row_id"), 16)
    finally:
        spark.conf.set(key, old)
    one = prepared.blocks.coalesce(1)
    sizes = one.select("n").mapInArrow(lambda bs: (b.select(["n"]).slice(0, 1).set_column(0, "n", pa.array([b.num_rows], pa.int32())) for b in bs if b.num_rows), "n INT")
    most = sizes.agg(F.max("n"), F.sum("n")).first()
    prepared.release()
    assert most[0] <= BATCH_BLOCKS and most[1] > 100


def test_any_size_of_blocks_gives_the_same_training(spark, monkeypatch):
    data, p = make(900, 13), replace(PARAMS, subsample=0.8)
    got = []
    for size in (blocks.BLOCK_BYTES, 700):
        monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
        prepared = prepare(frame(spark, data, 2), p.max_bins, 2)
        models, state = boost(prepared, [p, replace(p, max_depth=2)], ["a", "b"], checkpoint_every=2)
        most = state.agg(F.max("n"), F.count("*")).first()
        rows = sorted((r.label, tuple(r.margin)) for r in from_blocks(state, 6).collect())
        curves = models[0].curves.orderBy("model_id", "step").collect() + models[1].curves.orderBy("model_id", "step").collect()
        got.append(([node_rows(m) for m in models], rows, [c[2:] for c in curves]))
        state.unpersist()
        prepared.release()
    assert most[0] == 700 // (4 + 12 + 8 * 6) and most[1] > 900 // most[0]
    assert got[0][:2] == got[1][:2]
    assert np.allclose(got[0][2], got[1][2], rtol=1e-12)


def test_the_reader_of_blocks_holds_few(spark):
    prepared = prepare(frame(spark, make(60)), 16)
    assert prepared.blocks.sparkSession.conf.get("spark.sql.parquet.columnarReaderBatchSize") == str(BATCH_BLOCKS)
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "4096"
    prepared.release()
