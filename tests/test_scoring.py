import numpy as np
import pytest
from pyspark.sql import functions as F
from test_boost import PARAMS, frame, make

from coppice.operators.scoring import score, score_native
from coppice.plans.inference import score_model
from coppice.plans.train import train
from coppice.sources.store import SCHEMAS


@pytest.fixture(scope="module")
def trained(spark):
    df = frame(spark, make(400, 9)).persist()
    return df, train(df, PARAMS, "m")


def proba(df):
    return np.array([r.proba for r in df.orderBy("row_id").collect()])


def test_three_ways_agree(spark, trained):
    df, model = trained
    fast = proba(score_model(df, model))
    assert np.allclose(fast.sum(axis=1), 1)
    assert np.allclose(fast, proba(score_native(df, model.nodes, model.n_class)), atol=1e-12)
    stages = score(df, model.nodes, model.n_class, model.n_features, max_nodes=20)
    assert np.allclose(fast, proba(stages), atol=1e-12)


def test_scores_equal_the_training_margins(spark, trained):
    df, model = trained
    p = proba(score_model(df, model))
    labels = np.array([(r.label, r.split == "test") for r in df.orderBy("row_id").collect()])
    loss = -np.log(p[np.arange(len(p)), labels[:, 0]])
    last = model.curves.orderBy(F.desc("step")).first()
    assert last.test_mlogloss == pytest.approx(loss[labels[:, 1] == 1].mean(), abs=1e-9)
    assert last.train_mlogloss == pytest.approx(loss[labels[:, 1] == 0].mean(), abs=1e-9)


@pytest.mark.parametrize("batch", ["1", "7", "100000"])
def test_batch_size_has_no_effect(spark, trained, batch):
    df, model = trained
    want = proba(score_model(df, model))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        assert np.array_equal(want, proba(score_model(df.limit(400), model)))
    finally:
        spark.conf.set(key, old)


def test_only_the_features_go_to_python(trained):
    df, model = trained
    plan = score_model(df, model)._jdf.queryExecution().executedPlan().toString()
    above_cache = plan.split("InMemoryTableScan")[0]
    assert "ArrowEvalPython [scored(features" in above_cache and "Exchange" not in above_cache


def test_rows_of_another_width_raise(spark, trained):
    _, model = trained
    bad = spark.createDataFrame([(1, [1.0, 2.0])], "row_id INT, features ARRAY<FLOAT>")
    with pytest.raises(Exception, match="needs 4 features"):
        score_model(bad, model).collect()


def test_save_and_load(store, trained):
    df, model = trained
    store.save_model("m", model.nodes, model.edges)
    again = score(df, store.load_nodes("m"), model.n_class, model.n_features)
    assert np.array_equal(proba(again), proba(score_model(df, model)))
    with pytest.raises(LookupError):
        store.load_nodes("unknown")


def stumps(spark, n, deep=0):
    """``n`` trees of one split or none, and ``deep`` of two levels, of three classes."""
    rng = np.random.default_rng(5)
    rows = []
    for r in range(n + deep):
        row = lambda i, leaf, f=None, t=None, v=None, miss=None: rows.append(
            ("m", r, r % 3, i, leaf, f, None, t, miss, None if leaf else 2 * i + 1, None if leaf else 2 * i + 2, v, None, None)
        )
        if r % 50 == 7 and r < n:
            row(0, True, v=float(rng.normal()))
            continue
        splits = [0] if r < n else [0, 2]
        for i in splits:
            threshold = -float("inf") if r % 40 == 3 else float(np.round(rng.normal(), 1))
            row(i, False, int(rng.integers(0, 4)), threshold, miss=bool(r % 2))
        for i in ({1, 2, 5, 6} if r >= n else {1, 2}) - set(splits):
            row(i, True, v=float(rng.normal()) / 50)
    return spark.createDataFrame(rows, SCHEMAS["model_nodes"]).repartition(3)


@pytest.mark.parametrize("n, deep", [(2600, 0), (1500, 30), (0, 400)])
def test_an_ensemble_of_many_parts(spark, n, deep):
    """Formerly an expression for each part, which failed from some hundreds on."""
    df, nodes = frame(spark, make(200, 12)), stumps(spark, n, deep)
    got = proba(score(df, nodes, 3, 4, max_nodes=5))
    x = np.array([[np.nan if v is None else v for v in r.features] for r in df.orderBy("row_id").collect()])
    trees = {}
    for r in nodes.collect():
        trees.setdefault((r["round"], r.class_id), {})[r.node_id] = r
    m = np.zeros((len(x), 3))
    for (_, k), tree in trees.items():
        for i, v in enumerate(x):
            at = tree[0]
            while not at.is_leaf:
                left = at.missing_left if np.isnan(v[at.feature]) else v[at.feature] < at.threshold
                at = tree[at.left_id if left else at.right_id]
            m[i, k] += at.leaf_value
    want = np.exp(m - m.max(axis=1, keepdims=True))
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-9)
