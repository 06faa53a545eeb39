import math

import numpy as np
import pytest

from coppice.operators.binning import bin_features, edges_by_feature, quantile_edges


def plain_edges(values, bins):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    if not v:
        return []
    ranks = {-(-j * len(v) // bins) for j in range(1, bins)} - {0}
    return sorted({v[r - 1] for r in ranks if v[r - 1] > v[0]})


def columns():
    rng = np.random.default_rng(1)
    n = 4000
    skew = np.exp(rng.normal(size=n) * 6)  # many orders of magnitude
    hot = np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n) * 1e-3 + 7)  # one value holds a third
    cols = [
        rng.normal(size=n), skew, hot, rng.integers(0, 2, n), np.full(n, 3.5), rng.integers(-5, 40, n),
        np.where(rng.random(n) < 0.9, 0.0, 1e30),
    ]
    x = np.array(cols).T.astype(np.float32).astype(float).tolist()
    for i in range(0, n, 9):
        x[i][0] = None
    for i in range(0, n, 11):
        x[i][5] = float("nan")
    for r in x:
        r.append(None)
    return x


@pytest.fixture(scope="module")
def data(spark):
    x = columns()
    df = spark.createDataFrame([(i, r) for i, r in enumerate(x)], "row_id INT, features ARRAY<FLOAT>").repartition(5)
    return x, df.persist()


@pytest.mark.parametrize("bins", [2, 16, 200])
def test_edges_are_exact_order_statistics(data, bins):
    x, df = data
    got = edges_by_feature(quantile_edges(df, bins), len(x[0]))
    assert got == [plain_edges([r[f] for r in x], bins) for f in range(len(x[0]))]


def test_edges_do_not_depend_on_partitioning(data):
    _, df = data
    assert sorted(quantile_edges(df.repartition(1), 16).collect()) == sorted(quantile_edges(df.repartition(13), 16).collect())


def test_tolerant_edges_are_near(data):
    x, df = data
    n = len(x)
    for f, edges in enumerate(edges_by_feature(quantile_edges(df, 16, tolerance=0.01), len(x[0]))):
        v = np.array([r[f] for r in x if r[f] is not None and not math.isnan(r[f])])
        exact = plain_edges(v, 16)
        assert len(edges) <= 15 and (len(edges) > 0) == (len(exact) > 0)
        if f in (0, 1):
            for a, b in zip(edges, exact):
                assert abs((v < a).sum() - (v < b).sum()) <= 0.01 * n


@pytest.mark.parametrize("bins", [16, 200])
def test_bins(data, bins):
    x, df = data
    cuts = edges_by_feature(quantile_edges(df, bins), len(x[0]))
    out = bin_features(df, cuts)
    kind = "array<tinyint>" if max(map(len, cuts)) + 1 <= 127 else "array<smallint>"
    assert dict(out.dtypes)["bins"] == kind
    for r in out.collect():
        for f, (v, b) in enumerate(zip(x[r.row_id], r.bins)):
            missing = v is None or math.isnan(v)
            assert b == (0 if missing else 1 + sum(c <= v for c in cuts[f]))


def test_values_outside_the_training_range(spark):
    train = spark.createDataFrame([([float(i)],) for i in range(10)], "features ARRAY<FLOAT>")
    cuts = edges_by_feature(quantile_edges(train, 4), 1)
    new = spark.createDataFrame([([-1e9],), ([1e9],), ([None],)], "features ARRAY<FLOAT>")
    assert [r.bins[0] for r in bin_features(new, cuts).collect()] == [1, len(cuts[0]) + 1, 0]
