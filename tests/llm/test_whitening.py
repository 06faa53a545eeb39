"""Eigenvectors against the library's, whitening against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import types as T

from coppice.llm.qdwh import leading_eigenvectors, polar_factor
from coppice.llm.queries import op12_whiten
from coppice.llm.whitening import deviations, whiten

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def symmetric(eigenvalues, seed=0):
    n = len(eigenvalues)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))
    a = (q * eigenvalues) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_polar_factor(n):
    a = np.random.default_rng(n).standard_normal((n, n))
    u, _, v = np.linalg.svd(a)
    assert np.abs(polar_factor(a) - u @ v).max() < 1e-10


@pytest.mark.parametrize(
    "eigenvalues",
    [[2.0], [1.0, 1.0], np.linspace(1, 9, 64), [3.0] * 20 + [1.0] * 20, 10.0 ** -np.arange(40.0), np.zeros(9),
     [5, 1, 0, 0, 0, 0], [1 + 1e-9 * i for i in range(30)], [-3.0, -2.0, 4.0]],
)
def test_eigenvectors(eigenvalues):
    a = symmetric(np.array(eigenvalues, float))
    k = min(4, len(a))
    values, vectors = leading_eigenvectors(a, k)
    scale = max(1e-300, np.abs(a).max())
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() <= 1e-13 * len(a) * scale
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * len(a) * scale
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert (np.diff(values) <= 0).all()


def brute(rows):
    """doc -> (deviation, whitened without signs, explained), the number of distinct vectors."""
    ok = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([np.floor(256 * np.array(v, float)) for _, v in ok]).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    z = fit - s / n
    e, w = np.linalg.eigh(z.T @ z / n)
    e, w = e[::-1][:4], w[:, ::-1][:, :4]
    white = np.abs((x - s / n) @ w / np.sqrt(e))
    return n, [(i, int(((n * a - s) ** 2).sum()), b) for (i, _), a, b in zip(ok, x, white)], e / np.trace(z.T @ z / n)


def check(got, rows):
    n, want, explained = brute(rows)
    key = lambda r: (str(r[0]), r[1], *np.round(r[2], 6))
    by = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - explained[r.component - 1]) <= 1e-9 * r.explained
    for c in range(1, len(explained) + 1):
        by[c] = sorted(((str(r.vec_id), r.deviation, abs(r.whitened)) for r in got if r.component == c))
        ours, theirs = by[c], sorted((str(i), d, w[c - 1]) for i, d, w in want)
        assert [x[:2] for x in ours] == [x[:2] for x in theirs]
        assert np.abs(np.array([x[2] for x in ours]) - [x[2] for x in theirs]).max() < 1e-7


def test_query_equals_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(op12_whiten(spark, sf).collect(), rows)


def test_repeated_and_unusable_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [(None, rows[3][1]), (7, rows[3][1])]
    bad = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("nan")] * 6), (204, [float("-inf")] * 6), (205, [1.0] * 5)]
    df = spark.createDataFrame(rows + bad, SCHEMA).selectExpr("*", "1 as x", "2 as n", "3 as id", "4 as component")
    got = whiten(df.repartition(4)).collect()
    check(got, rows)
    assert {r.vec_id for r in got} & set(range(200, 206)) == set()


def test_without_spread(spark):
    one = whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, SCHEMA)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0)] * 3
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []
    flat = whiten(spark.createDataFrame([(i, [float(i), 5.0]) for i in range(10)], SCHEMA)).collect()
    assert all(r.whitened == 0 and r.explained == 0 for r in flat if r.component == 2) and all(r.identity_error < 1e-12 for r in flat)


@pytest.mark.parametrize("n,bits,scale", [(1000, 8, 1), (10**9, 12, 1), (10**7, 40, 10**6)])
def test_exact_deviations(n, bits, scale):
    rng = np.random.default_rng(n)
    x = rng.integers(-(1 << bits), 1 << bits, (30, 8))
    sums = [int(v) * n // 3 for v in x[0]]
    x[1] = [s // n for s in sums]
    want = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
    assert deviations(x, n, sums, bits + 1) == [v if v < 1 << 63 else None for v in want]
