import hashlib
import math
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coppice.operators.labels import require_dense_labels
from coppice.operators.split import held_out, stratified_split, subsample
from coppice.sources.features import require_unique_keys


def plain_split(rows, size, seed):
    """Test keys by plain sorting inside each class."""
    size = Fraction(str(size))
    by = {}
    for key, label in rows:
        by.setdefault(label, []).append(key)
    share = {k: math.floor(len(v) * size) for k, v in by.items()}
    spare = math.ceil(len(rows) * size) - sum(share.values())
    for k in sorted(by, key=lambda k: (-(len(by[k]) * size - share[k]), k))[:spare]:
        share[k] += 1
    rank = lambda key: hashlib.md5(f"{seed}:{key}".encode()).hexdigest()
    return {key for k, v in by.items() for key in sorted(v, key=rank)[: share[k]]}


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "row_id BIGINT, label INT").repartition(parts)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    labels=st.lists(st.sampled_from([0, 0, 0, 0, 1, 2]), min_size=1, max_size=120),
    size=st.sampled_from([0.1, 0.2, 0.25, 0.5]),
    seed=st.integers(0, 1000),
)
def test_split_equals_plain_sorting(spark, labels, size, seed):
    rows = list(enumerate(labels))
    got = held_out(frame(spark, rows), "row_id", test_size=size, seed=seed).collect()
    assert {r.row_id for r in got} == plain_split(rows, size, seed)


def test_split_does_not_depend_on_partitioning_or_order(spark):
    rows = [(i, min(i % 7, 2)) for i in range(3000)]
    want = plain_split(rows, 0.2, 42)
    for parts, order in ((1, 1), (7, -1), (64, 1)):
        df = frame(spark, rows[::order], parts)
        out = stratified_split(df, "row_id")
        assert out.count() == 3000
        assert {r.row_id for r in out.where("split = 'test'").collect()} == want


def test_a_third_of_all_rows_in_one_class_and_a_class_of_one_row(spark):
    rows = [(i, 0 if i % 3 == 0 else 1 + i % 5) for i in range(900)] + [(900, 9)]
    out = stratified_split(frame(spark, rows), "row_id", test_size=0.2)
    test = Counter(r.label for r in out.where("split = 'test'").collect())
    assert sum(test.values()) == math.ceil(901 * 0.2)
    assert test[0] == Counter(l for _, l in rows)[0] * 0.2


def test_empty_input(spark):
    empty = spark.createDataFrame([], "row_id BIGINT, label INT")
    assert stratified_split(empty, "row_id").count() == 0
    assert subsample(empty, "row_id", 5).count() == 0


@pytest.mark.parametrize("n", [-1, 0, 1, 17, 499, 500, 501])
def test_subsample_size(spark, n):
    df = spark.range(500).withColumnRenamed("id", "row_id")
    got = {r.row_id for r in subsample(df, "row_id", n, seed=3).collect()}
    assert len(got) == (n if 0 < n < 500 else 500)
    if 0 < n < 500:
        rank = lambda k: hashlib.md5(f"3:{k}".encode()).hexdigest()
        assert got == set(sorted(range(500), key=rank)[:n])


def test_repeated_keys_raise(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "row_id INT")
    with pytest.raises(ValueError, match="repeat"):
        require_unique_keys(df, "row_id")
    assert require_unique_keys(df.distinct(), "row_id").count() == 2


def test_labels_must_be_dense(spark):
    assert require_dense_labels(spark.createDataFrame([(0,), (1,), (1,)], "label INT")) == (2, 3)
    for bad in ([(0,), (2,)], [(1,), (2,)], [(0,), (None,)], []):
        with pytest.raises(ValueError):
            require_dense_labels(spark.createDataFrame(bad, "label INT"))


def test_split_is_a_row_local_filter(spark):
    """Applying the split does not shuffle the rows."""
    df = frame(spark, [(i, i % 3) for i in range(300)])
    plan = stratified_split(df.withColumn("x", F.lit(1)), "row_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Window" not in plan


def test_the_rows_of_a_class_are_not_dealt_to_one_task(spark):
    """Cuts made from rows of the driver have no known size: joined plainly, all rows went by label."""
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("label"))
    cuts = spark.createDataFrame([(k, "8") for k in range(3)], "label INT, cut STRING")
    plan = stratified_split(df, "id", cuts=cuts)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
