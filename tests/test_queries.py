"""Every query against its SQL counterpart on whole tables."""

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_oracles_name_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    got, want = spark_rows(QUERIES[name](spark, sf)), sql_rows(con, ORACLES[name])
    spark.catalog.clearCache()
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_scores_every_held_out_row(spark):
    df = entry.entry(spark)
    assert df.columns == ["row_id", "predicted_class", "predicted_probability", "true_label"]
    rows = df.collect()
    assert len(rows) == 1200 == len({r.row_id for r in rows})
