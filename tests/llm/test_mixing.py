"""Mixing against a plain scan of the documents in the order of their digests."""

import hashlib
import re
from fractions import Fraction

import compare
import pytest
from pyspark.sql import functions as F

from coppice.llm.mixing import REPEATS, TOLERANCE, mix
from coppice.llm.queries import op13_mix
from coppice.llm.sql import MIX_SQL

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(totals):
    """Share of each source, as fractions; sources in order."""
    weights, capped, everything = {s: i % 3 + 1 for i, s in enumerate(totals)}, set(), sum(totals.values())
    while True:
        left = everything - REPEATS * sum(totals[s] for s in capped)
        weight = sum(w for s, w in weights.items() if s not in capped)
        share = {s: Fraction(REPEATS * totals[s]) if s in capped else Fraction(weights[s] * left, weight) for s in totals}
        over = {s for s in totals if share[s] > REPEATS * totals[s]}
        if not over:
            return share
        capped |= over


def brute(docs, tolerance=TOLERANCE):
    by = {}
    for r in docs:
        parts = ["mix", *("-" if v is None else str(v) for v in (r.doc_id, r.text))]
        key = hashlib.md5(":".join(parts).encode()).hexdigest()
        by.setdefault(r.source, []).append((key, len(WORD.findall(r.text or "")), r.doc_id))
    totals = {s: sum(x[1] for x in by[s]) for s in sorted(by, key=lambda s: (s is None, s or ""))}
    out = []
    for s, target in targets(totals).items():
        budget = int(target)
        passes, left = divmod(budget, totals[s]) if totals[s] else (0, 0)
        most, done = float("inf"), not left
        for _, size, i in sorted(by[s], key=lambda x: x[0]):
            taken = not done and size <= left
            if taken:
                left -= size
            elif not done and size <= most:
                most, done = left, left <= budget * tolerance
            out.append((i, size, totals[s], float(target), size * (passes + taken)))
    return sorted(out, key=str)


def mixed(docs, **kw):
    return sorted(((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in mix(docs, **kw).collect()), key=str)


def test_query_equals_sql(spark, sf):
    con = compare.connect(sf)
    assert compare.spark_rows(op13_mix(spark, sf)) == compare.sql_rows(con, MIX_SQL)


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = mixed(docs)
    assert got == brute(docs.collect())
    assert got == mixed(docs.repartition(7, "lang"))


def sized(n):
    return " ".join(["w"] * n)


def test_uneven_sources(make_docs):
    """A hot source, small ones that reach three times their size, one without words and one without a name."""
    rows = [(i, sized(1 + i * 37 % 90), "en", "a") for i in range(400)]
    rows += [(1000 + i, sized(5), "en", "b") for i in range(30)] + [(2000 + i, sized(1 + i % 7), "en", "c") for i in range(50)]
    rows += [(3000 + i, " ", "en", "d") for i in range(5)] + [(4000 + i, sized(40), None, None) for i in range(20)]
    docs = make_docs(rows)
    got = mixed(docs)
    assert got == brute(docs.collect())
    taken = {}
    for _, size, source_size, target, t in got:
        assert t <= REPEATS * size
        x = taken.setdefault((source_size, target), [0])
        x[0] += t
    for (source_size, target), (t,) in taken.items():
        assert abs(t - target) <= max(1, 0.02 * target), (source_size, target, t)
    assert any(target == REPEATS * source_size for source_size, target in taken)


@pytest.mark.parametrize("tolerance", [0.0, 0.5])
def test_tolerance(make_docs, tolerance):
    docs = make_docs([(i, sized(1 + i * i % 300), "en", f"s{i % 4}") for i in range(300)])
    assert mixed(docs, tolerance=tolerance) == brute(docs.collect(), tolerance)


def test_repeated_rows_are_taken_in_part(make_docs):
    docs = make_docs([(None, sized(4), "en", "a")] * 90 + [(i, sized(4), "en", "b") for i in range(60)])
    got = mixed(docs)
    assert got == brute(docs.collect())
    # 600 words, a third for a
    assert sum(r[4] for r in got if r[0] is None) == 200


def test_odd_rows(odd_rows, no_rows):
    assert mixed(odd_rows) == brute(odd_rows.collect())
    assert mixed(no_rows) == []
    assert mixed(odd_rows.where("text is null")) == brute(odd_rows.where("text is null").collect())


def test_budgets_are_nested(make_docs):
    """A source that gets a larger share takes every document that it takes with a smaller one."""
    a = [(i, sized(1 + i % 50), "en", "a") for i in range(200)]
    taken = []
    for extra in (1500, 2500):
        docs = make_docs(a + [(10_000, sized(extra), "en", "b")])
        taken.append({r.doc_id: r.taken for r in mix(docs, tolerance=1.0).where(F.col("doc_id") < 200).collect()})
    assert all(taken[0][i] <= taken[1][i] for i in taken[0]) and taken[0] != taken[1]
