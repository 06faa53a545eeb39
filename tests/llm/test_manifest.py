"""The Merkle manifest against a tree built in plain Python."""

import hashlib

import compare
from pyspark.sql import functions as F

from coppice.llm.merkle import FANOUT, folded, leaf_digest, merkle_manifest, proof_digest
from coppice.llm.queries import op11_merkle
from coppice.llm.ranks import ranked
from coppice.llm.sql import MERKLE_SQL
from coppice.session import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[c] for c in FIELDS)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + FANOUT])) for i in range(0, len(levels[-1]), FANOUT)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i // FANOUT * FANOUT
        out += nodes[first:i] + nodes[i + 1 : first + FANOUT]
        i //= FANOUT
    return out


def brute(docs):
    """Sorted (doc_id, leaf, subroot, root, digest of the proof)."""
    groups = {}
    for r in docs:
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf_of(r), r.doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for j, (s, t) in enumerate(zip(names, trees)):
        for i, x in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            proof = h("".join(siblings(t, i) + siblings(top, j)))
            out.append((x[3], x[2], t[-1][0], top[-1][0], proof))
    return sorted(out, key=str)


def manifest(docs):
    rows = merkle_manifest(docs).withColumn("proof", proof_digest(F.col("path"))).withColumn("again", folded(F.col("leaf"), F.col("path"))).collect()
    assert all(r.again == r.root for r in rows)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in rows), key=str)


def test_query_equals_sql(spark, sf):
    con = compare.connect(sf)
    assert compare.spark_rows(op11_merkle(spark, sf)) == compare.sql_rows(con, MERKLE_SQL)


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert manifest(docs) == brute(docs.collect())


def test_group_sizes_around_the_fanout(make_docs):
    rows, at = [], 0
    for size in (1, 2, 15, 16, 17, 32, 33, 256, 257, 300):
        for _ in range(size):
            rows.append((at * 7919 % 100_003, f"text {at}", "en", f"s{size}"))
            at += 1
    rows += [(5_000_000, "without a source", None, None)]
    docs = make_docs(rows)
    assert manifest(docs) == brute(docs.collect())
    assert manifest(docs.repartition(5)) == brute(docs.collect())


def test_many_groups(make_docs):
    docs = make_docs([(i, f"text {i}", "en", f"s{i}") for i in range(300)])
    got = manifest(docs)
    assert got == brute(docs.collect()) and all(r[1] == r[2] for r in got)


def test_odd_rows(odd_rows, no_rows, make_docs):
    assert manifest(odd_rows) == brute(odd_rows.collect())
    assert manifest(no_rows) == []
    one = manifest(make_docs([(7, "alone")]))
    assert one[0][1] == one[0][2] == one[0][3] and one[0][4] == h("")


def test_altered_leaf_is_found(make_docs):
    docs = make_docs([(i, f"Text {i}", "en", f"s{i % 3}") for i in range(100)])
    other = F.when(F.col("doc_id") % 10 == 0, leaf_digest([F.col(c) for c in FIELDS[:-1]] + [F.lower("text")]))
    rows = merkle_manifest(docs, also={"other": other}).select(
        "doc_id", (folded(F.coalesce("other", "leaf"), F.col("path")) == F.col("root")).alias("ok")
    )
    assert {r.doc_id for r in rows.collect() if not r.ok} == set(range(0, 100, 10))


def test_ranks_of_equal_rows(spark):
    stored, _ = written(spark.range(3000).select((F.col("id") % 2).alias("v")), "equal")
    got = ranked(stored, [F.col("v")], "rank", "ranked")[0].orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(3000)) and [r.v for r in got] == [0] * 1500 + [1] * 1500
