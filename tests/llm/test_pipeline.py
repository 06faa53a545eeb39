import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
import __spark_entry__ as entry
from coppice.llm import pii
from coppice.llm.byte_bpe import Encoder
from coppice.llm.quality_gam import quality_scores
from coppice.session import written


def test_registered():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14)) and "pipeline" in entry.queries()


@pytest.fixture(scope="module")
def planted(spark, sf, make_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    clean = [r.text for r in docs.join(labels, "doc_id").orderBy("doc_id").limit(3).collect()]
    turned = lambda text: " ".join(reversed(text.split()))
    rows = [
        (900_001, clean[0] + " one more word"), (900_002, clean[0] + " one more word"), (900_003, turned(clean[1]) + "\n" + item),
        (900_004, turned(clean[2]) + " write to some.one@mail7.example.com now"), (900_005, None),
    ]
    return docs.unionByName(make_docs(rows))


def test_stages(spark, sf, planted):
    docs = planted
    for name, stage in P.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs, _ = written(stage(spark, docs, sf), name)
        assert docs.columns == planted.columns
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "near_duplicates":
            assert not {900_001, 900_002} <= set(after)
            assert len(after) < len(before)
        if name == "decontaminate":
            assert 900_003 in before and 900_003 not in after
        if name == "pii":
            assert set(after) == set(before) and "some.one@mail7" not in after[900_004].text
            for i, r in after.items():
                assert r.n_chars == (None if r.text is None else len(r.text))
                assert pii.find(before[i].text or "", b"k") or r.text == before[i].text
        else:
            assert all(after[i] == before[i] for i in after)
    last = P.STAGES[-1][1](spark, docs, sf)
    codec = Encoder(P.public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), P.public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = last.collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    for r in rows[:50]:
        assert codec.encode([texts[r.doc_id]])[0].tolist() == list(r.ids) and r.n_tokens == len(r.ids)


def test_run_equals_the_stages_and_odd_rows(spark, sf, odd_rows, no_rows):
    rows = P.run(spark, sf)
    assert rows.where(~F.col("round_trip")).count() == 0 and rows.count() > 100
    for table in (odd_rows.select("doc_id", "text", "lang", "source", "n_chars"), no_rows):
        docs = table
        for name, stage in P.STAGES:
            docs, _ = written(stage(spark, docs, sf), name)
        assert docs.count() <= table.count()


def test_rows_without_or_with_repeated_ids(spark, sf, make_docs):
    """Every row is judged by its own text: leaked rows without an id go, one row of each group stays."""
    words = [f"word{i}" for i in range(40)]
    a, b = " ".join(words), " ".join(reversed(words))
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, a), (None, a), (5, a), (5, a), (5, b), (None, b + " more"), (None, item), (6, item), (6, "clean text of a row"), (None, "other clean text")]
    docs, _ = written(make_docs(rows), "odd")
    near = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, docs, sf).collect()), key=str)
    texts = sorted(t for _, t in near)
    assert texts == sorted([a, b, item, "clean text of a row", "other clean text"])
    assert (5, a) in near and (5, b) in near and (6, item) in near
    left = sorted(((r.doc_id, r.text) for r in P.decontaminate(spark, docs, sf).collect()), key=str)
    assert left == sorted([r for r in rows if r[1] != item], key=str)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_scores(docs, labels, carry={"t": F.col("text")}).collect()
    good = {r.t for r in scored if r.predicted == 1}
    kept = P.quality(spark, docs, sf).collect()
    assert sorted(r.text for r in kept) == sorted(t for _, t in rows if t in good)


def test_pseudonyms_follow_the_key(spark, sf, make_docs):
    docs = make_docs([(1, "mail to some.one@mail7.example.com"), (2, "or some.one@mail7.example.com")])
    run = lambda: [r.text.split()[-1] for r in P.pii(spark, docs, sf).orderBy("doc_id").collect()]
    one, two = run(), run()
    assert one[0] == one[1] and two[0] == two[1] and one != two
    spark.conf.set("spark.coppice.pii.key", "k")
    try:
        assert run() == run()
    finally:
        spark.conf.unset("spark.coppice.pii.key")
