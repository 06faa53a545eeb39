import random
import re

import numpy as np
import pyarrow as pa
import pytest

from coppice.llm.common import sets_of_shingles, slices
from coppice.llm.components import components
from coppice.llm.ngram_join import DELETION_SIZE, allowances, bands, bits_apart, ngram_join, parities, signatures
from coppice.llm.queries import op1_ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                at[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(i, least.get(root(k), i))
    return {i: (len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows)}


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        k = r.randrange(len(words))
        words[k : k + r.choice((0, 1))] = [f"new{r.random()}"] * r.choice((0, 1))
    return words


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    rows, passage = [], " ".join(r.choices(vocabulary, k=60))
    for size in (3, 5, 6, 9, 14, 30, 60, 120, 400):
        for _ in range(3):
            base = r.choices(vocabulary, k=size)
            rows.append(" ".join(base))
            rows += [" ".join(edited(r, base, max(0, int(size * share / 10)))).upper() for share in (0, 0.05, 0.1, 0.2, 0.3, 0.4)]
    rows += [f"{passage} {' '.join(r.choices(vocabulary, k=k))}" for k in range(5, 60, 5)]
    rows += ["", "  ", "one", "one two"]
    r.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(make_docs, seed):
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join(make_docs(rows)).collect()}
    assert got == brute(rows)


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op1_ngram_join(spark, sf).collect()}
    assert got == brute(rows)


def test_every_link_shares_a_signature_with_a_probe():
    r = random.Random(5)
    universe = np.array([r.getrandbits(64) for _ in range(4000)], np.uint64)
    for trial in range(400):
        size = r.choice((1, 2, 4, 5, 6, 9, 10, 17, 40, 90, 200, 500))
        x = np.sort(universe[r.sample(range(4000), size)])
        keep = x[: max(1, size - r.randint(0, size // 5))]
        y = np.unique(np.concatenate([keep, universe[r.sample(range(4000), r.randint(0, size // 5))]]))
        common = len(np.intersect1d(x, y))
        if 5 * common < 4 * (len(x) + len(y) - common) or np.array_equal(x, y):
            continue
        keys, who, flags = signatures([x, y], np.array([1, 2]), 4, 5)
        a = {(k, f & 2) for k, w, f in zip(keys, who, flags) if w == 1}
        found = False
        for k, w, f in zip(keys, who, flags):
            if w == 2:
                found |= any((k, d) in a for d in (0, 2) if not (d and f & 2))
        assert found, (len(x), len(y), common)
        assert bits_apart(np.frombuffer(parities(x), np.uint64), np.frombuffer(parities(y), np.uint64)) <= len(x) + len(y) - 2 * common


def test_allowances_exceed_the_bound_and_prefer_long_segments():
    for low, high, m in bands(3000, 4, 5):
        counts = np.random.default_rng(low).multinomial(high - 1, np.ones(m) / m, size=4)
        a = allowances(counts, counts.sum(1), 4, 5)
        assert (a.sum(1) > 2 * counts.sum(1) // 9).all()
        assert ((a == 2) <= (counts >= DELETION_SIZE)).all()
        for c, g in zip(counts, a):
            assert c[g > 0].min() >= c[g == 0].max(initial=0)


def test_many_edited_copies_are_one_component(make_docs):
    r = random.Random(3)
    base = [f"b{r.randrange(500)}" for _ in range(300)]
    rows = [(i, " ".join(edited(r, base, r.randrange(5)))) for i in range(150)] + [(999, " ".join(base))] + [(2000 + i, " ".join(base)) for i in range(200)]
    got = {r.doc_id: r.component_id for r in ngram_join(make_docs(rows)).collect()}
    assert set(got.values()) == {0}


def test_odd_rows(odd_rows, no_rows):
    rows = ngram_join(odd_rows).collect()
    assert len(rows) == 15 and odd_rows.count() == 15
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0
    assert [by[i].component_id for i in (1, 2, 3, 4, 7, 8)] == [1, 2, 3, 4, 6, 8]
    assert by[6].n_shingles == 59_996 and by[4].n_shingles == 1
    assert [r.component_id for r in rows if r.doc_id == 9] == [9, 9]
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert ngram_join(no_rows).collect() == []


def test_words_and_slices():
    texts = pa.array(["A  b\tc\nd E", "", "one", "ß É x y z", "a b c d e f"])
    sets = sets_of_shingles(texts.cast(pa.large_string()), 5)
    assert [len(s) for s in sets] == [1, 0, 1, 1, 1]
    again = sets_of_shingles(pa.array(["a b c d e"]).cast(pa.large_string()), 5)
    assert sets[0][0] == again[0][0]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), texts], ["i", "text"])
    parts = list(slices(batch, "text", 12))
    assert [p.num_rows for p in parts][0] >= 1 and sum(p.num_rows for p in parts) == 5
    assert list(slices(batch.slice(0, 0), "text")) == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(500, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
