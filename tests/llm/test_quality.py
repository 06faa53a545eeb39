import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coppice.llm.quality_gam import STATISTICS, fit, quality_scores, statistics
from coppice.llm.quality_mcd import CUTOFF, MIN_GROUP, NAMES, SCALE_UP, SHARE, VECTOR, quality_rules
from coppice.llm.queries import op6_quality_gam, op7_quality_mcd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op7_quality_mcd(spark, sf).collect():
        want = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def prose(r, n):
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 9))) for _ in range(n))


def test_outliers_are_rejected_in_their_own_group(make_docs):
    r = random.Random(1)
    rows = [(i, prose(r, r.randint(40, 400)), "en", "a") for i in range(300)]
    rows += [(1000 + i, " # ".join(prose(r, 1) for _ in range(120)), "en", "a") for i in range(15)]
    # In another source the same marks are usual.
    rows += [(2000 + i, " # ".join(prose(r, 1) for _ in range(r.randint(60, 200))), "en", "b") for i in range(200)]
    rows += [(5000, " # ".join(prose(r, 1) for _ in range(120)), "xx", None)]
    got = {x.doc_id: x for x in quality_rules(make_docs(rows)).collect()}
    assert all(got[i].kept for i in range(300))
    assert not any(got[1000 + i].kept for i in range(15))
    assert all(got[2000 + i].kept for i in range(200))
    # Alone in its language and source, and with no other small group: its own centre.
    assert got[5000].kept and got[5000].distance == 0
    assert all(x.kept == (x.distance <= CUTOFF) for x in got.values() if x.distance is not None and not x.base_failed)


def vector(text):
    n, chars, symbols, dup, rep = counts(text)
    lines = len([x for x in (text or "").split("\n") if WORD.search(x)])
    return [np.log1p(n), np.log((chars + 100) / (n + 20)), np.log1p(100 * symbols / (chars + 100)), dup / (lines + 1), rep / (n + 20)]


def floored(cov):
    np.fill_diagonal(cov, np.maximum(cov.diagonal(), np.array([VECTOR[n] for n in NAMES]) ** 2))
    return cov


def squared(x, m, c):
    return np.einsum("ij,ij->i", x - m, np.linalg.solve(c, (x - m).T).T)


def random_mcd(x, starts=40):
    """Centre and scatter by concentration from random subsets, with the exact share of rows."""
    r, h, best = np.random.default_rng(0), int(np.ceil(SHARE * len(x))), None
    for _ in range(starts):
        at = r.permutation(len(x))[:20]
        for _ in range(100):
            m, c = x[at].mean(0), floored(SCALE_UP * np.cov(x[at].T, bias=True))
            new = np.argsort(squared(x, m, c), kind="stable")[:h]
            if len(at) == h and set(new) == set(at):
                break
            at = new
        det = np.linalg.slogdet(c)[1]
        if best is None or det < best[0]:
            best = det, m, c
    return best[1:]


def test_verdicts_equal_random_starts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = {r.doc_id: r for r in quality_rules(spark.createDataFrame(docs)).collect()}
    x = {d.doc_id: np.array(vector(d.text)) for d in docs if not rows[d.doc_id].base_failed}
    fine, langs = Counter((d.lang, d.source) for d in docs if d.doc_id in x), Counter()
    for (lang, _), n in fine.items():
        langs[lang] += n if n < MIN_GROUP else 0
    groups = {}
    for d in docs:
        if d.doc_id in x:
            key = (d.lang, d.source) if fine[d.lang, d.source] >= MIN_GROUP else d.lang if langs[d.lang] >= MIN_GROUP else "*"
            groups.setdefault(key, []).append(d.doc_id)
    near = 0
    for ids in groups.values():
        at = np.array([x[i] for i in ids])
        for i, d2 in zip(ids, squared(at, *random_mcd(at))):
            # The share of rows is exact here and up to a bucket there.
            near += 0.9 < d2 / CUTOFF < 1.1
            assert rows[i].kept == (d2 <= CUTOFF) or 0.9 < d2 / CUTOFF < 1.1, (i, d2, rows[i].distance)
    assert near <= 0.02 * len(x)


def test_each_statistic_rejects_alone(make_docs):
    r = random.Random(5)
    line = lambda: prose(r, 14)
    rows = [(i, "\n".join(line() for _ in range(r.randint(20, 60))), "en", "a") for i in range(300)]
    some = [line() for _ in range(50)]
    # A repeated line of one word repeats no window of five words.
    dup = "\n".join(x for k in range(50) for x in ([some[k], "menu"] if k < 40 else [some[k]]))
    passage = prose(r, 195)
    words = [prose(r, 1500), passage, prose(r, 110), passage]
    odd = {900: dup, 901: " ".join(words), 902: "\n".join(f"{line()} ## $$ %% ||" for _ in range(40)), 903: "\n".join(f"{prose(r, 3)} {'x' * 60}" for _ in range(200))}
    got = {x.doc_id: x for x in quality_rules(make_docs(rows + [(i, t, "en", "a") for i, t in odd.items()])).collect()}
    assert all(got[i].kept for i in range(300))
    for i in odd:
        assert not got[i].base_failed and not got[i].kept, (i, got[i])


def test_verdicts_do_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = lambda d: sorted((r.doc_id, r.kept, round(r.distance or -1, 6)) for r in quality_rules(d).collect())
    assert rows(docs.repartition(1)) == rows(docs.repartition(13, "text"))


def test_rules_and_odd_rows(odd_rows, no_rows):
    rows = quality_rules(odd_rows).collect()
    assert Counter(r.n_words for r in rows) == Counter(counts(r.text)[0] for r in odd_rows.collect())
    assert sum(r.base_failed for r in rows) == sum(counts(r.text)[0] < 10 for r in odd_rows.collect())
    assert quality_rules(no_rows).collect() == []


def test_statistics_ignore_neighbours():
    texts = ["a b a b a b a b", "", "Hello, World!\nHello, World!\nx", "漢字 é 12 ## !!", "w " * 3000]
    together = statistics(pa.array(texts, pa.large_string()))
    for k, t in enumerate(texts):
        alone = statistics(pa.array([t], pa.large_string()))
        assert np.allclose(together[k], alone[0])
    assert not together[1].any() and together.shape == (5, len(STATISTICS))
    at = dict(zip(STATISTICS, together[2]))
    assert at["repeated_lines"] == pytest.approx(1 / 3) and at["bangs"] > 0


def test_model_learns_curves_and_an_interaction():
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 4))
    y = (x[:, 1] * x[:, 2] > 0).astype(float)
    model = fit(x[:2000], y[:2000])
    assert (((model.score(x[2000:]) >= 0.5) == y[2000:]).mean()) > 0.8
    plain = fit(x[:2000], (np.abs(x[:2000, 0]) > 0.8).astype(float))
    assert ((plain.score(x[2000:]) >= 0.5) == (np.abs(x[2000:, 0]) > 0.8)).mean() > 0.95
    assert fit(np.zeros((0, 4)), np.zeros(0)).score(x[:2]).tolist() == [0.5, 0.5]
    assert (fit(x, np.ones(3000)).score(x[:3]) > 0.99).all()


def test_held_out_accuracy(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op6_quality_gam(spark, sf).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.85


def test_held_out_labels_do_not_change_scores(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    score = lambda y: sorted((r.doc_id, r.score) for r in quality_scores(docs, y).collect())
    assert score(labels) == score(flipped)


def test_scores_of_odd_rows(spark, odd_rows, no_rows):
    labels = spark.createDataFrame([(4, 1), (6, 0), (6, 1), (8, 0), (None, 1), (9, None)], "doc_id long, quality int")
    rows = quality_scores(odd_rows, labels).collect()
    assert len(rows) == 15 and len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert quality_scores(no_rows, labels).collect() == []
    assert {r.score for r in quality_scores(odd_rows, labels.limit(0)).collect()} == {0.5}
