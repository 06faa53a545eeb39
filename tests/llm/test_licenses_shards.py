import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from coppice.llm.kk_shards import difference, difference_sizes, kk_shards
from coppice.llm.license_scan import Scanner, compile_template, license_scan
from coppice.llm.license_texts import PHRASES, TEMPLATES
from coppice.llm.queries import op8_license_scan, op9_kk_shards

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def places(words):
    out = []
    for label, phrase in PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return out


def test_query_equals_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op8_license_scan(spark, sf).collect():
        words = WORD.findall(lowered(texts[r.doc_id]))
        found = places(words)
        starts = [i for i, _ in found]
        base = sorted({label for _, label in found})
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(found), ",".join(base))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert set(base) <= set(r.labels.split(",")) | (set() if base else {""}) and 0 <= r.score <= 1


def labels(text):
    scanner = Scanner(PHRASES, TEMPLATES)
    return {scanner.automata[k].label for k, _, _ in scanner.scan(lowered(text).encode())}


def test_templates():
    mit = re.sub(r"\[\[.*?\]\]", "", TEMPLATES["mit"])
    assert labels(mit.replace("{{holder:12}}", "THE AUTHORS OR COPYRIGHT HOLDERS")) == {"mit"}
    assert labels(mit.replace("{{holder:12}}", "")) == {"mit"}
    assert labels(mit.replace("{{holder:12}}", "x " * 13)) == set()
    assert labels(mit.replace("{{holder:12}}", "x").replace("free of charge", "for a fee")) == set()
    assert labels("licensed under the GNU General Public License, version 3.") == {"gpl-3"}
    assert labels("GNU General Public License as published by the Free Software Foundation, either version 2") == {"gpl-2"}
    assert labels("the general public licence version 3") == set()
    assert labels("Licensed under the Apache License, Version 2.0") == {"apache-2"}
    assert labels("a clean text about a public park and a fishing license") == set()


def _written_out(markup):
    """A text with every optional region, the first of alternatives, and some words for the replaceable ones."""
    markup = re.sub(r"!!.*", "", markup, flags=re.S)
    markup = re.sub(r"<<([^|<>]*)\|[^<>]*>>", r"\1", markup)
    return re.sub(r"\{\{(\w+):\d+\}\}", r"Some \1", markup).replace("[[", "").replace("]]", "")


def _mandatory(markup):
    """Number of each word of the written text that no region holds."""
    plain = re.sub(r"!!.*", "", markup, flags=re.S)
    while re.search(r"\[\[[^\[\]]*\]\]", plain):
        plain = re.sub(r"\[\[[^\[\]]*\]\]", " ", plain)
    plain = re.sub(r"<<[^<>]*>>|\{\{.*?\}\}", " ", plain)
    return set(WORD.findall(lowered(plain)))


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_whole_texts_have_their_own_label(name):
    text = _written_out(TEMPLATES[name])
    assert labels("Some words before. " + text + " And words behind.") == {name} | ({"apache-2"} if name == "apache-2" else set())
    fixed = sorted(_mandatory(TEMPLATES[name]))
    for word in random.Random(3).sample(fixed, min(8, len(fixed))):
        changed = re.sub(rf"(?i)(?<![a-z0-9]){re.escape(word)}(?![a-z0-9])", "changed", text)
        assert name not in labels(changed) or name in PHRASES, word


def test_versions_are_told_apart():
    assert labels("GNU General Public License version 2.1") == set()
    assert labels("GNU General Public License, version 2.0") == {"gpl-2"}
    assert labels("GNU Lesser General Public License version 3") == {"lgpl-3"}
    assert labels("the GNU Library General Public License, version 2.1 of it") == {"lgpl-2.1"}
    bsd3 = _written_out(TEMPLATES["bsd-3-clause"])
    assert labels(bsd3) == {"bsd-3-clause"} and labels(bsd3.replace("Neither", "Either")) == set()
    assert labels(_written_out(TEMPLATES["bsd-2-clause"])) == {"bsd-2-clause"}


def test_alternatives_and_barred_words():
    a = compile_template("t", "start <<one|two [[or so]]|{{x:2}} three>> end !!not")
    accepts = lambda s: any(i == 0 for _, i, e in _scan(a, s))
    for s in ("start one end", "start two end", "start two or so end", "start a b three end", "start three end now"):
        assert accepts(s), s
    for s in ("start end", "start one two end", "start two or end", "start one end not", "start a b c three end"):
        assert not accepts(s), s
    for bad in ("a <<b", "a <<b]]", "a b>>", "a [[b|c]]", "<<a|b>>"):
        with pytest.raises(ValueError):
            compile_template("t", bad)


def test_automaton_regions():
    a = compile_template("t", "start [[maybe [[deep]] so]] {{x:2}} end")
    accepts = lambda s: any(e == len(s.split()) - 1 and i == 0 for _, i, e in _scan(a, s))
    for s in ("start end", "start maybe so end", "start maybe deep so end", "start a b end", "start maybe so a end"):
        assert accepts(s), s
    for s in ("start maybe end x", "start a b c end", "begin end", "start maybe deep a b c end"):
        assert not accepts(s), s
    for bad in ("a [[b", "[[a]]"):
        with pytest.raises(ValueError):
            compile_template("t", bad)


def _scan(automaton, text):
    scanner = Scanner({}, {})
    scanner.automata, scanner.anchors = [automaton], [max(automaton.required, key=len)]
    scanner.begin = {w: [0] for w in automaton.first_words()}
    return scanner.scan(text.encode())


def test_scan_of_odd_rows(odd_rows, no_rows, make_docs):
    rows = license_scan(odd_rows).collect()
    assert sorted(r.n_words for r in rows) == sorted(len(WORD.findall(lowered(r.text))) for r in odd_rows.collect())
    assert all(r.matches == [] and r.covered == 0 for r in rows)
    assert license_scan(no_rows).collect() == []
    got = license_scan(make_docs([(1, "x Under the MIT license, cc-by-nc under the mit license")])).first()
    assert [(m.label, m.first, m.last) for m in got.matches] == [("mit", 1, 4), ("cc-by-nc", 5, 7), ("mit", 8, 11)]
    assert got.covered == 11


def test_differencing():
    totals, place = difference_sizes([8, 7, 6, 5, 4], 2)
    assert sorted(totals) == [14, 16]
    r = random.Random(1)
    for shards in (2, 3, 7):
        sizes = [r.randrange(1, 1000) for _ in range(200)]
        totals, place = difference_sizes(sizes, shards)
        again = [sum(s for s, p in zip(sizes, place) if p == k) for k in range(shards)]
        assert again == totals.tolist() and max(again) - min(again) <= 20
    totals, places = difference([np.array([5, 1, 0]), np.array([4, 4, 0])])
    assert sorted(totals) == [4, 5, 5] and all(sorted(p) == [0, 1, 2] for p in places)


def check(rows, texts, shards=40):
    """Sizes, checksums, gapless slots; returns bytes per shard."""
    load, slots, shard_of = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, crc32(raw), "bytes", None)
        assert 0 <= r.shard < shards
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        shard_of[raw].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load, shard_of


def test_shards_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_kk_shards(spark, sf).collect()
    assert len(rows) == len(texts)
    _, shard_of = check(rows, texts)
    share = sum(r["size"] for r in rows) / 40
    for raw, used in shard_of.items():
        if sum(len(raw) + 16 for r in rows if r.text_crc32 == crc32(raw)) <= share:
            assert len(used) == 1


def test_hot_group_is_split(make_docs):
    r = random.Random(4)
    rows = [(i, "same text " * 20) for i in range(1500)]
    rows += [(2000 + i, "x" * r.randrange(10, 400)) for i in range(3000)]
    load, shard_of = check(kk_shards(make_docs(rows), 8).collect(), dict(rows), 8)
    assert max(load.values()) / min(load.values()) < 1.2
    assert sum(len(s) > 1 for s in shard_of.values()) == 1


def test_shards_of_odd_rows(odd_rows, no_rows):
    rows = kk_shards(odd_rows, 4).collect()
    assert len(rows) == 15 and sorted(r["size"] for r in rows) == sorted(len((r.text or "").encode()) + 16 for r in odd_rows.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert kk_shards(no_rows).collect() == []
