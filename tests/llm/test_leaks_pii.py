import hashlib
import random
import re
from datetime import date

import pytest
from compare import connect, spark_rows, sql_rows
from pyspark.sql import functions as F

from coppice.llm import pii
from coppice.llm.decontaminate import NAME, NUMBER, POINT, UNIT, canonical, decontaminate, leaks
from coppice.llm.queries import ORACLES, PII_KEY, QUERIES, op2_pii, op4_decontaminate

KEY = b"k" * 32


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        (1, "A train leaves the station at 10 km per hour and Maria boards it after 3 hours on the way to Paris."),
        (2, "the quick brown fox jumps over the lazy dog while seven grey wolves watch from a distant hill"),
        (3, "5 5 5 5 5 5 5 5 5 5 5 5"),
        (4, "what holds more water than a sponge"),
        (5, None), (6, ""),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_canonical_words(spark):
    text = "It costs 1,000.50 dollars, said Anna Bell of x. Then 3 km on; 12 was v2 A1"
    got = spark.createDataFrame([(text,)], "t string").select(canonical(F.col("t")).alias("w")).first().w
    assert got == ["it", "costs", f"{NUMBER}1{POINT}000{POINT}50", f"{UNIT}dollars", "said", f"{NAME}anna", f"{NAME}bell", "of",
                   "x", "then", f"{NUMBER}3", f"{UNIT}km", "on", f"{NUMBER}12", "was", "v2", f"{NAME}a1"]


def test_leaks(make_docs, items):
    fox = "the quick brown fox jumps over the lazy dog while seven grey wolves watch from a distant hill"
    rows = [
        (10, f"some words before {fox} and after"),
        (11, "Text. A train leaves the station at 75 km per hour and Peter boards it after 8 hours on the way to Rome. More."),
        # One benchmark number stands for two document numbers, and two names for one.
        (12, "the fox jumps over a dog and wolves watch from the hill, nothing else in common"),
        (13, "5 5 5 5 5 5 5 5 5 5 5 5 5 5 5"),
        (14, "What holds, more water than a sponge?"),
        (15, f"{fox.upper()} {fox}"),
        (16, "the quick brown fox jumps over the lazy cat"),
        (17, None),
        (18, fox.replace("seven", "eight")),
    ]
    got = {(r.doc_id, r.item_id): r for r in leaks(make_docs(rows), items).collect()}
    assert set(got) == {(10, 2), (11, 1), (14, 4), (15, 2), (18, 2)}
    assert got[10, 2].coverage == 1.0 and got[10, 2].first_word == 3
    kept = {r.doc_id for r in decontaminate(make_docs(rows), items).collect()}
    assert kept == {12, 13, 16, 17}


def test_slots_must_agree(spark, make_docs):
    item = spark.createDataFrame([(1, "add 7 apples to 9 pears then take 7 plums and 9 figs away from them")], "item_id long, text string")
    rows = [
        (1, "add 3 apples to 4 pears then take 3 plums and 4 figs away from them"),
        (2, "add 3 apples to 4 pears then take 5 plums and 6 figs away from them"),
        (3, "add 3 apples to 3 pears then take 3 plums and 3 figs away from them"),
    ]
    # A benchmark value stands for one document value; two of them may become the same.
    assert sorted(r.doc_id for r in leaks(make_docs(rows), item).collect()) == [1, 3]


def test_one_altered_slot_leaves_the_other_windows(spark, make_docs):
    text = "put 12 apples in the big basket by the old door and walk slowly home then put 12 pears on the table for Maria"
    item = spark.createDataFrame([(1, text)], "item_id long, text string")
    rows = [(1, text), (2, text.replace("12 pears", "13 pears")), (3, text.replace("12 pears", "13 pears").replace("Maria", "Anna"))]
    got = {r.doc_id: (r.n_windows, r.first_word) for r in leaks(make_docs(rows), item).collect()}
    # Of 17 windows, 7 hold the second number.
    assert got == {1: (17, 0), 2: (10, 0), 3: (10, 0)}


def test_items_of_few_literal_words(spark, make_docs):
    sums, names = "What is 12 + 35 * 7 - 3 + 18 * 4 - 9 + 11 * 2?", "the names are Anna, Bert, Carl, Dora, Emil, Frida, Gustav, Hanna, Ida"
    items = spark.createDataFrame([(1, sums), (2, names), (3, "12 35")], "item_id long, text string")
    rows = [
        (1, f"Some text. {sums} And more."), (2, sums.replace("35", "36").replace("18", "19").replace("12", "13")), (3, f"x {names} y"),
        (4, "12 36"), (5, "3 9 12 35 4"),
    ]
    got = {(r.doc_id, r.item_id): (r.n_windows, r.coverage) for r in leaks(make_docs(rows), items).collect()}
    assert got == {(1, 1): (4, 1.0), (1, 3): (1, 1.0), (3, 2): (5, 1.0), (5, 3): (1, 1.0)}


def test_sql_has_the_same_rules(spark, make_docs, tmp_path):
    """Altered slots, merged values, few literal words, repeated words and short items, in one table."""
    import duckdb

    long = "put 12 apples in the big basket by the old door and walk slowly home then put 12 pears on the table for Maria"
    sums, names = "What is 12 + 35 * 7 - 3 + 18 * 4 - 9 + 11 * 2?", "the names are Anna, Bert, Carl, Dora, Emil, Frida, Gustav, Hanna, Ida"
    swap = "add 7 apples to 9 pears then take 7 plums and 9 figs away from them"
    texts = [long, sums, names, swap, "12 35", "5 5 5 5 5 5 5 5 5"]
    docs = [
        long, long.replace("12 pears", "13 pears"), long.replace("12", "40"), f"Some text. {sums} And more.", sums.replace("35", "36"), f"x {names} y",
        swap.replace("7", "3").replace("9", "3"), swap.replace("7", "9"), swap.replace("take 7", "take 8"), "3 9 12 35 4", "5 " * 20, "nothing", None,
        f"{swap} {long}", swap.replace("them", "it") + " " + swap,
    ]
    make_docs(list(enumerate(docs))).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got, want = spark_rows(op4_decontaminate(spark, str(tmp_path))), sql_rows(con, ORACLES["op4_decontaminate"])
    assert got == want and len(got[1]) >= 8


def brute_leaks(docs, items, width=8):
    word = re.compile(r"[^\W_]+")
    grams = {}
    for i, t in items:
        w = word.findall(t.lower())
        for k in range(len(w) - width + 1):
            grams.setdefault(tuple(w[k : k + width]), set()).add(i)
    total = {i: len({g for g, s in grams.items() if i in s}) for i, _ in items}
    out = {}
    for d, t in docs:
        w = word.findall((t or "").lower())
        seen = {}
        for k in range(len(w) - width + 1):
            for i in grams.get(tuple(w[k : k + width]), ()):
                seen.setdefault(i, set()).add(tuple(w[k : k + width]))
        out.update({(d, i): len(s) / total[i] for i, s in seen.items()})
    return out


def test_query_finds_every_passage(spark, sf):
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(*(("doc_id", "text") if t == "documents" else ("item_id", "text"))).collect()]
    want = {k for k, share in brute_leaks(read("documents"), read("benchmark")).items() if share > 0.5}
    got = {(r.doc_id, r.item_id): r.coverage for r in op4_decontaminate(spark, sf).collect()}
    assert want <= set(got) and all(v <= 1 for v in got.values())
    assert len(got) <= len(want) + 3


def test_leaks_of_odd_rows(odd_rows, no_rows, items):
    assert leaks(odd_rows, items).collect() == [] == leaks(no_rows, items).collect()
    assert decontaminate(odd_rows, items.limit(0)).count() == 15


def test_without_broadcast(make_docs, items, monkeypatch):
    from coppice.llm import decontaminate as module

    monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    fox = "the quick brown fox jumps over the lazy dog while seven grey wolves watch from a distant hill"
    assert [(r.doc_id, r.item_id) for r in leaks(make_docs([(1, fox), (2, "x")]), items).collect()] == [(1, 2)]


@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000])
def test_permutation(size):
    assert sorted(pii.permute(i, size, KEY, "t") for i in range(size)) == list(range(size))


def test_formats():
    r = random.Random(2)
    for _ in range(200):
        body = "".join(r.choices("0123456789", k=15))
        card = "4" + body[1:] + pii.luhn_digit("4" + body[1:])
        new = pii.card(card, KEY)
        assert new != card and len(new) == 16 and new[0] == "4" and pii.luhn_digit(new[:-1]) == new[-1]
        assert re.sub(r"\D", "", pii.card(" ".join(re.findall("....", card)), KEY)) == new
        ip = ".".join(str(r.randrange(256)) for _ in range(4))
        assert pii.address(pii.address(ip, KEY), KEY) != ip and all(int(p) < 256 for p in pii.address(ip, KEY).split("."))
        day = date.fromordinal(r.randrange(pii._FIRST_DAY, pii._LAST_DAY)).isoformat()
        assert date.fromisoformat(pii.day(day, KEY))
        phone = pii.phone(f"+1 (2{r.randrange(10, 99)}) 555-{r.randrange(1000, 9999)}", KEY)
        assert re.fullmatch(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", phone)
    assert pii.iban_digits("GB", pii.iban("GB82WEST12345698765432", KEY)[4:]) == pii.iban("GB82WEST12345698765432", KEY)[2:4]
    assert re.fullmatch(r"[0-8]\d\d-\d\d-\d{4}", pii.social("123-45-6789", KEY))
    assert pii.day("31.12.1999", KEY).count(".") == 2


@pytest.mark.parametrize("text", ["1234567812345678", "300.1.2.3", "2023-02-30", "000-12-3456", "GB00WEST12345698765432",
                                  "v1.2.3", "1111111111111111", "7/8", "no data @ all", "tokens = few", "$1,000 in 2020"])
def test_what_does_not_validate_stays(text):
    assert pii.find(text, KEY) == []


@pytest.mark.parametrize("value", ["ES9121000418450200051332", "AT611904300234573201", "BE68 5390 0754 7034", "SE4550000000058398257466",
                                   "PL61109010140000071219812874", "GB82WEST12345698765432", "DE89370400440532013000",
                                   "4111111111111111", "4111 1111 1111 1111", "378282246310005"])
@pytest.mark.parametrize("behind", ["", " en", " bei uns", " mediante", " 12/27", " 27 ES9121000418450200051332", " 5 4111111111111111 x"])
def test_values_end_before_the_next_words(value, behind):
    found = pii.find(f"x {value}{behind}", KEY)
    assert found[0][1:3] == (2, 2 + len(value)) and found[0][0] in ("iban", "card")
    assert found[0][3] == pii.find(value, KEY)[0][3]


@pytest.mark.parametrize("before", ["AWS_SECRET_ACCESS_KEY=", "client_secret: ", "db_password = '", "my-api-key=", "token="])
def test_secrets_behind_a_prefix(before):
    value = "b7db7aa4a5fcc78305"
    assert [f[:3] for f in pii.find(f"x {before}{value} y", KEY)] == [("secret", 2 + len(before), 2 + len(before) + len(value))]


@pytest.mark.parametrize("value, code", [("+44 20 7946 0958", "+44 "), ("+33 1 23 45 67 89", "+33 "), ("+34 912 345 678", "+34 "), ("+49 30 901820", "+49 "),
                                         ("+44 (0)20 7946 0958", "+44 (0)"), ("+442079460958", "+44"), ("+351 21 123 4567", "+351 "), ("+1 (988) 555-1234", "+1 "),
                                         ("+491234567890", "+49")])
@pytest.mark.parametrize("behind", ["", ".", " 6 y", ", 17 y", " 2024-05-06"])
def test_phones_of_other_countries(value, code, behind):
    if behind == " 6 y" and code[:3] in ("+49",):
        return  # numbers of no fixed length
    found = [f for f in pii.find(f"x {value}{behind}", KEY) if f[0] == "phone"]
    assert [f[:3] for f in found] == [("phone", 2, 2 + len(value))]
    new = found[0][3]
    assert new != value and new.startswith(code) and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", value)


def test_phone_keeps_its_digits_in_any_grouping():
    digits = [re.sub(r"\D", "", pii.phone(v, KEY)) for v in ("+44 20 7946 0958", "+442079460958", "+44 2079 460 958")]
    assert len(set(digits)) == 1
    assert pii.find("x +3.14159265 y +12 z +5 apples 2+2", KEY) == []


def test_texts_keep_links_and_all_else(make_docs, odd_rows, no_rows):
    rows = [
        (1, "a élle.42@mail8.example.com, call +1 (988) 555-1234; card 4041894974608795!"),
        (2, "again 4041-8949-7460-8795 and élle.42@mail8.example.com"),
        (3, 'token = "0641917ea4e9feb9cda83477b57ac2654884f485"\npassword=b7db7aa4a5fcc78305 end'),
        (4, "a clean text with 12 apples"),
    ]
    got = {r.doc_id: r for r in pii.pseudonymise(make_docs(rows), "k").collect()}
    kinds = lambda i: [p.kind for p in got[i].pii]
    assert kinds(1) == ["mail", "phone", "card"] and kinds(2) == ["card", "mail"] and kinds(3) == ["secret", "secret"]
    assert got[1].pii[2].pseudonym == got[2].pii[0].pseudonym.replace("-", "") and got[1].pii[0].pseudonym == got[2].pii[1].pseudonym
    assert got[4].text == rows[3][1] and got[4].pii == []
    for i, text in rows:
        back = got[i].text
        for p in got[i].pii:
            assert text[p.start : p.end] not in back and p.pseudonym in back and len(p.pseudonym) in range(p.end - p.start - 9, p.end - p.start + 9)
        frame = re.sub(r"[0-9a-zA-Zß-ÿ]", "", text)
        assert re.sub(r"[0-9a-zA-Zß-ÿ]", "", back) == frame
    other = pii.pseudonymise(make_docs(rows), "other").collect()
    assert {r.text for r in other if r.doc_id < 4}.isdisjoint(r.text for r in got.values())
    odd = pii.pseudonymise(odd_rows, "k")
    assert sorted(map(str, [r.text for r in odd.collect()])) == sorted(map(str, [r.text for r in odd_rows.collect()]))
    assert odd.columns.count("pii") == 1 and pii.pseudonymise(no_rows, "k").collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    got, want = spark_rows(QUERIES[name](spark, sf)), sql_rows(connect(sf), ORACLES[name])
    assert got == want and got[1]


def test_pii_query_equals_plain_rewriting(spark, sf):
    key = hashlib.sha256(PII_KEY.encode()).digest()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op2_pii(spark, sf).collect():
        text = want = texts[r.doc_id]
        found = pii.find(text, key)
        for _, start, end, new in reversed(found):
            want = want[:start] + new + want[end:]
        assert (r.text, r.n_pii, r.kinds) == (want, len(found), ",".join(sorted({f[0] for f in found})))
