import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coppice.llm.byte_bpe import Decoder, Encoder, char_offsets, decode, encode
from coppice.llm.queries import op3_token_counts, op5_byte_bpe
from coppice.llm.token_counts import load, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "", " ", "\n\n  x", "don't you'll 'tis  it''s 'S", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endof", "a" * 3000,
    "ab" * 2000, "  \t indented\r\n", "ñandú 漢字かな交じり文 😀👩‍👩‍👧 é", "\x00\x1c\x85  x", "123456789 1,000.5", "___---===!!!",
]


def random_texts(n):
    r = random.Random(7)
    chars = "aaabcdeéètñ \n\t'.,!0179<|>ßŁ漢😀 _-"
    return ["".join(r.choices(chars, k=r.randrange(200))) for _ in range(n)]


@pytest.fixture(scope="module")
def gold():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_library():
    library = Tokenizer.from_file(JSON)
    texts = TEXTS + random_texts(600)
    merges = load(JSON, P.PATTERN)
    assert merges.tokens(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert merges.tokens(texts[:20]) == merges.tokens(texts)[:20]


def test_counts_query_and_odd_rows(odd_rows, no_rows):
    rows = token_counts(odd_rows, JSON, P.PATTERN).collect()
    library = Tokenizer.from_file(JSON)
    texts = [r.text or "" for r in odd_rows.collect()]
    want = sorted((len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in texts)
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)
    assert token_counts(no_rows, JSON, P.PATTERN).collect() == []


def test_codec_equals_the_library(gold):
    decoder = Decoder(RANKS)
    texts = TEXTS + random_texts(600)
    got = [ids.tolist() for ids in Encoder(RANKS, P.PATTERN).encode(texts)]
    assert got == [gold.encode_ordinary(t) for t in texts]
    for t, ids in zip(texts, got):
        assert decoder.decode(np.array(ids, np.int64)).tobytes() == t.encode()


def test_encode_decode_tables(odd_rows, no_rows, gold):
    both = decode(encode(odd_rows, RANKS, P.PATTERN, offsets=True, round_trip=True), RANKS)
    assert both.where("NOT round_trip").count() == 0
    assert both.columns.count("ids") == 1 and "text" not in both.columns
    rows = both.select("doc_id", "ids", "char_start", "decoded").collect()
    texts = sorted(r.text or "" for r in odd_rows.collect())
    assert sorted(r.decoded for r in rows) == texts
    for r in rows:
        assert list(r.ids) == gold.encode_ordinary(r.decoded)
        assert len(r.char_start) == len(r.ids) and list(r.char_start) == sorted(r.char_start)
    assert encode(no_rows, RANKS, P.PATTERN).collect() == []


def test_offsets_and_split_characters(spark, gold):
    text = "a 😀é漢"
    buf = np.frombuffer(text.encode(), np.uint8)
    assert char_offsets(buf, np.arange(len(buf))).tolist() == [0, 1, 2, 2, 2, 2, 3, 3, 4, 4, 4]
    ids = gold.encode_ordinary("😀 \U0001f9ff")
    cut = spark.createDataFrame([(1, ids[:-1]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r for r in decode(cut, RANKS).collect()}
    assert bytes(got[1].decoded_bytes) == gold.decode_bytes(ids[:-1]) and got[1].decoded.endswith("�")
    assert got[2].decoded == got[3].decoded == ""
    with pytest.raises(Exception, match="not in the rank file"):
        decode(spark.createDataFrame([(1, [70_000])], "doc_id long, ids array<int>"), RANKS).collect()


def test_query_digests(spark, sf, gold):
    rows = {r.doc_id: r for r in op5_byte_bpe(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect():
        ids, r = gold.encode_ordinary(d.text), rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_count_query_equals_the_library(spark, sf):
    library = Tokenizer.from_file(JSON)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op3_token_counts(spark, sf).collect():
        want = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), want, want > 512)
