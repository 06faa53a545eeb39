import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """Documents from (doc_id, text[, lang, source])."""
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows(make_docs):
    """NULLs in every column, empty, blank and very long texts, repeated rows and ids, and columns
    whose names the operators use themselves."""
    from pyspark.sql import functions as F

    long_text = " ".join(f"w{i}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four"), (6, long_text), (7, long_text),
        (None, "a text whose row has no id at all"), (None, None, None, None), (8, "x" * 100_000),
        (9, "repeated row with some words in it"), (9, "repeated row with some words in it"),
        (10, "same id other text"), (10, "same id another text"), (11, "ünïcödé ñ 漢字 😀 text", None, None),
    ]
    names = ("id", "cls", "score", "size", "shard", "words", "ids", "pii", "matches", "run", "hash", "at", "grp")
    return make_docs(rows).withColumns({n: F.lit(n) for n in names})


@pytest.fixture(scope="session")
def no_rows(make_docs):
    return make_docs([])
