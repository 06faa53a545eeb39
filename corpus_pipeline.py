"""A corpus pipeline of five stages, each over all that the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes it as Parquet
below the folder of ``spark.checkpoint.dir`` and the next stage reads that. All stages but the last
return the columns of ``documents``.

=====================  ==============================================================
``quality``            keeps documents that the additive classifier takes for good
``near_duplicates``    keeps of every group of near duplicates the one of least id
``decontaminate``      drops documents that a benchmark item leaked into
``pii``                rewrites personal data by pseudonyms; ``n_chars`` follows the text
``encode``             ids of the byte-level BPE, and a check that they decode to the text
=====================  ==============================================================

Rows: a NULL or empty text has statistics of zero and is judged as such; it is near to no other
document and holds no benchmark item. Every row is judged by itself, also where ids are NULL or
repeated: of each group of near duplicates exactly one row stays, that of the least id (rows without
an id last, of equal ids any one).

``pii`` takes its key from the setting ``spark.coppice.pii.key``. Where that is unset, a new random key is
drawn for the run and kept nowhere: equal values are linked within the run, and nobody can undo it.
"""

from __future__ import annotations

import secrets

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.llm.byte_bpe import encode
from coppice.llm.common import table
from coppice.llm.decontaminate import decontaminate as without_leaks
from coppice.llm.ngram_join import ngram_join
from coppice.llm.pii import pseudonymise
from coppice.llm.quality_gam import quality_scores
from coppice.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (operator 6) predicts as label 1. A score follows from the text."""
    digest = F.md5(F.coalesce("text", F.lit("")))
    scores = quality_scores(docs, table(spark, sf_dir, "labels"), carry={"__digest": digest})
    rejected = scores.where("predicted = 0").select(F.col("__digest").alias("__rejected")).distinct()
    return docs.join(rejected, digest == F.col("__rejected"), "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the n-gram join (operator 1). Rows get a number of their own, stored
    with them; the least key of a component, with the id before the number, is the row that stays."""
    rows, _ = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("__row").alias("row"))
    members = ngram_join(rows.select(key.alias("__key"), "text"), id_col="__key")
    dropped = members.where("__key != component_id").select(F.col("__key.row").alias("__dropped"))
    return rows.join(dropped, F.col("__row") == F.col("__dropped"), "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items (operator 4)."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms for personal data (operator 2)."""
    key = spark.conf.get("spark.coppice.pii.key", None) or secrets.token_hex(32)
    out = pseudonymise(docs, key).drop("pii")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids (operator 5); ``round_trip`` tells that the ids decode to the text."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode(docs, path, pattern, round_trip=True)
    return encoded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "round_trip"
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("encode", encode_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = written(stage(spark, docs, sf_dir), name)
    return docs


# A trained classifier, an iterated join and a tokenizer have no SQL counterpart.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
