"""The registered query of each operator, over its whole table, and its SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import decode, encode
from .common import table
from .decontaminate import COVERAGE, MIN_LITERALS, NAME, NUMBER, POINT, UNIT, UNITS, WIDTH, leaks
from .html_extract import extract_text
from .kk_shards import kk_shards
from .license_scan import license_scan
from .merkle import FIELDS, ascii_lower, folded, leaf_digest, merkle_manifest, proof_digest
from .mixing import mix
from .ngram_join import ngram_join
from .pii import pseudonymise
from .quality_gam import quality_scores
from .quality_mcd import quality_rules
from .sql import MERKLE_SQL, MIX_SQL
from .token_counts import token_counts
from .whitening import whiten

# The queries' key for pseudonyms; a job passes its own.
PII_KEY = "coppice"


def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join(table(spark, sf, "documents"))


def op2_pii(spark: SparkSession, sf: str, key: str = PII_KEY) -> DataFrame:
    """Every document with its text rewritten, and how many places of which kinds were changed."""
    found = pseudonymise(table(spark, sf, "documents").select("doc_id", "text"), key)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("pii", lambda p: p["kind"]))), ",")
    return found.select("doc_id", "text", F.size("pii").cast("long").alias("n_pii"), kinds.alias("kinds"))


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf, "documents"), path, public_tokenizers.PATTERN)


def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Encodes and decodes; the digests are derived from the ids and the decoded bytes."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf, "documents").select("doc_id", "text")
    both = decode(encode(docs, path, pattern), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded_bytes", 256).alias("decoded_sha256"),
    )


def op6_quality_gam(spark: SparkSession, sf: str) -> DataFrame:
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_quality_mcd(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules(table(spark, sf, "documents")).drop("distance")


def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Places of the phrases, the labels, and the share of a text's words inside license wording."""
    found = license_scan(table(spark, sf, "documents"))
    base = F.filter("matches", lambda m: m["phrase"])
    starts = F.transform(base, lambda m: m["first"])
    names = lambda m: F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("matches")).alias("labels"),
        (F.col("covered") / F.greatest("n_words", F.lit(1))).alias("score"),
    )


def op9_kk_shards(spark: SparkSession, sf: str) -> DataFrame:
    return kk_shards(table(spark, sf, "documents"))


def op10_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


def op11_merkle(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of the manifest's proofs, and what follows from copies of which some were altered."""
    docs = table(spark, sf, "documents")
    altered = leaf_digest([*[F.col(c) for c in FIELDS[:-1]], ascii_lower(F.col("text"))])
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    found = merkle_manifest(docs, also={"altered": F.when(chosen, altered)})
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_whiten(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(table(spark, sf, "embeddings"))


def op13_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_pii": op2_pii,
    "op3_token_counts": op3_token_counts,
    "op4_decontaminate": op4_decontaminate,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_quality_gam": op6_quality_gam,
    "op7_quality_mcd": op7_quality_mcd,
    "op8_license_scan": op8_license_scan,
    "op9_kk_shards": op9_kk_shards,
    "op10_html_extract": op10_html_extract,
    "op11_merkle": op11_merkle,
    "op12_whiten": op12_whiten,
    "op13_mix": op13_mix,
}


def _canonical_sql(text: str) -> str:
    """Words of a text with typed ones marked, as ``decontaminate.canonical`` has them."""
    marked = f"regexp_replace(coalesce({text}, ''), '([0-9])[.,]([0-9])', '\\1{POINT}\\2', 'g')"
    marked = f"regexp_replace({marked}, '([\\p{{Ll}}0-9,;] )(\\p{{Lu}})', '\\1{NAME}\\2', 'g')"
    pieces = f"list_filter(regexp_split_to_array(lower({marked}), '[^\\p{{L}}\\p{{N}}{NAME}{POINT}]+'), lambda t: t <> '')"
    units = ", ".join(f"'{u}'" for u in UNITS)
    number = lambda t: f"({t} >= '0' AND {t} < ':')"
    return f"""
      (SELECT list_transform(list_zip(ws, list_prepend('', ws)[:len(ws)]), lambda p: CASE
         WHEN {number("p[1]")} THEN '{NUMBER}' || p[1]
         WHEN {number("p[2]")} AND p[1] IN ({units}) THEN '{UNIT}' || p[1] ELSE p[1] END)
       FROM (SELECT {pieces} AS ws))"""


def _kinds_sql(words: str) -> str:
    return f"list_transform({words}, lambda t: CASE WHEN t >= '{NUMBER}' AND t < '{POINT}' THEN t[1] ELSE t END)"


_LITERALS = "len(list_distinct(list_filter({shape}, lambda t: t < '{number}' OR t >= '{point}')))"

LEAKS_SQL = f"""
WITH d AS (SELECT doc_id, {_canonical_sql("text")} AS words FROM documents),
b AS (SELECT item_id, words, least(len(words), {WIDTH}) AS width FROM (SELECT item_id, {_canonical_sql("text")} AS words FROM benchmark)),
bw AS (SELECT item_id, width, spot, words[spot + 1:spot + width] AS typed
       FROM (SELECT *, unnest(range(0, len(words) - width + 1)) AS spot FROM b WHERE width > 0)),
bx AS (SELECT *, {_LITERALS.format(shape="kinds", number=NUMBER, point=POINT)} < least(width, {MIN_LITERALS}) AS exact
       FROM (SELECT *, {_kinds_sql("typed")} AS kinds FROM bw)),
bs AS (SELECT item_id, width, exact, shape, arg_min(typed, spot) AS typed, min(spot) AS spot
       FROM (SELECT *, CASE WHEN exact THEN typed ELSE kinds END AS shape FROM bx WHERE NOT exact OR len(list_distinct(typed)) > 1)
       GROUP BY item_id, width, exact, shape),
dw AS (SELECT doc_id, width, pos, words[pos + 1:pos + width] AS seen
       FROM (SELECT d.*, w.width, unnest(range(0, len(words) - w.width + 1)) AS pos
             FROM d CROSS JOIN (SELECT DISTINCT width FROM bs) w WHERE len(words) >= w.width)),
ds AS (SELECT *, false AS exact, {_kinds_sql("seen")} AS shape FROM dw UNION ALL SELECT *, true AS exact, seen AS shape FROM dw),
hits AS (SELECT doc_id, item_id, pos, spot, pos - spot AS shift,
           list_filter(list_zip(typed, seen), lambda p: p[1] >= '{NUMBER}' AND p[1] < '{POINT}') AS slots
         FROM ds JOIN bs USING (width, exact, shape)),
lines AS (SELECT doc_id, item_id, shift, list_distinct(flatten(list(slots))) AS pairs FROM hits GROUP BY doc_id, item_id, shift),
kept AS (SELECT doc_id, item_id, pos, spot FROM hits JOIN lines USING (doc_id, item_id, shift)
         WHERE len(list_filter(slots, lambda p: p[1] <> p[2] AND len(list_filter(pairs, lambda q: q[1] = p[1])) > 1)) = 0),
n AS (SELECT doc_id, item_id, count(DISTINCT spot) AS n_windows, CAST(min(pos) AS BIGINT) AS first_word FROM kept GROUP BY ALL),
t AS (SELECT item_id, count(*) AS total FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n_windows, n_windows / total AS coverage, first_word
FROM n JOIN t USING (item_id) WHERE n_windows / total >= {COVERAGE}
"""
ORACLES: dict[str, str] = {
    "op4_decontaminate": LEAKS_SQL,
    "op11_merkle": MERKLE_SQL,
    "op13_mix": MIX_SQL,
}
