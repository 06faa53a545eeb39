"""Benchmark decontamination by template canonicalisation (operator 4), in DataFrame operations only.

A text becomes a sequence of words in lower case in which numbers, names (capitalised words inside
a sentence) and units behind numbers are typed slots. Windows of ``width`` words, with each slot
reduced to its type, are hashed and joined between benchmark and documents, and the canonical words
compared. Windows of few words besides slots must be equal with their slots' values. Windows that lie on one diagonal (same shift between document and item) must agree on
their slots: a benchmark value has to stand for one document value (two may become the same), so that
re-parameterised questions are found and chance templates are not. Only the windows with a slot that
contradicts this are left out; those without slots or with the benchmark's own values always count.
An item has leaked into a document when the windows that are left cover a share of the item's windows.

The windows of the benchmark are written once and counted; up to ``BROADCAST_ROWS`` of them are
broadcast, beyond that the same join is left to the planner. Where the benchmark has at most
``VOCABULARY`` different words, document windows with any other word are not even hashed; that
saves work and changes no result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

WIDTH, COVERAGE, MIN_LITERALS = 8, 0.25, 4
BROADCAST_ROWS = 500_000
VOCABULARY = 20_000
# Marks in front of typed words, outside of all writing systems.
NUMBER, NAME, UNIT, POINT = "", "", "", ""
# Units that make a slot behind a number. Common written forms.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres mg g kg lb lbs oz "
    "gram grams kilogram kilograms pound pounds ounce ounces ton tons ml cl l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years dollar dollars "
    "cent cents euro euros usd eur percent degree degrees kmh mph hz khz mhz ghz w kw kb mb gb tb"
).split()


def canonical(text: Column) -> Column:
    """Words of a text in lower case; typed words begin with their mark. Decimal and grouping marks
    between digits do not cut a number."""
    marked = F.regexp_replace(text, r"([0-9])[.,]([0-9])", f"$1{POINT}$2")
    marked = F.regexp_replace(marked, r"([\p{Ll}0-9,;] )(\p{Lu})", f"$1{NAME}$2")
    pieces = F.split(F.lower(marked), f"[^\\p{{L}}\\p{{N}}{NAME}{POINT}]+")
    pieces = F.filter(pieces, lambda t: t != "")
    is_number = lambda t: (t >= "0") & (t < ":")
    return F.transform(
        F.array(pieces),
        lambda words: F.transform(
            words,
            lambda t, i: F.when(is_number(t), F.concat(F.lit(NUMBER), t))
            .when((i > 0) & is_number(F.get(words, i - 1)) & t.isin(UNITS), F.concat(F.lit(UNIT), t))
            .otherwise(t),
        ),
    )[0]


def kind(t: Column) -> Column:
    """A word, or the mark of a typed word."""
    return F.when((t >= NUMBER) & (t < POINT), F.substring(t, 1, 1)).otherwise(t)


def _windows(width: int, vocabulary: list[int] | None) -> Column:
    """First place and hash of every window of ``width`` words whose words are all in the vocabulary
    (the array ``known`` tells), or of every window without one."""
    spots = F.sequence(F.lit(0), F.greatest(F.size("hashes") - width, F.lit(0)))
    if vocabulary is not None:
        # The outer words first: most windows are done with after one or two.
        order = sorted(range(width), key=lambda k: -abs(2 * k - width + 1))
        inside = lambda i: reduce(lambda a, b: a & b, [F.get("known", i + k) for k in order])
        spots = F.filter(spots, inside)
    hashed = F.transform(
        spots,
        lambda i: F.struct(i.alias("pos"), F.xxhash64(*[F.get("hashes", i + k) for k in range(width)]).alias("hash")),
    )
    return F.when(F.size("hashes") >= width, hashed).otherwise(F.array().cast("array<struct<pos:int,hash:bigint>>"))


def _with_words(df: DataFrame, text_col: str) -> DataFrame:
    df = df.withColumn("words", canonical(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return df.withColumn("hashes", F.transform("words", lambda t: F.xxhash64(kind(t))))


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """Windows of every item with their length, first place, canonical words and typed words. An
    item of fewer words is one window as a whole. The shape of a window is its words with slots reduced
    to their types; with fewer than ``MIN_LITERALS`` different words besides slots, where chance would
    match that, it is the words themselves (``exact``). Windows of one repeated word that would be
    exact are left out."""
    items = _with_words(benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")), "text")
    items = items.withColumn("width", F.least(F.size("words"), F.lit(width))).where("width > 0")
    spots = F.explode(F.sequence(F.lit(0), F.size("words") - F.col("width")))
    rows = items.select("item_id", "width", "words", spots.alias("at"))
    rows = rows.withColumn("typed", F.expr("slice(words, at + 1, width)"))
    rows = rows.withColumn("shape", F.transform("typed", kind))
    literal = F.size(F.array_distinct(F.filter("shape", lambda t: (t < NUMBER) | (t >= POINT))))
    rows = rows.withColumn("exact", literal < F.least(F.col("width"), F.lit(MIN_LITERALS)))
    rows = rows.where(~F.col("exact") | (F.size(F.array_distinct("typed")) > 1))
    rows = rows.withColumn("shape", F.when(F.col("exact"), F.col("typed")).otherwise(F.col("shape")))
    return rows.groupBy("item_id", "width", "exact", "shape").agg(F.min_by("typed", "at").alias("typed"), F.min("at").alias("at"))


def _known(texts: DataFrame, windows: DataFrame, exact: bool) -> tuple[DataFrame, list[int] | None]:
    """Texts with the hashes that exact or typed windows are made of, and the vocabulary of those
    windows unless it is too large; then also ``known``."""
    terms = windows.where(F.col("exact") == exact).select(F.explode("shape").alias("word"))
    terms = terms.select(F.xxhash64("word").alias("h")).distinct()
    vocabulary = [r.h for r in terms.limit(VOCABULARY + 1).collect()]
    if exact:
        texts = texts.withColumn("hashes", F.transform("words", lambda t: F.xxhash64(t)))
    if len(vocabulary) > VOCABULARY:
        return texts, None
    return texts.withColumn("known", F.transform("hashes", lambda h: h.isin(vocabulary))), vocabulary


def _hashed_shape(width: int) -> Column:
    """Hash of an item's window, made like that of a document's."""
    return F.xxhash64(*[F.xxhash64(F.get("shape", F.lit(k))) for k in range(width)])


def _agreeing() -> Column:
    """Places in the item of a diagonal's ``windows`` whose slots agree with its ``pairs``. A pair of
    equal values always agrees; another one if its benchmark value is in no second pair."""
    once = lambda p: F.size(F.filter("pairs", lambda q: q["theirs"] == p["theirs"])) == 1
    agreeing = F.filter("pairs", lambda p: (p["theirs"] == p["ours"]) | once(p))
    all_agree = F.size(F.array_distinct(F.transform("pairs", lambda p: p["theirs"]))) == F.size("pairs")
    some = F.filter("windows", lambda w: F.size(F.array_except(w["slots"], agreeing)) == 0)
    return F.transform(F.when(all_agree, F.col("windows")).otherwise(some), lambda w: w["at"])


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    coverage: float = COVERAGE,
) -> DataFrame:
    """``id_col``, ``item_id``, ``n_windows`` (different windows of the item that were found),
    ``coverage`` (their share) and ``first_word`` (least word index of a found window), one row for
    each document and item that leaked into it.

    NULL and empty texts have no words and leak nothing, on either side; rows with the same id count
    as one document; an empty benchmark gives no rows. Other columns are not read."""
    windows, _ = written(benchmark_windows(benchmark, item_col, item_text_col, width), "windows")
    # At most two of every width.
    sorts = sorted((r.exact, r.width) for r in windows.select("exact", "width").distinct().collect())
    few = windows.count() <= BROADCAST_ROWS
    totals = windows.groupBy("item_id").agg(F.count("*").alias("total"))
    texts = _with_words(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")
    seen = {exact: _known(texts, windows, exact) for exact in {e for e, _ in sorts} | {False}}
    found = None
    for exact, size in sorts or [(False, width)]:
        words, vocabulary = seen[exact]
        spots = words.select("id", "words", F.inline(_windows(size, vocabulary)))
        asked = windows.where((F.col("exact") == exact) & (F.col("width") == size)).select(
            "item_id", "at", "shape", "typed", _hashed_shape(size).alias("hash")
        )
        hits = spots.join(F.broadcast(asked) if few else asked, "hash")
        hits = hits.withColumn("seen", F.slice("words", F.col("pos") + 1, size))
        # Word by word, not as a second join key, which every window would have to spell out.
        alike = F.forall(F.arrays_zip("seen", "shape"), lambda p: (p["seen"] if exact else kind(p["seen"])) == p["shape"])
        hits = hits.where(alike)
        pairs = F.transform(
            F.filter(F.arrays_zip(F.col("typed").alias("theirs"), F.col("seen").alias("ours")), lambda p: (p["theirs"] >= NUMBER) & (p["theirs"] < POINT)),
            lambda p: F.struct(p["theirs"].alias("theirs"), p["ours"].alias("ours")),
        )
        hits = hits.select("id", "item_id", (F.col("pos") - F.col("at")).alias("shift"), "pos", "at", pairs.alias("slots"))
        found = hits if found is None else found.union(hits)
    # At most as many windows as the item has lie on one diagonal.
    lines = found.groupBy("id", "item_id", "shift").agg(F.collect_set(F.struct("at", "slots")).alias("windows"))
    lines = lines.withColumn("pairs", F.array_distinct(F.flatten(F.transform("windows", lambda w: w["slots"]))))
    lines = lines.select("id", "item_id", "shift", F.explode(_agreeing()).alias("at"))
    covered = lines.groupBy("id", "item_id").agg(
        F.countDistinct("at").alias("n_windows"), F.min(F.col("at") + F.col("shift")).cast("long").alias("first_word")
    )
    out = covered.join(totals, "item_id").withColumn("coverage", F.col("n_windows") / F.col("total"))
    return out.where(F.col("coverage") >= coverage).select(
        F.col("id").alias(id_col), "item_id", "n_windows", "coverage", "first_word"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that a benchmark item leaked into. A row is judged by its own text,
    whatever its id: rows with a NULL id or with one that other texts share are no exception."""
    digest = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    hit = leaks(docs.select(digest.alias("__text"), text_col), benchmark, "__text", text_col)
    return docs.join(hit.select(F.col("__text").alias("__hit")).distinct(), digest == F.col("__hit"), "left_anti")
