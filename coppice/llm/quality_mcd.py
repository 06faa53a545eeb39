"""Quality rules with robust multivariate outliers (operator 7), in DataFrame operations only.

Counts of words, symbols, repeated lines and repeated word windows give each text a vector of
transformed statistics. For each language and source the minimum covariance determinant estimate of
centre and scatter is searched: from several starts, concentration steps (keep the share of rows with
the smallest distances, take their mean and covariance, and go on from those) run until no
determinant falls any more, and of the estimates so reached that of the least determinant counts.
A row is rejected when its squared Mahalanobis distance passes a cut-off.

All starts of all groups share each pass. The rows of a step are those up to a bucket of the distance
(one per cent wide), found by counting, so that a step is two aggregates with partial sums and a
source that holds a third of all rows costs no more than its rows. Estimates are one row for each
group and are broadcast while they are few; rows never meet them by a shuffle of their group.
Groups of fewer than ``MIN_GROUP`` rows are estimated together with the other small ones of their
language, and where those are too few, with all such. Statistics are written to the folder of
``spark.checkpoint.dir`` once; each step writes one row per group and start.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import remove, written

WINDOW, MIN_WORDS, MAX_REPEAT = 5, 10, 20
PRIOR_WORDS = 20
SHARE, MIN_GROUP = 0.75, 100
# Steps end when no log determinant falls by more than this, or after so many.
SETTLED, MOST_STEPS = 1e-3, 20
# Squared distance beyond which a row is rejected: about the 1 - 3e-6 quantile of chi-square with 5
# degrees of freedom, as lengths and shares have longer tails than a normal distribution.
CUTOFF = 34.0
# What the scatter of a subset of this share falls short of for normal rows with 5 statistics.
SCALE_UP = 1.41
# Least standard deviation of each statistic, so that a constant one does not reject all else. Each is
# small enough to let its statistic pass the cut-off alone: 36 % repeated lines, 19 % repeated words of
# a long text.
VECTOR = {"log_words": 0.35, "word_length": 0.08, "symbol_share": 0.3, "line_share": 0.062, "repeat_share": 0.032}
NAMES = tuple(VECTOR)
# Starts: medians with absolute deviations, mean and covariance of all rows, and the covariance of the
# directions from the medians, which no far row can dominate.
STARTS = ("medians", "moments", "directions")
# Squared distances are counted in steps of 1 / BUCKETS of their logarithm, from LEAST_D2 up.
BUCKETS, LEAST_D2 = 100, 1e-3
# Groups and starts whose estimates are broadcast: some 300 bytes each.
BROADCAST_GROUPS = 50_000
_SPACE = r"[\x20\x09-\x0D]+"
_PLACE_BITS = 28


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _flagged(hashes: Column, shift: int) -> Column:
    """Places whose 36 hash bits above bit ``28 - shift`` occur more than once."""
    packed = F.transform(
        hashes,
        lambda h, i: F.shiftleft(F.shiftright(F.shiftleft(h, shift), _PLACE_BITS), _PLACE_BITS).bitwiseOR(i.cast("long")),
    )
    top = lambda x: F.shiftright(x, _PLACE_BITS)
    again = lambda s: F.filter(
        s, lambda x, i: (top(x) == top(F.get(s, i - 1))) | (top(x) == top(F.get(s, i + 1)))
    )
    kept = _let(F.sort_array(packed), again)
    return F.transform(kept, lambda x: x.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))


def _covered(places: Column) -> Column:
    """Words inside windows that start at the given places."""
    gaps = lambda p: F.transform(p, lambda x, i: F.least(F.lit(WINDOW).cast("long"), F.coalesce(x - F.get(p, i - 1), F.lit(WINDOW))))
    return F.aggregate(_let(F.sort_array(places), gaps), F.lit(0).cast("long"), lambda a, x: a + x)


def counts(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """``id``, the columns ``keep`` and the counts of every row; a NULL text has none of anything."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).alias("id"), *keep, text.alias("text"))
    df = df.withColumn("words", F.filter(F.split("text", _SPACE), lambda w: w != ""))
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    spots = F.sequence(F.lit(0), F.size("hashes") - WINDOW)
    window = F.transform(spots, lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)]))
    windows = F.when(F.size("hashes") >= WINDOW, window).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("windows", windows)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("lines", lines)
    # Sorting is for texts that repeat a window at all; equality in both halves of the hash is meant.
    repeated = F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0).cast("long")).otherwise(
        _covered(F.array_intersect(_flagged(F.col("windows"), 0), _flagged(F.col("windows"), _PLACE_BITS)))
    )
    return df.select(
        "id",
        *keep,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def _vector() -> list[Column]:
    # Shares of short texts are drawn towards nothing, their word length towards a usual one.
    share = lambda part, whole, prior: F.col(part) / (F.col(whole) + prior)
    return [
        F.log1p("n_words").alias("log_words"),
        F.log((F.col("word_chars") + 5 * PRIOR_WORDS) / (F.col("n_words") + PRIOR_WORDS)).alias("word_length"),
        F.log1p(100 * share("n_symbols", "word_chars", 5 * PRIOR_WORDS)).alias("symbol_share"),
        share("n_dup_lines", "n_lines", 1).alias("line_share"),
        share("n_repeat_words", "n_words", PRIOR_WORDS).alias("repeat_share"),
    ]


def _grouped(rows: DataFrame, lang: str, source: str) -> tuple[DataFrame, str]:
    """Adds ``grp``, the group whose estimate a row is held against; NULL where its language and source have
    no usable row. Also the path of the group sizes below it."""
    key = lambda *parts: F.to_json(F.array(*parts))
    fine = key(F.col(lang).cast("string"), F.col(source).cast("string"))
    middle, coarse = key(F.col(lang).cast("string")), F.lit("*")
    rows = rows.withColumn("fine", fine).withColumn("middle", middle)
    sizes, path = written(rows.where("usable").groupBy("fine", "middle").agg(F.count("*").alias("n")), "sizes")
    pooled = sizes.where(F.col("n") < MIN_GROUP).groupBy("middle").agg(F.sum("n").alias("m"))
    names = sizes.join(pooled, "middle", "left").select(
        "fine",
        F.when(F.col("n") >= MIN_GROUP, F.col("fine")).when(F.col("m") >= MIN_GROUP, F.col("middle")).otherwise(coarse).alias("grp"),
    )
    names = _known(names, sizes.count())
    return rows.join(names, "fine", "left").drop("fine", "middle"), path


def _known(table: DataFrame, rows: int) -> DataFrame:
    """A table of one row per group for a join: broadcast while it is small, else dealt out, where the
    adaptive join splits large groups."""
    return F.broadcast(table) if rows <= BROADCAST_GROUPS else table


_PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def _distance(rows: DataFrame) -> DataFrame:
    """Adds ``d2`` to rows that carry centre ``m_*`` and Cholesky factor ``l_*``: the squared length
    of the solution of the triangular system."""
    for i, name in enumerate(NAMES):
        known = [F.col(f"l_{i}_{j}") * F.col(f"y_{j}") for j in range(i)]
        rest = reduce(lambda a, b: a - b, known, F.col(name) - F.col(f"m_{i}"))
        rows = rows.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
    d2 = reduce(lambda a, b: a + b, [F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(len(NAMES))])
    return rows.withColumn("d2", d2).drop(*[f"y_{i}" for i in range(len(NAMES))])


def _factors(estimate: DataFrame) -> DataFrame:
    """Cholesky factors of the covariances ``c_*`` and ``log_det``. A variance below the least one of its
    statistic is taken as that; what is added to a diagonal keeps the matrix positive definite."""
    p = len(NAMES)
    for i in range(p):
        estimate = estimate.withColumn(f"c_{i}_{i}", F.greatest(f"c_{i}_{i}", F.lit(VECTOR[NAMES[i]] ** 2)))
    for j in range(p):
        for i in range(j, p):
            rest = F.col(f"c_{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            # Collinear statistics leave nothing but rounding; a thousandth of the least variance stays.
            root = F.sqrt(F.greatest(rest, F.lit(1e-3 * VECTOR[NAMES[i]] ** 2)))
            estimate = estimate.withColumn(f"l_{i}_{j}", root if i == j else rest / F.col(f"l_{j}_{j}"))
    log_det = reduce(lambda a, b: a + b, [2 * F.log(F.col(f"l_{i}_{i}")) for i in range(p)])
    return estimate.withColumn("log_det", log_det).drop(*[f"c_{i}_{j}" for i, j in _PAIRS])


def _middle(rows: DataFrame, values: list[Column]) -> DataFrame:
    """``q_*``: the middle value of each of ``values`` in every group, to a thousandth, by counting."""
    steps = [F.floor(v * 1000).cast("long") for v in values]
    cells = rows.select("grp", F.posexplode(F.array(*steps)).alias("i", "cell")).groupBy("grp", "i", "cell").agg(F.count("*").alias("n"))
    of = Window.partitionBy("grp", "i")
    upto = cells.withColumn("upto", F.sum("n").over(of.orderBy("cell"))).withColumn("all", F.sum("n").over(of))
    middles = upto.where(F.col("upto") * 2 >= F.col("all")).groupBy("grp", "i").agg((F.min("cell") / 1000).alias("q"))
    return middles.groupBy("grp").agg(*[F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q_{i}") for i in range(len(values))])


def _starts(rows: DataFrame, groups: int) -> tuple[DataFrame, str]:
    """The first estimates of every group, one row for each start, stored."""
    p = range(len(NAMES))
    centre, centre_path = written(_middle(rows, [F.col(n) for n in NAMES]).select("grp", *[F.col(f"q_{i}").alias(f"m_{i}") for i in p]), "centre")
    around = rows.join(_known(centre, groups), "grp")
    off = [F.col(n) - F.col(f"m_{i}") for i, n in enumerate(NAMES)]
    spread = _middle(around, [F.abs(x) for x in off])
    diagonal = [(F.pow(1.4826 * F.col(f"q_{i}"), 2) if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in _PAIRS]
    # Every statistic counts alike in a direction: it is taken in units of its least deviation.
    units = [x / VECTOR[n] for x, n in zip(off, NAMES)]
    length = F.greatest(F.sqrt(reduce(lambda a, b: a + b, [u * u for u in units])), F.lit(1e-9))
    turned = around.select("grp", *[F.col(f"m_{i}") for i in p], *[(u / length * VECTOR[n]).alias(f"u_{i}") for i, (u, n) in enumerate(zip(units, NAMES))])
    found = [
        spread.join(_known(centre, groups), "grp").select("grp", *[f"m_{i}" for i in p], *diagonal),
        rows.groupBy("grp").agg(*[F.avg(n).alias(f"m_{i}") for i, n in enumerate(NAMES)],
                                *[F.covar_pop(NAMES[i], NAMES[j]).alias(f"c_{i}_{j}") for i, j in _PAIRS]),
        turned.groupBy("grp").agg(*[F.max(f"m_{i}").alias(f"m_{i}") for i in p],
                                  *[F.avg(F.col(f"u_{i}") * F.col(f"u_{j}")).alias(f"c_{i}_{j}") for i, j in _PAIRS]),
    ]
    named = [_factors(f).withColumn("start", F.lit(k)) for k, f in enumerate(found)]
    estimate = written(reduce(DataFrame.unionByName, named), "estimate")
    remove(rows.sparkSession, centre_path)
    return estimate


def _concentrate(rows: DataFrame, estimate: DataFrame, groups: int) -> DataFrame:
    """One step: mean and covariance of the rows nearest to each estimate."""
    measured = _distance(rows.join(_known(estimate, groups), "grp")).withColumn(
        "bucket", F.floor(F.log(F.col("d2") + LEAST_D2) * BUCKETS).cast("int")
    )
    of = Window.partitionBy("grp", "start")
    upto = measured.groupBy("grp", "start", "bucket").agg(F.count("*").alias("n"))
    upto = upto.withColumn("upto", F.sum("n").over(of.orderBy("bucket"))).withColumn("all", F.sum("n").over(of))
    limit = upto.where(F.col("upto") >= SHARE * F.col("all")).groupBy("grp", "start").agg(F.min("bucket").alias("limit"))
    near = measured.join(_known(limit, groups), ["grp", "start"]).where("bucket <= limit")
    cov = [(SCALE_UP * F.covar_pop(NAMES[i], NAMES[j])).alias(f"c_{i}_{j}") for i, j in _PAIRS]
    return _factors(near.groupBy("grp", "start").agg(*[F.avg(n).alias(f"m_{i}") for i, n in enumerate(NAMES)], *cov))


def minimum_determinant(rows: DataFrame) -> tuple[DataFrame, int]:
    """Estimate (``grp``, ``m_*``, ``l_*``, ``log_det``) of every group of ``rows`` (``grp`` and the statistics),
    and the number of groups. Of equal determinants the first start counts."""
    spark = rows.sparkSession
    groups = rows.select("grp").distinct().count()
    estimate, path = _starts(rows, groups)
    for step in range(MOST_STEPS):
        new = _concentrate(rows, estimate, groups)
        if step:
            # The starts themselves are of other subsets; from the first step on, an estimate is given up
            # only for one of a smaller determinant, and stays where there is none.
            columns = [c for c in new.columns if c not in ("grp", "start")]
            both = new.select("grp", "start", F.struct(*columns).alias("new")).join(
                estimate.select("grp", "start", F.struct(*columns).alias("old")), ["grp", "start"]
            )
            falls = F.col("new.log_det") < F.col("old.log_det") - SETTLED
            chosen = F.when(falls, F.col("new")).otherwise(F.col("old"))
            new = both.select("grp", "start", chosen.alias("e"), falls.alias("falls")).select("grp", "start", "e.*", "falls")
        new, new_path = written(new, "estimate")
        going_on = not step or new.where("falls").limit(1).count()
        remove(spark, path)
        estimate, path = new.drop("falls"), new_path
        if not going_on:
            break
    first = Window.partitionBy("grp").orderBy(F.round("log_det", 9), "start")
    return estimate.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth", "start"), groups


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    cutoff: float = CUTOFF,
) -> DataFrame:
    """``id_col``, the counts, ``base_failed``, ``kept`` and ``distance`` (squared) of every row.

    A NULL or empty text has no words and fails the base rule. NULL languages and sources are groups
    of their own; NULL and repeated ids keep one row each; other columns are not read. Rows that fail
    the base rule do not enter estimates; where a group has none but such rows, their distance is NULL."""
    spark = docs.sparkSession
    kept = docs.select(id_col, text_col, F.col(lang_col).alias("__lang"), F.col(source_col).alias("__source"))
    rows = counts(kept, id_col, text_col, ["__lang", "__source"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn("usable", ~failed)
    rows, rows_path = written(rows.select("*", *_vector()), "statistics")
    grouped, sizes_path = _grouped(rows, "__lang", "__source")
    rows, _ = written(grouped, "groups")
    remove(spark, rows_path)
    remove(spark, sizes_path)
    estimate, groups = minimum_determinant(rows.where("usable").select("grp", *NAMES))
    measured = _distance(rows.join(_known(estimate, groups), "grp", "left"))
    return measured.select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= cutoff)).alias("kept"),
        F.col("d2").alias("distance"),
    )
