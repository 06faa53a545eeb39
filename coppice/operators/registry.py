"""Model versions, aliases and runs as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHAMPION = "champion"
# A model reference is models:/<name>/<version> or models:/<name>@<alias>.
_VERSION_URI = r"^models:/(.+)/(\d+)$"
_ALIAS_URI = r"^models:/(.+)@([^@/]+)$"


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """Value of the highest step per run and key."""
    top = F.max(F.struct("step", "value"))
    return metrics.groupBy("run_id", "key").agg(top.alias("m")).select(
        "run_id", "key", "m.step", "m.value"
    )


def latest_version(versions: DataFrame, *names: str) -> DataFrame:
    """Highest version per model, compared as a number also where it is stored as text."""
    if names:
        versions = versions.where(F.col("name").isin(*names))
    return versions.groupBy("name").agg(F.max(F.col("version").cast("int")).alias("version"))


def next_version(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """Version each model name would get next; 1 for a new name."""
    known = latest_version(versions).withColumnRenamed("version", "_last")
    return requests.join(known, "name", "left").select(
        "name", (F.coalesce(F.col("_last"), F.lit(0)) + 1).cast("int").alias("version")
    )


def alias_current(aliases: DataFrame) -> DataFrame:
    """Where each alias points: its entry with the largest ``seq``."""
    top = F.max(F.struct("seq", "version"))
    return aliases.groupBy("name", "alias").agg(top.alias("a")).select(
        "name", "alias", F.col("a.version").cast("int").alias("version"), "a.seq"
    )


def resolve_uri(
    requests: DataFrame,
    versions: DataFrame,
    aliases: DataFrame,
    default_name: Column | str,
    uri: str = "uri",
) -> DataFrame:
    """Version behind each model reference, with how it was found.

    ``models:/<name>/<version>`` and ``models:/<name>@<alias>`` are explicit; an empty
    reference means the champion of ``default_name``. Where the version or alias does
    not exist, the latest version is taken. ``version`` is NULL when the model has none.
    """
    ref = F.coalesce(F.trim(F.col(uri)), F.lit(""))
    default = F.lit(default_name) if isinstance(default_name, str) else default_name
    by_version = F.regexp_extract(ref, _VERSION_URI, 2) != ""
    parsed = requests.withColumns({
        "name": F.when(ref == "", default)
        .when(by_version, F.regexp_extract(ref, _VERSION_URI, 1))
        .otherwise(F.regexp_extract(ref, _ALIAS_URI, 1)),
        "_wanted": F.when(by_version, F.regexp_extract(ref, _VERSION_URI, 2).try_cast("int")),
        "alias": F.when(ref == "", F.lit(CHAMPION)).when(
            ~by_version, F.regexp_extract(ref, _ALIAS_URI, 2)
        ),
    })
    exact = versions.select("name", F.col("version").cast("int").alias("_wanted")).distinct()
    exact = exact.withColumn("_exact", F.col("_wanted"))
    pointed = alias_current(aliases).select("name", "alias", F.col("version").alias("_alias_version"))
    last = latest_version(versions).withColumnRenamed("version", "_last")
    found = (
        parsed.join(exact, ["name", "_wanted"], "left")
        .join(pointed, ["name", "alias"], "left")
        .join(last, "name", "left")
    )
    chosen = F.coalesce("_exact", "_alias_version")
    return found.select(
        *requests.columns,
        "name",
        F.coalesce(chosen, F.col("_last")).alias("version"),
        F.when(F.col("_exact").isNotNull(), "version")
        .when(F.col("_alias_version").isNotNull(), "alias")
        .when(F.col("_last").isNotNull(), "latest")
        .otherwise("missing")
        .alias("found_by"),
    )


def serving_version(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """The version asked for, else the latest one of that model."""
    last = latest_version(versions).withColumnRenamed("version", "_last")
    return requests.join(last, "name", "left").select(
        *requests.columns,
        F.coalesce(F.col("requested").try_cast("int"), F.col("_last")).alias("version"),
    )


def run_states(runs: DataFrame) -> DataFrame:
    """The last logged row of each run: its present status, next to when it began."""
    last = F.max(F.struct("started_at", "status", "run_name", "parent_run_id"))
    return runs.groupBy("run_id").agg(last.alias("r"), F.min("started_at").alias("began_at")).select(
        "run_id", "r.parent_run_id", "r.run_name", "r.status", "began_at", F.col("r.started_at").alias("changed_at")
    )


def child_runs(runs: DataFrame) -> DataFrame:
    """Each run next to its parent."""
    parents = runs.select(
        F.col("run_id").alias("parent_run_id"), F.col("run_name").alias("parent_name")
    ).distinct()
    return runs.where("parent_run_id IS NOT NULL").join(parents, "parent_run_id").select(
        "parent_run_id", "parent_name", "run_id", "run_name", "status"
    )


def compare_trials(runs: DataFrame, metrics: DataFrame, *keys: str) -> DataFrame:
    """Latest metrics of every child run side by side, with its ``rank`` under its parent by
    the first key (highest first, then by run name)."""
    values = metrics.where(F.col("key").isin(*keys)).groupBy("run_id").agg(
        *[
            F.max(F.when(F.col("key") == k, F.struct("step", "value"))).getField("value").alias(k)
            for k in keys
        ]
    )
    best = W.partitionBy("parent_run_id").orderBy(F.col(keys[0]).desc_nulls_last(), "run_name", "run_id")
    # A run that was logged again is one run.
    children = child_runs(runs).dropDuplicates(["parent_run_id", "run_id"])
    return children.join(values, "run_id", "left").select(
        "parent_run_id", "run_id", "run_name", *keys, F.row_number().over(best).alias("rank")
    )
