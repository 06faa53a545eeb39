"""One query per operator on the shared tables.

Inputs that the pipeline would produce itself (runs, versions, trial results, requests)
are derived from those tables, row by row, so that every query grows with its input.
"""

from __future__ import annotations

from functools import reduce
from types import SimpleNamespace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import row_hash
from ..functions.proba import argmax, confidence, fixed_point, gradient, hessian, softmax
from ..operators import blocks, grid, histogram, labels, metrics, registry, sampling, split, splits
from ..operators.binning import bin_features, edges_by_feature, quantile_edges
from ..operators.scoring import score, score_native
from ..session import new_path
from ..sources import features as feat
from ..sources import files
from ..sources.store import SCHEMAS, Store
from ..streaming import serve
from .inference import batch_inference as run_batch_inference
from .inference import score_model
from .ovr import predict_ovr, train_ovr
from .search import run_search
from .train import TrainParams, boost, prepare, train

Y3_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
N_CLASS, N_FEATURES = 3, 4
HIST_BINS = 32
SCALE = 2.0**20
TRACKED = ("A", "N", "R")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def line_key():
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    return feat.composite_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)


def y3_label():
    return (F.col("l_quantity") > 25).cast("int") + (F.col("l_discount") > 0.05).cast("int")


def lineitem_y3(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a class that two of the features decide."""
    return feat.load_features(spark, f"{sf}/lineitem.parquet", Y3_FEATURES, line_key(), y3_label())


def wide(column: str = "features", prefix: str = "f", n: int = N_FEATURES, kind: str = "double"):
    return [F.get(column, F.lit(i)).cast(kind).alias(f"{prefix}{i}") for i in range(n)]


def embedding_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth vector entry summed up as the margin of one of ten classes."""
    e = table(spark, sf, "embeddings")
    entry = lambda i: F.get("embedding", F.lit(i)).cast("double")
    margin = F.array(*[reduce(Column.__add__, [entry(i) for i in range(k, 64, 10)]) for k in range(10)])
    return e.select("vec_id", "label", softmax(margin).alias("proba"))


def cover_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as 10 numeric and 44 binary features with 7 classes that some of them decide."""
    # The file has few row groups; spread, so that the features are not made by few tasks.
    li = table(spark, sf, "lineitem").repartition("l_orderkey")
    key = row_hash(line_key())
    numeric = [F.col(c) for c in (*Y3_FEATURES, "l_linenumber", "l_orderkey", "l_partkey", "l_suppkey")]
    numeric += [key % 1000, key % 97]
    binary = [(F.floor(key / (i + 3)) % (2 + i % 5) == 0).cast("int") for i in range(44)]
    label = (
        (F.col("l_quantity") > 25).cast("int") * 2 + (F.col("l_discount") > 0.05).cast("int") * 3 + (key % 97 > 48).cast("int")
    )
    return feat.as_features(li, [*numeric, *binary], line_key(), label)


# (round, class, node, is_leaf, feature, threshold, missing_left, leaf value) of two rounds.
_FIXED = [
    (0, 0, 0, False, 0, 25.5, True, None), (0, 0, 1, True, None, None, None, 0.9), (0, 0, 2, True, None, None, None, -0.7),
    (0, 1, 0, False, 2, 0.055, True, None), (0, 1, 1, True, None, None, None, 0.25), (0, 1, 2, True, None, None, None, 0.5),
    (0, 2, 0, False, 0, 25.5, False, None), (0, 2, 1, True, None, None, None, -0.8), (0, 2, 2, True, None, None, None, 0.6),
    (1, 0, 0, False, 2, 0.055, True, None), (1, 0, 1, True, None, None, None, 0.4), (1, 0, 2, False, 1, 30000.0, True, None),
    (1, 0, 5, True, None, None, None, -0.2), (1, 0, 6, True, None, None, None, -0.45),
    (1, 1, 0, True, None, None, None, 0.125),
    (1, 2, 0, False, 2, 0.055, True, None), (1, 2, 1, True, None, None, None, -0.5), (1, 2, 2, True, None, None, None, 0.35),
]


def fixed_nodes(spark: SparkSession, rounds: int = 2) -> DataFrame:
    """Six small trees with known thresholds, as a model table."""
    rows = []
    for r, k, node, leaf, feature, threshold, missing_left, value in _FIXED:
        if r < rounds:
            left, right = (None, None) if leaf else (2 * node + 1, 2 * node + 2)
            rows.append(("fixed", r, k, node, leaf, feature, None, threshold, missing_left, left, right,
                         value, None, None))
    return spark.createDataFrame(rows, SCHEMAS["model_nodes"])


def fixed_scores(spark: SparkSession, sf: str) -> DataFrame:
    return score(lineitem_y3(spark, sf), fixed_nodes(spark), N_CLASS, N_FEATURES)


def store(spark: SparkSession) -> Store:
    return Store(spark, new_path(spark, "store"))


# Derived tracking tables ------------------------------------------------------


def versions(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.concat(F.lit("shop.m"), "o_custkey").alias("name"), F.col("o_orderkey").cast("string").alias("version")
    )


def aliases(spark, sf):
    o = table(spark, sf, "orders")
    champion = F.when(F.substring("o_orderpriority", 1, 1) == "1", "champion").otherwise("candidate")
    return o.select(
        F.concat(F.lit("shop.m"), "o_custkey").alias("name"), champion.alias("alias"),
        F.col("o_orderkey").cast("int").alias("version"), F.col("o_orderkey").alias("seq"),
    )


def trial_results(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderpriority").alias("search_id"),
        F.col("o_orderkey").cast("int").alias("trial"),
        (F.col("o_custkey") % 16).cast("int").alias("shard"),
        F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("OK").alias("status"),
        (F.floor(F.col("o_totalprice") / 1000) / 1000).alias("auc"),
        ((F.col("o_orderkey") % 97) / 97.0).alias("accuracy"),
        (F.col("o_custkey") % 60).cast("double").alias("train_seconds"),
    )


def shard_results(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderpriority").alias("search_id"),
        F.col("o_orderkey").cast("int").alias("version"),
        (F.floor(F.col("o_totalprice") / 1000) / 1000).alias("auc"),
        F.col("o_custkey").cast("int").alias("trial_start"),
    )


def runs(spark, sf):
    """Customers as parent runs, their orders as child runs."""
    parents = table(spark, sf, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("run_id"), F.lit(None).cast("string").alias("parent_run_id"),
        F.col("c_name").alias("run_name"), F.lit("FINISHED").alias("status"),
    )
    children = table(spark, sf, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("run_id"), F.concat(F.lit("c"), "o_custkey").alias("parent_run_id"),
        F.concat(F.lit("trial-"), "o_orderkey").alias("run_name"), F.col("o_orderstatus").alias("status"),
    )
    return parents.unionByName(children)


def line_metrics(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        F.concat(F.lit("o"), "l_orderkey").alias("run_id"), F.col("l_returnflag").alias("key"),
        F.col("l_linenumber").alias("step"), F.col("l_extendedprice").alias("value"),
    )


def requests(spark, sf):
    """Scoring requests made of events: two rows each, some malformed."""
    e = table(spark, sf, "events")
    first = F.concat(F.lit("[["), (F.col("event_id") % 50).cast("string"), F.lit(".5, "), F.col("user_id").cast("string"),
                     F.lit(".0e3, 0.0625, 0.02], "))
    second = F.concat(F.lit("["), (F.col("user_id") % 50).cast("string"), F.lit(", 100.25, 0.03125, 0.5]]}"))
    good = F.concat(F.lit('{"inputs": '), first, second)
    payload = (
        F.when(F.col("event_id") % 10 == 3, F.substring(good, 1, 20))
        .when(F.col("event_id") % 10 == 7, F.lit('{"rows": [[1.0, 2.0, 3.0, 4.0]]}'))
        .otherwise(good)
    )
    return e.select(F.col("event_id").alias("request_id"), payload.alias("payload"))


# Sources, projections, splits -----------------------------------------------------


def q_load_features(spark, sf):
    return lineitem_y3(spark, sf).select("row_id", *wide(), "label")


def q_load_features_csv(spark, sf):
    path = new_path(spark, "csv")
    li = table(spark, sf, "lineitem").select(line_key().alias("key"), *Y3_FEATURES, y3_label().alias("y"))
    li.write.option("header", True).csv(path)
    df = feat.load_features(spark, path, Y3_FEATURES, "key", "y", "csv", li.schema)
    return df.select("row_id", *wide(), "label")


def q_stage_dataset(spark, sf):
    staged = feat.stage_dataset(lineitem_y3(spark, sf), new_path(spark, "staged"))
    return staged.select("row_id", *wide(), "label")


def q_predictions_csv(spark, sf):
    path = new_path(spark, "predictions")
    out = files.predictions(fixed_scores(spark, sf))
    files.write_predictions(out, path)
    back = files.read_predictions(spark, path, out.schema)
    return back.withColumn("predicted_probability", F.round("predicted_probability", 6))


def q_shard_results_json(spark, sf):
    path = new_path(spark, "shards")
    files.write_shard_results(shard_results(spark, sf), path)
    return files.read_shard_results(spark, path).select("search_id", "version", "auc", "trial_start")


def q_run_metrics_latest(spark, sf):
    e = table(spark, sf, "events")
    log = e.select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("key"),
        F.col("event_id").cast("int").alias("step"), "value",
    )
    s = store(spark)
    s.append("run_metrics", log)
    return registry.latest_metrics(s.read("run_metrics"))


def q_label_shift(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("label")
    )
    return labels.shift_label(o)


def q_label_index(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label"))
    return labels.index_labels(o).select("o_orderkey", "class_id")


def q_num_class(spark, sf):
    return labels.num_class(lineitem_y3(spark, sf))


def q_class_distribution(spark, sf):
    return labels.class_distribution(lineitem_y3(spark, sf))


def q_subsample(spark, sf):
    o = table(spark, sf, "orders")
    return split.subsample(o, "o_orderkey", 5000).select("o_orderkey")


def q_stratified_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(o, "o_orderkey", "o_orderstatus").select("o_orderkey", "split")


def q_three_way_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.three_way_split(o, "o_orderkey", "o_orderstatus").select("o_orderkey", "split")


def q_held_out(spark, sf):
    return split.held_out(lineitem_y3(spark, sf), "row_id").select("row_id", "label")


def q_split_counts(spark, sf):
    return split.split_counts(split.stratified_split(lineitem_y3(spark, sf), "row_id"), "label")


def q_split_overlap(spark, sf):
    df = lineitem_y3(spark, sf).select("row_id", "label")
    both = split.stratified_split(df, "row_id")
    train, test = both.where("split = 'train'"), both.where("split = 'test'")
    other = split.held_out(df, "row_id", seed=7)
    inside = split.split_overlap(train, test, "row_id").select(F.lit("train_test").alias("pair"), "overlap")
    across = split.split_overlap(test, other, "row_id").select(F.lit("two_seeds").alias("pair"), "overlap")
    return inside.unionByName(across)


def q_duplicate_keys(spark, sf):
    return feat.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


def q_preview(spark, sf):
    return feat.preview(lineitem_y3(spark, sf), N_FEATURES).select(
        "row_id", "label", *[F.col(f"f{i}").cast("double").alias(f"f{i}") for i in range(N_FEATURES)]
    )


def q_tail_rows(spark, sf):
    last = feat.head_rows(lineitem_y3(spark, sf), 3, last=True)
    rows = score(last, fixed_nodes(spark), N_CLASS, N_FEATURES)
    return rows.select("row_id", argmax("proba").alias("predicted_class"))


def q_reject_bad_width(spark, sf):
    li = table(spark, sf, "lineitem")
    width = F.lit(N_FEATURES) - (F.col("l_linenumber") % 3)
    rows = li.select(line_key().alias("row_id"), F.slice(feat.feature_array(Y3_FEATURES), F.lit(1), width).alias("features"))
    return feat.split_by_width(rows, N_FEATURES)[1].select("row_id", "reason")


def q_split_null_labels(spark, sf):
    """Every fifth order has no class: it takes no seat and no side."""
    status = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus"))
    o = table(spark, sf, "orders").select("o_orderkey", status.alias("o_orderstatus"))
    return split.stratified_split(o, "o_orderkey", "o_orderstatus").select("o_orderkey", "split")


def q_split_crowded(spark, sf):
    """The same split as ``stratified_split`` where next to nothing may be ordered in one task."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    cuts = split.split_cuts(o, "o_orderkey", "o_orderstatus", order_rows=1)
    return split.stratified_split(o, "o_orderkey", "o_orderstatus", cuts=cuts).select("o_orderkey", "split")


# Training steps -------------------------------------------------------------------


def y3_train(spark, sf):
    return split.stratified_split(lineitem_y3(spark, sf), "row_id").where("split = 'train'")


def q_quantile_edges(spark, sf):
    return quantile_edges(y3_train(spark, sf), HIST_BINS)


def q_quantile_edges_wide(spark, sf):
    """Prices over 200 powers of two, some of them infinite; infinite edges by their sign."""
    power = F.pow(F.lit(2.0), (F.col("l_partkey") % 200 - 100).cast("double"))
    inf = F.lit(float("inf"))
    value = F.when(F.col("l_suppkey") % 10 == 0, inf).when(F.col("l_suppkey") % 10 == 1, -inf).otherwise(F.col("l_extendedprice") * power)
    signed = F.when(F.col("l_linenumber") % 2 == 0, value).otherwise(-value)
    li = table(spark, sf, "lineitem").select(F.array(value, signed).alias("features"))
    edges = quantile_edges(li, HIST_BINS)
    finite = F.abs("upper") < inf
    return edges.select("feature", "bin", F.when(finite, F.col("upper")).alias("upper"),
                        F.when(~finite, F.signum("upper")).otherwise(0.0).cast("int").alias("infinite"))


def y3_binned(spark, sf):
    both = split.stratified_split(lineitem_y3(spark, sf), "row_id").persist()
    edges = quantile_edges(both.where("split = 'train'"), HIST_BINS)
    out = bin_features(both, edges_by_feature(edges, N_FEATURES))
    return out


def q_bin_features(spark, sf):
    return y3_binned(spark, sf).select("row_id", "split", *wide("bins", "b", kind="int"))


def q_row_subsample(spark, sf):
    return sampling.sample_rows(lineitem_y3(spark, sf), "row_id", 0.8, 42, 3).select("row_id")


def q_column_subsample(spark, sf):
    trees = lineitem_y3(spark, sf).select(
        F.element_at(F.split("row_id", ":"), 2).cast("int").alias("round"), F.col("label").alias("class_id")
    ).distinct()
    return sampling.sample_tree_features(trees, 54, 0.8, 42)


def q_softmax(spark, sf):
    return embedding_scores(spark, sf).select("vec_id", F.posexplode("proba").alias("class_id", "p")).withColumn(
        "p", F.round("p", 6)
    )


def first_round(df: DataFrame) -> DataFrame:
    """Rows of round 0: all margins are 0."""
    proba = softmax(F.array_repeat(F.lit(0.0), N_CLASS))
    return df.withColumn("proba", proba).withColumns(
        {"g": gradient("proba", "label"), "h": hessian("proba")}
    )


def q_grad_hess(spark, sf):
    rows = first_round(lineitem_y3(spark, sf))
    return rows.select(
        "row_id", F.posexplode(F.arrays_zip("g", "h")).alias("class_id", "d")
    ).select("row_id", "class_id", F.round("d.g", 6).alias("g"), F.round("d.h", 6).alias("h"))


def y3_cells(spark, sf):
    rows = first_round(y3_binned(spark, sf).where("split = 'train'"))
    rows = rows.select(
        "bins", F.array_repeat(F.lit(0), N_CLASS).alias("node"),
        fixed_point("g", SCALE).alias("g"), fixed_point("h", SCALE).alias("h"),
    )
    return histogram.grad_histogram(rows)


def q_grad_histogram(spark, sf):
    return y3_cells(spark, sf)


def q_node_histograms(spark, sf):
    """The numpy form of the same pass, as training runs it."""
    rows = y3_binned(spark, sf).where("split = 'train'").select(
        "bins", "label", row_hash("row_id").alias("row_hash"), F.lit(True).alias("is_train")
    )
    packed = blocks.to_blocks(rows, N_FEATURES, HIST_BINS + 1)
    todo = histogram.Pass(
        N_FEATURES, HIST_BINS + 1, N_CLASS, SCALE, histogram.Grown(N_CLASS), [(1, 0, 2**31)],
        [list(range(N_FEATURES))] * N_CLASS, {k: np.zeros(1, np.int64) for k in range(N_CLASS)},
    )
    return histogram.node_histograms(packed, todo)


def q_split_gain(spark, sf):
    return splits.split_gain(y3_cells(spark, sf), SCALE).select(
        "tree", "node", "feature", "bin", F.round("gain", 4).alias("gain")
    )


def q_best_split(spark, sf):
    best = splits.best_split(splits.split_gain(y3_cells(spark, sf), SCALE))
    return best.select("tree", "node", "feature", "bin", F.round("gain", 4).alias("gain"),
                       F.round("h_left", 4).alias("h_left"), F.round("h_right", 4).alias("h_right"))


def q_leaf_values(spark, sf):
    leaves = splits.leaf_values(y3_cells(spark, sf), SCALE)
    return leaves.select("tree", "node", F.round("leaf_value", 9).alias("leaf_value"), F.round("cover", 4).alias("cover"))


def q_boost_round(spark, sf):
    """One round of the trainer itself: a tree of depth 2 per class, all rows and features."""
    df = split.stratified_split(lineitem_y3(spark, sf), "row_id")
    prepared = prepare(df, HIST_BINS)
    params = TrainParams(1, 2, 0.1, 1.0, 1.0, max_bins=HIST_BINS)
    (model,), rows = boost(prepared, [params], ["one"])
    rows.unpersist()
    prepared.release()
    return model.nodes.select(
        "class_id", "node_id", "is_leaf", "feature", "split_bin", F.round("threshold", 6).alias("threshold"),
        F.round("leaf_value", 6).alias("leaf_value"), F.round("gain", 3).alias("gain"), F.round("cover", 4).alias("cover"),
    )


# Scoring and evaluation -------------------------------------------------------------


def _proba(df):
    return df.select("row_id", *[F.round(F.get("proba", F.lit(k)), 6).alias(f"p{k}") for k in range(N_CLASS)])


def q_score_fixed_model(spark, sf):
    return _proba(fixed_scores(spark, sf))


def q_score_native(spark, sf):
    return _proba(score_native(lineitem_y3(spark, sf), fixed_nodes(spark), N_CLASS))


def stump_nodes(spark, sf):
    """One tree of depth 1 for each part, its price as threshold of the line price: thousands of nodes."""
    p = table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("round"), (F.col("p_partkey") % N_CLASS).cast("int").alias("class_id"),
        (F.col("p_retailprice") * 20).alias("t"),
    )
    node = lambda i, leaf, value: F.struct(
        F.lit(i).alias("node_id"), F.lit(leaf).alias("is_leaf"), F.lit(value).cast("double").alias("leaf_value")
    )
    nodes = p.select("round", "class_id", "t", F.inline(F.array(
        node(0, False, None), node(1, True, -0.0078125), node(2, True, 0.0078125))))
    inner = ~F.col("is_leaf")
    return nodes.select(
        F.lit("stumps").alias("model_id"), "round", "class_id", "node_id", "is_leaf", F.when(inner, 1).alias("feature"),
        F.lit(None).cast("int").alias("split_bin"), F.when(inner, F.col("t")).alias("threshold"),
        F.when(inner, True).alias("missing_left"), F.when(inner, 1).alias("left_id"), F.when(inner, 2).alias("right_id"),
        "leaf_value", F.lit(None).cast("double").alias("gain"), F.lit(None).cast("double").alias("cover"),
    )


def q_score_large_model(spark, sf):
    """An ensemble that is far beyond what one expression may hold."""
    return _proba(score(lineitem_y3(spark, sf), stump_nodes(spark, sf), N_CLASS, N_FEATURES, max_nodes=500))


def q_eval_curve(spark, sf):
    """Log loss per split after 0, 1 and 2 rounds of the fixed model."""
    df = split.stratified_split(lineitem_y3(spark, sf), "row_id").persist()
    steps = []
    for rounds in range(3):
        if rounds:
            scored = score_native(df, fixed_nodes(spark, rounds), N_CLASS)
        else:
            scored = df.withColumn("proba", softmax(F.array_repeat(F.lit(0.0), N_CLASS)))
        steps.append(scored.select(F.lit(rounds).alias("step"), "split", "label", "proba"))
    every = steps[0].unionByName(steps[1]).unionByName(steps[2])
    losses = metrics.log_loss(every, "step", "split")
    return losses.groupBy("step").agg(
        F.round(F.max(F.when(F.col("split") == "train", F.col("log_loss"))), 6).alias("train_mlogloss"),
        F.round(F.max(F.when(F.col("split") == "test", F.col("log_loss"))), 6).alias("test_mlogloss"),
    )


def q_argmax_class(spark, sf):
    return embedding_scores(spark, sf).select(
        "vec_id", argmax("proba").alias("predicted_class"), F.round(confidence("proba"), 6).alias("predicted_probability")
    )


def q_accuracy(spark, sf):
    return metrics.accuracy(fixed_scores(spark, sf)).select(F.round("accuracy", 9).alias("accuracy"), "n")


def q_log_loss(spark, sf):
    return metrics.log_loss(embedding_scores(spark, sf)).select(F.round("log_loss", 6).alias("log_loss"))


def q_confusion(spark, sf):
    return metrics.confusion(fixed_scores(spark, sf))


def _auc(df):
    return df.select("class_id", "positives", "negatives", F.round("auc", 9).alias("auc"))


def q_auc_per_class(spark, sf):
    return _auc(metrics.auc_per_class(embedding_scores(spark, sf), 10))


def q_auc_ties(spark, sf):
    """A model of few leaves: hardly any distinct scores, ranked in buckets."""
    return _auc(metrics.auc_per_class(fixed_scores(spark, sf), N_CLASS))


def q_auc_crowded(spark, sf):
    """Nearly all scores within a millionth of each other, which is one cell of the scale of log odds."""
    li = table(spark, sf, "lineitem")
    close = 0.3 + (F.col("l_extendedprice") * 7 + F.col("l_partkey")) * 1e-13
    score = F.when(F.col("l_linenumber") + F.col("l_suppkey") % 50 == 1, F.col("l_discount")).otherwise(close)
    scored = li.select((F.col("l_quantity") + F.col("l_extendedprice") / 4000 > 30).cast("int").alias("label"), F.array(1 - score, score).alias("proba"))
    return _auc(metrics.auc_per_class(scored, 2, crowded=500))


def q_auc_ovr_macro(spark, sf):
    per_class = metrics.auc_per_class(embedding_scores(spark, sf), 10)
    return metrics.macro_auc(per_class).select(F.round("auc_ovr_macro", 9).alias("auc_ovr_macro"))


def q_curve_gap(spark, sf):
    li = table(spark, sf, "lineitem")
    log = li.select(
        F.col("l_suppkey").cast("string").alias("run_id"), F.col("l_linenumber").alias("step"),
        F.when(F.col("l_linestatus") == "O", "train_mlogloss").otherwise("test_mlogloss").alias("key"),
        F.col("l_extendedprice").alias("value"),
    )
    return metrics.curve_gap(log).withColumn("gap", F.round("gap", 2))


# Search and registry ------------------------------------------------------------------


def customer_trials(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("trial"))


def q_trial_grid(spark, sf):
    return grid.sample_trials(customer_trials(spark, sf))


def q_trial_shard(spark, sf):
    return grid.trial_shard(grid.sample_trials(customer_trials(spark, sf)), 40, 75)


def q_shard_plan(spark, sf):
    return grid.shard_plan(customer_trials(spark, sf), 7)


def q_trial_success(spark, sf):
    return grid.trial_success(trial_results(spark, sf))


def q_best_of_shard(spark, sf):
    return grid.best_of_shard(trial_results(spark, sf), "search_id", "shard").withColumn(
        "accuracy", F.round("accuracy", 6)
    )


def q_search_summary(spark, sf):
    return grid.search_summary(trial_results(spark, sf)).withColumn("best_accuracy", F.round("best_accuracy", 6))


def q_global_best(spark, sf):
    return grid.global_best(shard_results(spark, sf), "search_id")


def q_register_version(spark, sf):
    asked = table(spark, sf, "customer").select(F.concat(F.lit("shop.m"), "c_custkey").alias("name"))
    return registry.next_version(asked, versions(spark, sf))


def q_alias_current(spark, sf):
    return registry.alias_current(aliases(spark, sf))


def q_latest_version(spark, sf):
    return registry.latest_version(versions(spark, sf))


def q_serving_version(spark, sf):
    asked = table(spark, sf, "customer").select(
        F.concat(F.lit("shop.m"), "c_custkey").alias("name"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string")).otherwise("").alias("requested"),
    )
    return registry.serving_version(asked, versions(spark, sf))


def q_resolve_uri(spark, sf):
    kind = F.col("o_orderkey") % 4
    name = F.concat(F.lit("models:/shop.m"), "o_custkey")
    uri = (
        F.when(kind == 0, F.concat(name, F.lit("/"), "o_orderkey"))
        .when(kind == 1, F.concat(name, F.lit("@candidate")))
        .when(kind == 2, F.concat(name, F.lit("/999999999")))
        .otherwise("")
    )
    asked = table(spark, sf, "orders").select(
        "o_orderkey", uri.alias("uri"), F.concat(F.lit("shop.m"), F.col("o_custkey") + 1).alias("default_name")
    )
    return registry.resolve_uri(asked, versions(spark, sf), aliases(spark, sf), F.col("default_name")).select(
        "o_orderkey", "name", "version", "found_by"
    )


def q_child_runs(spark, sf):
    return registry.child_runs(runs(spark, sf))


def q_compare_trials(spark, sf):
    return registry.compare_trials(runs(spark, sf), line_metrics(spark, sf), *TRACKED)


# Jobs and streams -----------------------------------------------------------------------


def fixed_model(spark):
    return SimpleNamespace(
        model_id="fixed", nodes=fixed_nodes(spark), edges=None, n_class=N_CLASS, n_features=N_FEATURES
    )


def q_batch_inference(spark, sf):
    """Champion of a store, the rows it was not trained on, predictions read back."""
    s = store(spark)
    s.set_alias("shop.fixed", s.register("shop.fixed", fixed_model(spark), test_size=0.25, split_seed=11))
    path = new_path(spark, "scored")
    done = run_batch_inference(s, lineitem_y3(spark, sf), "shop.fixed", path)
    back = files.read_predictions(
        spark, path, "row_id STRING, predicted_class INT, predicted_probability DOUBLE, true_label INT"
    )
    return back.select("row_id", "predicted_class", F.round("predicted_probability", 6).alias("predicted_probability"),
                       "true_label", F.lit(done["version"]).alias("model_version"))


def q_batch_inference_unlabelled(spark, sf):
    """Half of the rows have no label: all of them are scored, and the held-out ones of the others."""
    s = store(spark)
    s.set_alias("shop.fixed", s.register("shop.fixed", fixed_model(spark), test_size=0.25, split_seed=11))
    path = new_path(spark, "scored")
    rows = lineitem_y3(spark, sf)
    odd = F.element_at(F.split("row_id", ":"), 2).cast("int") % 2 == 1
    run_batch_inference(s, rows.withColumn("label", F.when(odd, F.col("label"))), "shop.fixed", path)
    back = files.read_predictions(
        spark, path, "row_id STRING, predicted_class INT, predicted_probability DOUBLE, true_label INT"
    )
    return back.select("row_id", "predicted_class", "true_label")


def q_grown_table(spark, sf):
    """Rows that are scored after the table has grown: the cuts stored at registration hold out
    the old test rows and new rows below the cut, and none that was trained on."""
    s = store(spark)
    rows = lineitem_y3(spark, sf)
    old = rows.where(F.element_at(F.split("row_id", ":"), 1).cast("bigint") % 10 != 0)
    cuts = split.split_cuts(old, "row_id")
    s.set_alias("shop.fixed", s.register("shop.fixed", fixed_model(spark), split_cuts=cuts))
    path = new_path(spark, "scored")
    run_batch_inference(s, rows, "shop.fixed", path)
    back = files.read_predictions(
        spark, path, "row_id STRING, predicted_class INT, predicted_probability DOUBLE, true_label INT"
    )
    trained = split.stratified_split(old, "row_id", cuts=cuts).where("split = 'train'")
    leaked = back.join(trained, "row_id", "left_semi").agg(F.count("*").alias("trained_rows_scored"))
    return back.agg(F.count("*").alias("n"), F.count("true_label").alias("labelled")).crossJoin(leaked)


def q_reregister_scores(spark, sf):
    """One model registered under two names and once more: scores of the last version."""
    s = store(spark)
    for name in ("shop.a", "shop.b", "shop.b"):
        s.register(name, fixed_model(spark))
    version = s.resolve("shop.b")
    return _proba(score(lineitem_y3(spark, sf), s.load_nodes(version.model_id), version.num_class, version.num_features))


def q_stream_rejects(spark, sf):
    """Arriving rows of several widths: what does not fit is set aside, the rest is scored."""
    schema = table(spark, sf, "lineitem").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    width = F.lit(N_FEATURES) - (F.col("l_linenumber") % 3)
    rows = rows.select(line_key().alias("row_id"), F.slice(feat.feature_array(Y3_FEATURES), F.lit(1), width).alias("features"))
    path = new_path(spark, "stream")
    q = serve.score_stream(rows, fixed_nodes(spark), N_CLASS, N_FEATURES, path, new_path(spark, "checkpoint"))
    q.awaitTermination()
    scored = spark.read.parquet(path).select("row_id", F.lit("scored").alias("reason"))
    return scored.unionByName(spark.read.parquet(f"{path}-rejected").select("row_id", "reason"))


def q_request_edge_cases(spark, sf):
    """Empty, misshapen and broken requests: each is answered, refused as a whole, or has refused inputs."""
    e = table(spark, sf, "events").select("event_id", (F.col("event_id") % 5).alias("k"))
    payload = (
        F.when(F.col("k") == 0, '{"inputs": []}').when(F.col("k") == 1, '{"inputs": [[1, 2, 3]]}')
        .when(F.col("k") == 2, '{"inputs": [null, [1, 2, 3, 4]]}').when(F.col("k") == 3, "[1")
        .otherwise('{"inputs": [[30, 2, 0.03, 4]]}')
    )
    asked = e.select(F.col("event_id").alias("request_id"), payload.alias("payload"))
    fitting, others = feat.split_by_width(serve.parse_requests(asked), N_FEATURES)
    answered = score(fitting, fixed_nodes(spark), N_CLASS, N_FEATURES)
    out = answered.select("request_id", "pos", F.lit("answered").alias("outcome"))
    out = out.unionByName(others.select("request_id", "pos", F.col("reason").alias("outcome")))
    refused = serve.rejected_requests(asked)
    return out.unionByName(refused.select("request_id", F.lit(None).cast("int").alias("pos"), F.col("reason").alias("outcome")))


def line_stream(spark, sf):
    schema = table(spark, sf, "lineitem").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    return feat.as_features(rows, Y3_FEATURES, line_key(), y3_label())


def q_score_stream(spark, sf):
    path = new_path(spark, "stream")
    q = serve.score_stream(
        line_stream(spark, sf), fixed_nodes(spark), N_CLASS, N_FEATURES, path, new_path(spark, "checkpoint")
    )
    q.awaitTermination()
    return _proba(spark.read.parquet(path))


def q_score_current(spark, sf):
    """Two versions behind one stream, 70 % on the champion."""
    s = store(spark)
    s.register("shop.fixed", fixed_model(spark))
    s.set_alias("shop.fixed", s.register("shop.fixed", SimpleNamespace(
        model_id="fixed-short", nodes=fixed_nodes(spark, 1).withColumn("model_id", F.lit("fixed-short")),
        edges=None, n_class=N_CLASS, n_features=N_FEATURES,
    )))
    path = new_path(spark, "stream")
    q = serve.score_current(
        line_stream(spark, sf), s, lambda: {"models:/shop.fixed@champion": 70, "models:/shop.fixed/1": 30},
        "shop.fixed", "row_id", path, new_path(spark, "checkpoint"),
    )
    q.awaitTermination()
    scored = spark.read.parquet(path)
    return scored.select("row_id", "model_version", *[F.round(F.get("proba", F.lit(k)), 6).alias(f"p{k}") for k in range(N_CLASS)])


def q_traffic_route(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id")
    return serve.route(e, "user_id", {"stable": 80, "canary": 15, "shadow": 5}).select("event_id", "served_model")


def q_parse_request(spark, sf):
    return serve.parse_requests(requests(spark, sf)).select("request_id", "pos", *wide())


def q_rejected_requests(spark, sf):
    return serve.rejected_requests(requests(spark, sf)).select("request_id", "reason")


def q_request_response(spark, sf):
    """Requests answered by the fixed model; the answers are read back from their JSON."""
    scored = score(serve.parse_requests(requests(spark, sf)), fixed_nodes(spark), N_CLASS, N_FEATURES)
    answer = F.from_json("response", "predictions ARRAY<ARRAY<DOUBLE>>").getField("predictions")
    out = serve.responses(scored).select("request_id", F.posexplode(answer).alias("pos", "prediction"))
    return out.select("request_id", "pos", serve.predicted_class("prediction").alias("predicted_class"),
                      F.round(F.array_max("prediction"), 6).alias("predicted_probability"))


def q_daily_quality(spark, sf):
    e = table(spark, sf, "events").select(
        "ts", (F.col("event_type") == "click").cast("int").alias("label"),
        (F.col("value") > 10).cast("int").alias("predicted_class"),
    )
    daily = serve.windowed_quality(e)
    day = F.date_from_unix_date(F.floor(F.unix_seconds("window_start") / 86400).cast("int")).cast("string")
    return daily.select(day.alias("day"), "n", F.round("accuracy", 6).alias("accuracy"))


def small_params(**kw):
    return TrainParams(**{"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3, "max_bins": HIST_BINS, **kw})


def q_train_predict(spark, sf):
    """Split, train, score the held-out rows: the whole pipeline."""
    df = split.stratified_split(lineitem_y3(spark, sf), "row_id")
    model = train(df, small_params(), "y3")
    out = files.predictions(score_model(df.where("split = 'test'"), model))
    return out.withColumn("predicted_probability", F.round("predicted_probability", 6))


def q_train_curve(spark, sf):
    df = split.stratified_split(lineitem_y3(spark, sf), "row_id")
    curves = train(df, small_params(n_estimators=3), "y3").curves
    return curves.withColumns({c: F.round(c, 6) for c in ("train_mlogloss", "test_mlogloss")})


def q_search(spark, sf):
    """Four trials in two shards over all rows."""
    s = store(spark)
    space = {"max_depth": ("int", [2, 3]), "learning_rate": ("double", [0.1, 0.3]), "reg_lambda": ("double", [0.5, 1.0])}
    done = run_search(
        s, lineitem_y3(spark, sf), "shop.search", total=4, workers=2, base=small_params(n_estimators=2), space=space
    )
    return s.read("trial_results").where(F.col("search_id") == done["search_id"]).select(
        "trial", "shard", "status", "auc", "accuracy"
    )


def q_ovr_cross_check(spark, sf):
    df = split.stratified_split(lineitem_y3(spark, sf), "row_id")
    model = train_ovr(df, rounds=2, max_depth=2)
    return predict_ovr(df.where("split = 'test'"), model)


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
