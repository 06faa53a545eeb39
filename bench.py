"""Timings of the pipeline on the shared tables; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Short steps run twice
and the second run counts; training and search run once, after a short warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("coppice-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def materialise(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from coppice.operators.binning import bin_features, edges_by_feature, quantile_edges
    from coppice.operators.blocks import without_margin
    from coppice.operators.histogram import fixed_scale, node_histograms
    from coppice.operators.metrics import evaluate
    from coppice.operators.split import stratified_split
    from coppice.plans import queries as q
    from coppice.plans.inference import score_model
    from coppice.plans.search import _train_batch
    from coppice.plans.train import TrainParams, _Round, boost, prepare
    from coppice.session import new_path
    from coppice.sources.features import stage_dataset

    spark = session()
    times: dict[str, float] = {}
    out: dict[str, float] = {}

    def clock(name: str, action, runs: int = 2):
        for _ in range(runs):
            started = time.perf_counter()
            result = action()
            times[name] = round(time.perf_counter() - started, 3)
        return result

    # The shared file is one row group, which one task has to read. Staging spreads it.
    source = q.lineitem_y3(spark, SF).repartition(int(CPUS))
    lines = clock("stage", lambda: stage_dataset(source, new_path(spark, "bench")))
    n = lines.count()
    clock("split", lambda: materialise(stratified_split(lines, "row_id")))
    split = stratified_split(lines, "row_id").persist()
    materialise(split)
    train_rows, test_rows = split.where("split = 'train'"), split.where("split = 'test'").persist()
    n_test = test_rows.count()
    params = TrainParams(n_estimators=20, max_depth=3, learning_rate=0.3)
    edges = clock("quantile_edges", lambda: quantile_edges(train_rows, params.max_bins))
    cuts = edges_by_feature(edges, q.N_FEATURES)
    clock("bin_features", lambda: materialise(bin_features(split, cuts)))
    prepared = clock("prepare", lambda: prepare(split, params.max_bins))

    first = _Round(prepared, [params], 0)
    blocks = without_margin(prepared.blocks).where("is_train")
    wanted = [(k, 0) for k in range(prepared.n_class)]
    todo = first._pass(wanted, 0, fixed_scale(prepared.n_train))
    clock("histogram_pass", lambda: node_histograms(blocks, todo).collect(), 3)

    boost(prepared, [TrainParams(n_estimators=2, max_depth=3)], ["warm"])[1].unpersist()

    def fit():
        (model,), state = boost(prepared, [params], ["bench"])
        state.unpersist()
        return model

    model = clock("train_20_rounds_depth_3", fit, 1)
    clock("score", lambda: materialise(score_model(test_rows, model)))
    metrics = clock("evaluate", lambda: evaluate(score_model(test_rows, model), model.n_class))
    trials = [
        (t, TrainParams(n_estimators=5, max_depth=3, learning_rate=rate, reg_lambda=lam))
        for t, (rate, lam) in enumerate([(0.1, 1.0), (0.3, 1.0), (0.1, 5.0), (0.3, 5.0)])
    ]
    clock("search_4_trials_5_rounds", lambda: _train_batch(prepared, trials, "bench"), 1)
    clock("search_1_trial_5_rounds", lambda: _train_batch(prepared, trials[:1], "bench"), 1)

    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"), "label"
    )
    wide = prepare(stratified_split(vectors, "row_id"), 32)
    clock("train_64_features_10_classes_3_rounds_depth_4", lambda: boost(
        wide, [TrainParams(n_estimators=3, max_depth=4)], ["wide"])[1].unpersist(), 1)
    # The reference's shape: 10 numeric and 44 binary features, 7 classes, depth 8.
    cover = clock("prepare_54_features_7_classes", lambda: prepare(stratified_split(q.cover_rows(spark, SF), "row_id"), 64), 1)
    clock("train_54_features_7_classes_2_rounds_depth_8", lambda: boost(
        cover, [TrainParams(n_estimators=2, max_depth=8)], ["cover"])[1].unpersist(), 1)
    for name in ("predictions_csv", "score_stream", "score_native", "subsample", "label_index", "auc_ties",
                 "confusion", "resolve_uri", "compare_trials", "request_response", "search_summary"):
        clock(name, lambda: materialise(q.QUERIES[name](spark, SF)))

    out["rows_per_second_split"] = round(n / times["split"])
    out["rows_per_second_score"] = round(n_test / times["score"])
    out["rows_per_second_histogram"] = round(prepared.n_train / times["histogram_pass"])
    out["accuracy"] = round(metrics["accuracy"], 5)
    out["auc_ovr_macro"] = round(metrics["auc_ovr_macro"], 5)
    print(json.dumps({
        "metric": "pipeline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": SF, "cpus": CPUS, "extra": out,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
