"""Signal is learned, noise is not."""

from pyspark.sql import functions as F

from coppice.functions.proba import argmax
from coppice.operators.metrics import evaluate
from coppice.operators.split import stratified_split
from coppice.plans.inference import score_model
from coppice.plans.ovr import predict_ovr, train_ovr
from coppice.plans.queries import lineitem_y3
from coppice.plans.train import TrainParams, train

SF = "/root/testdata/sf0.01"


def fit(df, params):
    split = stratified_split(df, "row_id").persist()
    model = train(split, params)
    return model, split.where("split = 'test'"), split


def test_line_items_are_learned_and_match_the_library_trees(spark):
    model, test, split = fit(lineitem_y3(spark, SF), TrainParams(6, 3, 0.3, max_bins=32))
    got = evaluate(score_model(test, model), 3)
    assert got["accuracy"] >= 0.95 and got["auc_ovr_macro"] >= 0.98
    ovr = predict_ovr(test, train_ovr(split, rounds=2, max_depth=3))
    other = ovr.agg(F.avg((F.col("predicted_class") == F.col("label")).cast("double"))).first()[0]
    assert got["accuracy"] >= other - 0.02


def test_document_quality_has_signal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    other = F.length(F.regexp_replace("text", r"[A-Za-z0-9\s]", "")) / F.col("n_chars")
    digits = F.length(F.regexp_replace("text", r"[^0-9]", "")) / F.col("n_chars")
    df = labels.join(docs, "doc_id").select(
        F.col("doc_id").alias("row_id"), F.array(F.col("n_chars"), other, digits).cast("array<float>").alias("features"),
        F.col("quality").alias("label"),
    )
    model, test, _ = fit(df, TrainParams(6, 3, 0.3, max_bins=32))
    assert evaluate(score_model(test, model), 2)["auc_ovr_macro"] > 0.7


def test_unrelated_labels_are_not_learned(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    df = e.select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"), "label")
    model, test, _ = fit(df, TrainParams(2, 3, 0.3, max_bins=16))
    scored = score_model(test, model)
    assert scored.agg(F.avg((argmax("proba") == F.col("label")).cast("double"))).first()[0] < 0.2
