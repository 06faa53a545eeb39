"""Evaluate, register and score: the jobs around a trained model."""

from __future__ import annotations

import time
from dataclasses import asdict

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.proba import argmax
from ..operators.metrics import evaluate, throughput
from ..operators.scoring import score
from ..operators.split import held_out, split_cuts, stratified_split, subsample_cut, within
from ..sources.features import fitting_rows, require_unique_keys
from ..sources.files import predictions, write_predictions
from ..sources.store import Store
from .train import Model, TrainParams, train


def score_model(df: DataFrame, model: Model) -> DataFrame:
    return score(df, model.nodes, model.n_class, model.n_features)


def log_and_register(
    store: Store,
    model: Model,
    metrics: dict,
    name: str,
    example: DataFrame | None = None,
    run_name: str = "training",
    parent_run_id: str | None = None,
    test_size: float = 0.2,
    split_seed: int = 42,
    register: bool = True,
    promote: bool = True,
    **kept,
) -> tuple[str, int | None]:
    """Record a training run with all its parameters and curves; register its model and
    make it the champion unless told otherwise. ``kept`` goes to the version as it is."""
    params = {"num_features": model.n_features, "num_classes": model.n_class, **asdict(model.params)}
    run_id = store.log_run(run_name, params, metrics, model.curves, parent_run_id)
    if not register:
        return run_id, None
    version = store.register(name, model, run_id, example, test_size, split_seed, **kept)
    if promote:
        store.set_alias(name, version)
    return run_id, version


def train_and_register(
    store: Store,
    df: DataFrame,
    name: str,
    params: TrainParams = TrainParams(),
    test_size: float = 0.2,
    split_seed: int = 42,
    register: bool = True,
    max_samples: int = 0,
    unique_keys: bool = True,
) -> tuple[Model, dict, str, int | None]:
    """Reduce to ``max_samples`` rows if asked to, split, train, evaluate on the held-out rows,
    record and promote. Repeated row keys raise, as a split by key is not exact with them;
    ``unique_keys=False`` saves that shuffle of the keys where they are known to be unique."""
    if unique_keys:
        require_unique_keys(df, "row_id")
    sample_cut = subsample_cut(df, "row_id", max_samples, split_seed)
    df = within(df, "row_id", sample_cut, split_seed)
    cuts = split_cuts(df, "row_id", "label", test_size, split_seed)
    split = stratified_split(df, "row_id", "label", test_size, split_seed, cuts)
    model = train(split, params)
    test = split.where("split = 'test'")
    metrics = evaluate(score_model(test, model), model.n_class)
    metrics["train_seconds"] = model.train_seconds
    run_id, version = log_and_register(
        store, model, metrics, name, split.where("split = 'train'"), test_size=test_size,
        split_seed=split_seed, register=register, split_cuts=cuts, max_samples=max_samples, sample_cut=sample_cut,
    )
    return model, metrics, run_id, version


def batch_inference(
    store: Store,
    df: DataFrame,
    name: str,
    path: str,
    uri: str = "",
    fmt: str = "csv",
    only_held_out: bool = True,
    parent_run_id: str | None = None,
) -> dict:
    """Score rows with the model behind ``uri`` and write the predictions.

    Labelled rows are reduced to the held-out rows of that model: the subsample and the cuts
    stored with it are used, so that no row it was trained on is scored, also where rows were
    added since. Rows without a label were never trained on and are scored all. Rows with
    another number of features are refused and counted; features of another type raise.
    Accuracy, over the rows with a label, and the refused rows are observed by the writing job
    itself, which is the only one that reads the table.
    """
    version = store.resolve(name, uri)
    store.check_signature(version, df)
    labelled = "label" in df.columns
    if labelled and only_held_out:
        inside = within(df, "row_id", version.sample_cut, version.split_seed)
        if version.sample_cut is not None:
            inside = inside.where("label IS NOT NULL").unionByName(df.where("label IS NULL"))
        df = held_out(inside, "row_id", "label", version.test_size, version.split_seed, store.cuts_of(version))
    fitting, refused = fitting_rows(df, version.num_features)
    scored = score(fitting, store.load_nodes(version.model_id), version.num_class, version.num_features)
    seen = Observation()
    if labelled:
        hit = (argmax("proba") == F.col("label")).cast("double")
        scored = scored.observe(seen, F.avg(hit).alias("accuracy"))
    started = time.time()
    n_rows = write_predictions(predictions(scored), path, fmt)
    seconds = time.time() - started
    metrics = {
        "n_rows": n_rows,
        "inference_seconds": seconds,
        "rows_per_second": throughput(n_rows, seconds),
        "rejected": refused.get["refused"],
    }
    if labelled:
        metrics["accuracy"] = seen.get["accuracy"]
    batch = store.spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    params = {"model_uri": f"models:/{version.name}/{version.version}", "batch_size": batch, "path": path}
    run_id = store.log_run("batch-inference", params, metrics, parent_run_id=parent_run_id)
    return {"run_id": run_id, "version": version.version, "path": path, **metrics}
