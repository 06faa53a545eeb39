"""Random hyper-parameter search.

The data is read, split and binned once. A batch of trials shares every pass over the
rows. Each shard registers its best model; the best of all shards becomes champion.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, replace
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.proba import argmax, softmax
from ..operators.blocks import from_blocks
from ..operators.grid import SPACE, assign_shards, best_of_shard, global_best, sample_trials
from ..operators.metrics import auc_per_class, macro_auc
from ..operators.split import split_cuts, stratified_split, subsample_cut, three_way_split, within
from ..session import persisted
from ..sources.features import require_unique_keys
from ..sources.files import read_shard_results, write_shard_results
from ..sources.store import Store
from .train import Prepared, TrainParams, boost, prepare

# Scored rows of one batch of the cache.
SCORED_ROWS = 1000


def search_trials(spark, total: int, workers: int = 1, seed: int = 42, space: dict = SPACE) -> DataFrame:
    """The grid of a search: ``trial, shard`` and one column per parameter."""
    ids = spark.range(total).select(F.col("id").cast("int").alias("trial"))
    return assign_shards(sample_trials(ids, seed, space), total, workers)


def trial_metrics(blocks: DataFrame, n_class: int, n_trials: int) -> list[tuple[float, float]]:
    """``(auc, accuracy)`` of each trial of a batch on the held-out rows."""
    test = from_blocks(blocks.where("NOT is_train"), n_class * n_trials)
    each = [softmax(F.slice("margin", t * n_class + 1, n_class)) for t in range(n_trials)]
    scored = persisted(test.select("label", F.concat(*each).alias("proba")), SCORED_ROWS)
    hits = [
        F.avg((argmax(F.slice("proba", t * n_class + 1, n_class)) == F.col("label")).cast("double")).alias(f"t{t}")
        for t in range(n_trials)
    ]
    accuracy = scored.agg(*hits).first()
    auc = {
        r.group: r.auc_ovr_macro
        for r in macro_auc(auc_per_class(scored, n_class, n_groups=n_trials), "group").collect()
    }
    scored.unpersist()
    return [(auc[t], accuracy[f"t{t}"]) for t in range(n_trials)]


def _train_batch(prepared: Prepared, batch: list[tuple[int, TrainParams]], search_id: str) -> list[dict]:
    ids = [f"{search_id}-{trial}" for trial, _ in batch]
    models, blocks = boost(prepared, [p for _, p in batch], ids)
    try:
        scores = trial_metrics(blocks, prepared.n_class, len(batch))
    finally:
        blocks.unpersist()
    # Trials share their passes, so each gets its share of the time that training took.
    return [
        {"trial": trial, "status": "OK", "auc": auc, "accuracy": acc,
         "train_seconds": model.train_seconds / len(batch),
         "model": model, "error": None}
        for (trial, _), model, (auc, acc) in zip(batch, models, scores)
    ]


def _failed(trial: int, exc: Exception) -> dict:
    return {"trial": trial, "status": "FAILED", "auc": None, "accuracy": None, "train_seconds": None,
            "model": None, "error": str(exc)}


def run_batch(prepared: Prepared, batch: list[tuple[int, TrainParams]], search_id: str) -> list[dict]:
    """Results of a batch. Bad parameters are refused before the pass; when the pass
    fails, its trials run one by one so that one of them cannot take the others along."""
    out, good = [], []
    for trial, params in batch:
        try:
            params.validate()
            good.append((trial, params))
        except ValueError as exc:
            out.append(_failed(trial, exc))
    if good:
        try:
            return out + _train_batch(prepared, good, search_id)
        except Exception as exc:
            if len(good) == 1:
                return [*out, _failed(good[0][0], exc)]
        for one in good:
            out += run_batch(prepared, [one], search_id)
    return out


def _finished(store: Store, search_id: str) -> set[int]:
    """Trials of a search that an earlier start has finished: a result, and a whole model."""
    done = store.read("trial_results").where((F.col("search_id") == search_id) & (F.col("status") == "OK"))
    return {r.trial for r in done.select("trial", "model_id").distinct().collect() if store.has_model(r.model_id)}


def run_search(
    store: Store,
    df: DataFrame,
    name: str,
    total: int = 8,
    workers: int = 2,
    batch_size: int = 4,
    base: TrainParams = TrainParams(n_estimators=300),
    space: dict = SPACE,
    test_size: float = 0.2,
    seed: int = 42,
    validation_size: float | None = None,
    allow_partial: bool = False,
    search_id: str | None = None,
    shards: list[int] | None = None,
    register: bool = True,
    promote: bool = True,
    max_samples: int = 0,
    unique_keys: bool = True,
) -> dict:
    """Search, register the best model of each shard, promote the best of all.

    With ``validation_size`` models are selected on a third split instead of the test
    rows. Unless ``allow_partial``, nothing is promoted when a shard has no result.
    ``shards`` runs some shards only, as a job of its own (with ``promote=False``, and
    :func:`promote_best` after the last one). A search that is started again under its
    ``search_id`` trains only trials that have no finished model. ``register=False`` leaves
    trial results and runs and registers nothing. ``max_samples`` and ``unique_keys`` are those
    of ``train_and_register``. Models are stored after every batch; the driver keeps their ids.
    """
    spark = store.spark
    search_id = search_id or f"search-{uuid.uuid4().hex[:8]}"
    grid = search_trials(spark, total, workers, seed, space).orderBy("trial").collect()
    planned = sorted({r.shard for r in grid})
    if shards is not None:
        grid = [r for r in grid if r.shard in shards]
    if unique_keys:
        require_unique_keys(df, "row_id")
    sample_cut = subsample_cut(df, "row_id", max_samples, seed)
    df = within(df, "row_id", sample_cut, seed)
    cuts = split_cuts(df, "row_id", "label", test_size, seed)
    if validation_size is None:
        split = stratified_split(df, "row_id", "label", test_size, seed, cuts)
    else:
        split = three_way_split(df, "row_id", "label", test_size, validation_size, seed)
        split = split.where("split != 'test'").withColumn(
            "split", F.when(F.col("split") == "validation", "test").otherwise(F.col("split"))
        )
    settings = {"search_id": search_id, "num_trials": len(grid), "workers": workers,
                "test_size": test_size, "seed": seed, "validation_size": validation_size,
                "n_estimators": base.n_estimators, "max_bins": base.max_bins, "max_samples": max_samples,
                "shards": ",".join(map(str, sorted({r.shard for r in grid})))}
    started = time.time()
    parent = store.log_run("search", settings, status="RUNNING")
    try:
        done = _search_shards(
            store, split, name, grid, batch_size, base, space, seed, search_id, parent,
            {"test_size": test_size, "split_seed": seed, "split_cuts": cuts, "max_samples": max_samples,
             "sample_cut": sample_cut} if register else None,
        )
        done = {"search_seconds": time.time() - started, **done}
        known = [(parent, k, 0, float(done[k])) for k in ("search_seconds", "best_auc", "best_accuracy", "succeeded")]
        store.append("run_metrics", known)
        promoted = promote_best(store, name, search_id, len(planned), allow_partial) if register and promote else None
    except Exception:
        store.end_run(parent, "search", "FAILED")
        raise
    store.end_run(parent, "search", "FINISHED")
    return {"search_id": search_id, "run_id": parent, "version": promoted, **done}


def _search_shards(
    store: Store, split: DataFrame, name: str, grid: list, batch_size: int, base: TrainParams, space: dict,
    seed: int, search_id: str, parent: str, version: dict | None,
) -> dict:
    """Train what is not finished, then register the best trial of every shard."""
    shard_of = {r.trial: r.shard for r in grid}
    finished = _finished(store, search_id)
    trials = [
        (r.trial, replace(base, seed=seed, **{k: r[k] for k in space})) for r in grid if r.trial not in finished
    ]
    prepared = prepare(split, base.max_bins, min(batch_size, len(trials))) if trials else None
    try:
        for start in range(0, len(trials), batch_size):
            batch = trials[start : start + batch_size]
            params = dict(batch)
            for r in run_batch(prepared, batch, search_id):
                trial, model = r["trial"], r["model"]
                if model:
                    store.save_model(model.model_id, model.nodes, model.edges)
                    metrics = {k: r[k] for k in ("auc", "accuracy", "train_seconds")}
                    # The run has the model's id: logged again after a crash, it is the same run.
                    store.log_run(f"trial-{trial:02d}", asdict(params[trial]), metrics, model.curves, parent, run_id=model.model_id)
                store.append("trial_results", [(
                    search_id, trial, shard_of[trial], r["status"], r["auc"], r["accuracy"], r["train_seconds"],
                    model.model_id if model else None, r["error"],
                )])
    finally:
        if prepared:
            prepared.release()
    results = store.read("trial_results").where(F.col("search_id") == search_id)
    results = results.where(F.col("shard").isin(sorted(set(shard_of.values()))))
    best = best_of_shard(results, "shard").orderBy("shard").collect()
    if not best:
        raise RuntimeError(f"all trials of {search_id} failed: see trial_results")
    if version is not None:
        example = split.where("split = 'train'").limit(5)
        if prepared:
            n_class, width = prepared.n_class, prepared.n_features
        else:
            n_class = split.agg(F.max("label")).first()[0] + 1
            width = example.select(F.size("features").alias("n")).first().n
        # A repeated start registers only shards whose best trial has no version yet.
        known = {r.trial_start for r in store.shard_results(search_id).collect()}
        found = []
        for b in best:
            if b.trial in known:
                continue
            model = SimpleNamespace(
                model_id=f"{search_id}-{b.trial}", nodes=None, edges=None, n_class=n_class, n_features=width
            )
            number = store.register(name, model, parent, example, **version)
            found.append((search_id, number, float(b.auc), b.trial))
        if found:
            table = store.spark.createDataFrame(found, "search_id STRING, version INT, auc DOUBLE, trial_start INT")
            write_shard_results(table, store.path("shard_results"))
    top = max(best, key=lambda b: b.auc)
    succeeded = results.where("status = 'OK'").select("trial").distinct().count()
    return {"best_auc": top.auc, "best_accuracy": top.accuracy, "succeeded": succeeded, "shards": len(best)}


def promote_best(store: Store, name: str, search_id: str, planned: int, allow_partial: bool = False) -> int:
    """Move the champion to the best version of a search, if every planned shard delivered."""
    results = read_shard_results(store.spark, store.path("shard_results"), search_id)
    top = global_best(results).first()
    if top is None or top.version is None:
        raise RuntimeError(f"no shard results for {search_id}")
    if top.shards < planned and not allow_partial:
        raise RuntimeError(f"{planned - top.shards} of {planned} shards of {search_id} have no result")
    store.set_alias(name, top.version)
    return top.version
