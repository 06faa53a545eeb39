"""Registry, batch scoring, search and streams end to end."""

import json
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from test_boost import PARAMS, frame, make

from coppice.operators.blocks import BLOCK_BYTES
from coppice.operators.grid import sample_trials, shard_plan, trial_shard
from coppice.operators.metrics import curve_gap
from coppice.operators.registry import compare_trials, latest_version
from coppice.operators.split import held_out, split_overlap
from coppice.plans import search as searching
from coppice.plans import train as training
from coppice.plans.inference import batch_inference, train_and_register
from coppice.plans.queries import fixed_nodes
from coppice.plans.search import promote_best, run_search
from coppice.plans.train import TrainParams
from coppice.sources.store import SCHEMAS
from coppice.sources.files import ensure_namespace, read_shard_results, write_shard_results
from coppice.streaming import serve


@pytest.fixture(scope="module")
def rows(spark):
    return frame(spark, make(500, 11)).drop("split").persist()


def fixed(spark, model_id, rounds=2):
    nodes = fixed_nodes(spark, rounds).withColumn("model_id", F.lit(model_id))
    return SimpleNamespace(model_id=model_id, nodes=nodes, edges=None, n_class=3, n_features=4)


def test_versions_and_aliases(spark, store):
    with pytest.raises(LookupError):
        store.resolve("a.b.m")
    for i in range(11):
        assert store.register("a.b.m", fixed(spark, f"m{i}")) == i + 1
    assert store.register("a.b.other", fixed(spark, "o")) == 1
    # No champion yet: the latest version, 11 and not 9.
    assert store.resolve("a.b.m").version == 11
    store.set_alias("a.b.m", 9)
    assert store.resolve("a.b.m").version == 9
    store.set_alias("a.b.m", 3)
    assert store.resolve("a.b.m").model_id == "m2" and store.alias_version("a.b.m") == 3
    assert store.resolve("", "models:/a.b.m/10").version == 10
    assert store.resolve("", "models:/a.b.m@nobody").version == 11
    with pytest.raises(LookupError):
        store.set_alias("a.b.m", 99)
    texts = store.read("model_versions").withColumn("version", F.col("version").cast("string"))
    assert latest_version(texts, "a.b.m").first().version == 11


def test_namespace(spark):
    ensure_namespace(spark, "coppice_ns")
    ensure_namespace(spark, "coppice_ns")
    assert "coppice_ns" in [r[0] for r in spark.sql("SHOW SCHEMAS").collect()]
    spark.sql("DROP SCHEMA coppice_ns")


def test_train_register_and_score(spark, store, rows, tmp_path):
    model, metrics, run_id, version = train_and_register(store, rows, "a.b.m", PARAMS, test_size=0.3, split_seed=5)
    assert version == 1 and set(metrics) == {"accuracy", "auc_ovr_macro", "log_loss", "train_seconds"}
    params = {r.key: r.value for r in store.read("run_params").collect()}
    assert params["subsample"] == "1.0" and params["num_classes"] == "3" and params["seed"] == "42"
    assert curve_gap(store.read("run_metrics")).count() == PARAMS.n_estimators
    saved = store.resolve("a.b.m")
    example = json.loads(saved.input_example_json)["inputs"]
    assert len(example) == 5 and len(example[0]) == 4
    assert json.loads(saved.signature_json)["inputs"]["fields"][0]["name"] == "features"

    done = batch_inference(store, rows, "a.b.m", str(tmp_path / "out"))
    # The stored settings select the rows training did not see.
    assert done["n_rows"] == 150 and done["rejected"] == 0
    assert done["accuracy"] == pytest.approx(metrics["accuracy"])
    out = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert out.columns == ["row_id", "predicted_class", "predicted_probability", "true_label"]
    again = held_out(rows, "row_id", test_size=0.3, seed=5)
    assert split_overlap(again.select(F.col("row_id").cast("string")), out, "row_id").first().overlap == 150

    unlabelled = batch_inference(store, rows.drop("label"), "a.b.m", str(tmp_path / "all"), fmt="parquet")
    assert unlabelled["n_rows"] == 500 and "accuracy" not in unlabelled
    assert "true_label" not in spark.read.parquet(str(tmp_path / "all")).columns


def test_registration_can_be_left_out(store, rows):
    _, _, run_id, version = train_and_register(
        store, rows, "a.b.m", TrainParams(1, 2, max_bins=8), register=False
    )
    assert version is None and store.read("model_versions").count() == 0
    assert store.read("runs").first().run_id == run_id


def test_grid_does_not_depend_on_shards(spark):
    ids = spark.range(20).select(F.col("id").cast("int").alias("trial"))
    grid = sample_trials(ids, 1)
    whole = {r.trial: r for r in grid.collect()}
    part = sample_trials(ids.where("trial BETWEEN 5 AND 9"), 1).collect()
    assert all(whole[r.trial] == r for r in part) and len(part) == 5
    assert {r.trial for r in trial_shard(grid, 18, 10).collect()} == {18, 19}
    nine = ids.where("trial < 9")
    assert sorted((r.shard, r.trial_start, r.trial_count) for r in shard_plan(nine, 4).collect()) == [
        (0, 0, 3), (1, 3, 3), (2, 6, 3),
    ]


SPACE = {"max_depth": ("int", [2, 3]), "learning_rate": ("double", [0.1, 0.3])}
BASE = TrainParams(n_estimators=2, max_depth=2, max_bins=8)


def test_search(spark, store, rows):
    done = run_search(store, rows, "a.b.s", total=3, workers=2, batch_size=2, base=BASE, space=SPACE)
    assert done["succeeded"] == 3 and done["shards"] == 2
    results = {r.trial: r for r in store.read("trial_results").collect()}
    assert [results[t].shard for t in range(3)] == [0, 0, 1]
    best = max(results.values(), key=lambda r: r.auc)
    champion = store.resolve("a.b.s")
    assert champion.version == done["version"] and champion.model_id == best.model_id
    compared = compare_trials(store.read("runs"), store.read("run_metrics"), "auc", "accuracy").collect()
    assert {r.run_name: r.auc for r in compared} == {f"trial-{t:02d}": r.auc for t, r in results.items()}


def cached_batches(df):
    """Rows and bytes of each batch that Spark keeps of a persisted table."""
    kept = df._jdf.queryExecution().withCachedData().cacheBuilder().cachedColumnBuffers().collect()
    return [(b.numRows(), b.sizeInBytes()) for b in kept]


def test_a_search_caches_small_batches(spark, store, monkeypatch):
    """The serializer of a cached partition holds 100 batches at a time, of 4 MB each by itself."""
    many, seen = frame(spark, make(6000, 11), 1).drop("split"), {}
    metrics, auc = searching.trial_metrics, searching.auc_per_class

    def see_blocks(blocks, n_class, n_trials):
        found = metrics(blocks, n_class, n_trials)
        seen["blocks"], seen["rows"] = cached_batches(blocks), blocks.agg(F.sum("n")).first()[0]
        return found

    def see_scored(scored, *args, **named):
        out = auc(scored, *args, **named)
        seen["scored"] = cached_batches(scored)
        return out

    monkeypatch.setattr(searching, "trial_metrics", see_blocks)
    monkeypatch.setattr(searching, "auc_per_class", see_scored)
    done = run_search(store, many, "a.b.s", total=4, workers=1, base=replace(BASE, n_estimators=2), space=SPACE, register=False)
    assert done["succeeded"] == 4 and seen["rows"] == 6000
    assert len(seen["blocks"]) > 4 and max(size for _, size in seen["blocks"]) < BLOCK_BYTES + 2000
    assert sum(n for n, _ in seen["scored"]) == 1200 and max(size for _, size in seen["scored"]) < 200_000


def test_a_failed_pass_leaves_nothing_cached(spark, monkeypatch):
    prepared = training.prepare(frame(spark, make(300, 5)), 16)
    states, persisted = [], training.persisted
    monkeypatch.setattr(training, "persisted", lambda df, n: states.append(df) or persisted(df, n))
    monkeypatch.setattr(training, "losses_of", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        training.boost(prepared, [replace(PARAMS, n_estimators=2)], ["x"])
    assert len(states) == 2 and not any(s.is_cached for s in states)
    prepared.release()


def test_a_bad_trial_does_not_take_others_along(store, rows):
    space = {"max_depth": ("int", [2, 99])}
    done = run_search(store, rows, "a.b.s", total=4, workers=1, base=BASE, space=space, seed=1, validation_size=0.25)
    status = {r.trial: (r.status, r.error) for r in store.read("trial_results").collect()}
    failed = [t for t, (s, _) in status.items() if s == "FAILED"]
    assert 0 < len(failed) < 4 and done["succeeded"] == 4 - len(failed)
    assert all("max_depth" in status[t][1] for t in failed)


def test_a_failing_pass_is_repeated_trial_by_trial(store, rows, monkeypatch):
    real = searching._train_batch

    def fragile(prepared, batch, search_id):
        if any(trial == 1 for trial, _ in batch):
            raise RuntimeError("lost")
        return real(prepared, batch, search_id)

    monkeypatch.setattr(searching, "_train_batch", fragile)
    with pytest.raises(RuntimeError, match="1 of 3 shards"):
        run_search(store, rows, "a.b.s", total=3, workers=3, base=BASE, space=SPACE, search_id="x")
    assert store.alias_version("a.b.s") is None
    assert {r.trial: r.status for r in store.read("trial_results").collect()} == {0: "OK", 1: "FAILED", 2: "OK"}
    assert promote_best(store, "a.b.s", "x", 3, allow_partial=True) in (1, 2)


def test_all_trials_fail(store, rows):
    with pytest.raises(RuntimeError, match="all trials"):
        run_search(store, rows, "a.b.s", total=2, workers=1, base=BASE, space={"max_depth": ("int", [0])})


def test_version_numbers_under_several_writers(spark, store):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: store.claim_version("a/b.m"), range(20)))
        models = list(pool.map(lambda i: store.register("a.b.n", fixed(spark, f"m{i}")), range(4)))
    assert sorted(got) == list(range(1, 21)) and sorted(models) == [1, 2, 3, 4]
    assert sorted(r.version for r in store.read("model_versions").collect()) == [1, 2, 3, 4]


def test_a_search_that_was_lost_logs_each_trial_once(spark, store, rows, monkeypatch):
    append, failed = store.append, []

    def lost(table, new):
        if table == "trial_results" and not failed:
            failed.append(1)
            raise RuntimeError("driver lost")
        append(table, new)

    monkeypatch.setattr(store, "append", lost)
    go = lambda: run_search(store, rows, "a.b.s", total=2, workers=1, base=TrainParams(n_estimators=1, max_depth=2), search_id="x")
    with pytest.raises(RuntimeError, match="driver lost"):
        go()
    go()
    shown = compare_trials(store.read("runs"), store.read("run_metrics"), "auc").collect()
    assert len({r.run_id for r in shown}) == 2 and len(shown) - len({(r.parent_run_id, r.run_id) for r in shown}) == 0
    results = store.read("trial_results").where("search_id = 'x'").collect()
    assert sorted(r.trial for r in results) == [0, 1]


def test_searches_do_not_mix(spark, store):
    path = store.path("shard_results")
    for search, auc, version in (("s1", 0.5, 1), ("s2", 0.9, 2), ("s1", 0.5, 3)):
        row = spark.createDataFrame([(search, version, auc, 0)], "search_id STRING, version INT, auc DOUBLE, trial_start INT")
        write_shard_results(row, path)
        store.register("a.b.m", fixed(spark, f"m{version}"))
    assert read_shard_results(spark, path, "s1").count() == 2
    assert promote_best(store, "a.b.m", "s1", 2) == 3  # equal AUC: the higher version


def arriving(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    src = str(src)
    schema = "row_id BIGINT, features ARRAY<FLOAT>, label INT"
    return src, spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_stream_equals_batch(spark, store, rows, tmp_path):
    src, stream = arriving(spark, tmp_path)
    rows.repartition(3).write.mode("append").parquet(src)
    nodes = fixed_nodes(spark)
    out = str(tmp_path / "out")
    serve.score_stream(stream, nodes, 3, 4, out, str(tmp_path / "cp")).awaitTermination()
    cols = ["row_id", "proba", "predicted_class", "predicted_probability"]
    want = serve.score_rows(rows, nodes, 3, 4).select(*cols)
    got = spark.read.parquet(out).select(*cols)
    assert sorted(got.collect()) == sorted(want.collect())


def test_a_model_is_read_once_by_a_stream(spark, store, rows, tmp_path, monkeypatch):
    src, stream = arriving(spark, tmp_path)
    store.set_alias("a.b.m", store.register("a.b.m", fixed(spark, "one")))
    for i in range(3):
        rows.where(F.col("row_id") % 3 == i).repartition(1).write.mode("append").parquet(src)
    read, out = [], str(tmp_path / "out")
    load = store.load_nodes
    monkeypatch.setattr(store, "load_nodes", lambda model_id: read.append(model_id) or load(model_id))
    q = serve.score_current(stream, store, None, "a.b.m", "row_id", out, str(tmp_path / "cp"))
    q.awaitTermination()
    assert len(q.recentProgress) >= 3 and read == ["one"]
    assert spark.read.parquet(out).count() == 500 and not (tmp_path / "out-rejected").exists()


def test_a_stream_of_another_type_raises(spark, store, rows, tmp_path):
    version = store.register("a.b.m", fixed(spark, "one"), example=rows)
    store.set_alias("a.b.m", version)
    src, stream = arriving(spark, tmp_path)
    rows.write.mode("append").parquet(src)
    doubles = stream.withColumn("features", F.col("features").cast("array<double>"))
    signature = store.resolve("a.b.m").signature_json
    with pytest.raises(TypeError, match="takes features"):
        serve.score_stream(doubles, fixed_nodes(spark), 3, 4, str(tmp_path / "o"), str(tmp_path / "c"), signature_json=signature)
    with pytest.raises(Exception, match="takes features"):
        serve.score_current(doubles, store, None, "a.b.m", "row_id", str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    serve.score_stream(stream, fixed_nodes(spark), 3, 4, str(tmp_path / "o2"), str(tmp_path / "c2"), signature_json=signature).awaitTermination()


def test_promotion_reaches_a_running_stream(spark, store, rows, tmp_path):
    src, stream = arriving(spark, tmp_path)
    store.set_alias("a.b.m", store.register("a.b.m", fixed(spark, "one")))
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    go = lambda: serve.score_current(stream, store, None, "a.b.m", "row_id", out, cp).awaitTermination()
    rows.where("row_id < 200").write.mode("append").parquet(src)
    go()
    store.set_alias("a.b.m", store.register("a.b.m", fixed(spark, "two", 1)))
    rows.where("row_id >= 200").write.mode("append").parquet(src)
    go()
    got = spark.read.parquet(out).select("row_id", "model_version").collect()
    assert {r.row_id: r.model_version for r in got} == {i: 1 if i < 200 else 2 for i in range(500)}


def test_responses_keep_the_order_of_inputs(spark):
    payload = json.dumps({"inputs": [[float(i), 0.0, 0.01 * i, 0.0] for i in (40, 3, 26)]})
    df = spark.createDataFrame([("a", payload), ("b", "{"), ("c", '{"x": 1}')], "request_id STRING, payload STRING")
    parsed = serve.parse_requests(df)
    assert parsed.count() == 3 and serve.rejected_requests(df).count() == 2
    scored = serve.score_rows(parsed.repartition(3), fixed_nodes(spark), 3, 4)
    answer = json.loads(serve.responses(scored).first().response)["predictions"]
    want = [r.proba for r in scored.orderBy("pos").collect()]
    assert [pytest.approx(w) for w in want] == answer


def test_routes(spark):
    keys = spark.range(5000).withColumnRenamed("id", "k")
    routed = serve.route(keys, "k", {"a": 90, "b": 10, "c": 0})
    n = {r.served_model: r["count"] for r in routed.groupBy("served_model").count().collect()}
    assert set(n) == {"a", "b"} and abs(n["b"] - 500) < 100
    for bad in ({"a": 90}, {"a": 110, "b": -10}):
        with pytest.raises(ValueError):
            serve.route(keys, "k", bad)


def test_streamed_quality(spark, tmp_path):
    rows = spark.range(2000).select(
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 300)").alias("ts"),
        (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 3 % 2).cast("int").alias("predicted_class"),
    )
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.repartition(1).write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    q = (
        serve.windowed_quality(stream).writeStream.outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    want = {r.window_start: (r.n, r.accuracy) for r in serve.windowed_quality(rows).collect()}
    got = {r.window_start: (r.n, r.accuracy) for r in spark.read.parquet(out).collect()}
    # The last day stays open: no later row has moved the watermark past it.
    assert len(want) == 7 and set(got) == set(sorted(want)[:-1])
    assert all(got[k] == want[k] for k in got)


def test_a_routed_batch_is_not_kept(spark, store, tmp_path, monkeypatch):
    """Models of different widths and classes behind one stream: a pass that keeps no rows scores each by its own."""
    other = spark.createDataFrame([("w", 0, 1, 0, True, None, None, None, None, None, None, 0.5, None, None)], SCHEMAS["model_nodes"])
    store.set_alias("a.b.m", store.register("a.b.m", fixed(spark, "one")))
    store.register("a.b.m", SimpleNamespace(model_id="w", nodes=other, edges=None, n_class=2, n_features=2))
    src, stream = arriving(spark, tmp_path)
    wide = spark.range(300).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit(30.0), F.lit(2.0), F.lit(0.03), F.lit(4.0)))
        .when(F.col("id") % 3 == 1, F.array(F.lit(1.0), F.lit(2.0))).cast("array<float>").alias("features"),
        F.lit(0).alias("label"),
    )
    wide.repartition(3).write.mode("append").parquet(src)
    kept, persist = [], type(wide).persist
    monkeypatch.setattr(type(wide), "persist", lambda self, *a: kept.append(self.columns) or persist(self, *a))
    out = str(tmp_path / "out")
    shares = lambda: {"models:/a.b.m/1": 60, "models:/a.b.m/2": 40}
    serve.score_current(stream, store, shares, "a.b.m", "row_id", out, str(tmp_path / "cp")).awaitTermination()
    assert not [c for c in kept if "features" in c]
    got = spark.read.parquet(out).collect()
    short = [1 / (1 + 2.718281828459045**0.5), 1 / (1 + 2.718281828459045**-0.5)]
    full = serve.score_rows(wide.where("row_id = 0"), fixed_nodes(spark), 3, 4).first().proba
    assert {r.model_version for r in got} == {1, 2}
    assert all(r.proba == pytest.approx(full if r.model_version == 1 else short) for r in got)
    assert all(r.row_id % 3 == r.model_version - 1 for r in got)
    refused = spark.read.parquet(f"{out}-rejected").collect()
    reasons = {(r.model_version, r.row_id % 3): r.reason for r in refused}
    assert len(got) + len(refused) == 300 and reasons == {
        (1, 1): "expected 4 features, got 2", (2, 0): "expected 2 features, got 4", (1, 2): "no features", (2, 2): "no features",
    }
