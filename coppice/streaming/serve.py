"""Continuous scoring with Structured Streaming.

Requests are rows of a streaming source. All operators below are stateless except the
quality monitor, which is a watermarked aggregate.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.hashing import hex_to_bigint
from ..functions.proba import argmax, confidence
from ..operators.registry import CHAMPION
from ..operators.scoring import Packed, packed, score, score_packed, score_routed
from ..sources.features import fitting_rows, split_by_width
from ..sources.store import Store, check_features

_REQUEST = "inputs ARRAY<ARRAY<FLOAT>>"
_BUCKETS = 100


def _inputs(payload: str) -> Column:
    # NULL for broken JSON and for JSON without "inputs" alike.
    return F.from_json(payload, _REQUEST).getField("inputs")


def parse_requests(df: DataFrame, key: str = "request_id", payload: str = "payload") -> DataFrame:
    """``{"inputs": [[...], ...]}`` to one row per input: ``key, pos, features``."""
    parsed = df.withColumn("_inputs", _inputs(payload)).where("_inputs IS NOT NULL")
    return parsed.select(
        *[c for c in df.columns if c != payload], F.posexplode("_inputs").alias("pos", "features")
    )


def rejected_requests(df: DataFrame, key: str = "request_id", payload: str = "payload") -> DataFrame:
    """Requests that could not be read or hold no inputs, with a reason."""
    reason = F.when(_inputs(payload).isNull(), "malformed request").when(F.size(_inputs(payload)) == 0, "no inputs")
    return df.withColumn("reason", reason).where("reason IS NOT NULL").select(key, payload, "reason")


def responses(scored: DataFrame, key: str = "request_id") -> DataFrame:
    """``{"predictions": [[...], ...]}`` per request, in the order of its inputs. The rows
    of one request come from one payload, so their list is bounded by it."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "proba")))
    return scored.groupBy(key).agg(ordered.alias("_rows")).select(
        key, F.to_json(F.struct(F.col("_rows.proba").alias("predictions"))).alias("response")
    )


def predicted_class(prediction: Column | str, is_vector: bool = True) -> Column:
    """Class of a prediction: the largest entry of a vector, or the value itself."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    return argmax(p) if is_vector else p.cast("int")


def route(df: DataFrame, key: Column | str, weights: dict[str, int], seed: int = 42) -> DataFrame:
    """Add ``served_model`` by weight in percent. A key always gets the same model."""
    if sum(weights.values()) != _BUCKETS or min(weights.values()) < 0:
        raise ValueError(f"weights must be non-negative and sum to {_BUCKETS}: {weights}")
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", F.lit(seed), k.cast("string")))
    bucket = hex_to_bigint(digest, 1, 8) % _BUCKETS
    chosen, upto = F.lit(None).cast("string"), 0
    for name, weight in weights.items():
        upto += weight
        chosen = F.coalesce(chosen, F.when(bucket < upto, F.lit(name)))
    return df.withColumn("served_model", chosen)


def score_rows(df: DataFrame, nodes: DataFrame, n_class: int, n_features: int) -> DataFrame:
    """Scored rows with class and confidence; works on streams and tables alike. Every row has to
    fit the model (``split_by_width`` takes the others out)."""
    return _classified(score(df, nodes, n_class, n_features))


def _classified(scored: DataFrame) -> DataFrame:
    return scored.withColumns({"predicted_class": argmax("proba"), "predicted_probability": confidence("proba")})


def _write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """One folder per batch, written anew when the batch is repeated after a failure."""
    df.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")


def _score_batch(
    rows: DataFrame, n_features: int | Column, scored: Callable[[DataFrame], DataFrame],
    path: str, rejects: str, batch_id: int, fmt: str,
) -> None:
    """Scores and writes a micro-batch in one pass over its rows, which keeps none of them. Only where that
    pass has met rows that do not fit is the batch read for them."""
    fitting, seen = fitting_rows(rows, n_features)
    _write_batch(_classified(scored(fitting)), path, batch_id, fmt)
    if seen.get["refused"]:
        _write_batch(split_by_width(rows, n_features)[1], rejects, batch_id, fmt)


def score_stream(
    stream: DataFrame, nodes: DataFrame, n_class: int, n_features: int, path: str, checkpoint: str,
    fmt: str = "parquet", once: bool = True, rejects: str | None = None, signature_json: str | None = None,
) -> StreamingQuery:
    """Score arriving rows with one fixed model into ``path``. Rows that do not fit the model go
    to ``rejects`` (``<path>-rejected`` by default) with a reason and hold nothing up. The model is
    read and sent out once, before the first batch. With the signature of a registered version,
    features of another type raise at once."""
    rejects = rejects or f"{path}-rejected"
    if signature_json is not None:
        check_features(signature_json, stream.schema)
    model = packed(nodes, n_class, n_features)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        _score_batch(batch, n_features, lambda rows: score_packed(rows, model), path, rejects, batch_id, fmt)

    writer = stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


class ModelCache:
    """Models a stream is using, packed and sent out once each."""

    def __init__(self, store: Store):
        self.store, self.models, self.fixed = store, {}, {}

    def resolve(self, name: str, uri: str):
        """Row of the version behind a reference. A version number means the same row for ever; aliases are
        looked up again."""
        if uri not in self.fixed:
            version = self.store.resolve(name, uri)
            if uri != f"models:/{version.name}/{version.version}":
                return version
            self.fixed[uri] = version
        return self.fixed[uri]

    def get(self, version) -> Packed:
        if version.model_id not in self.models:
            nodes = self.store.load_nodes(version.model_id)
            self.models[version.model_id] = packed(nodes, version.num_class, version.num_features)
        return self.models[version.model_id]

    def keep(self, model_ids: set[str]) -> None:
        """Give back all other models."""
        for old in set(self.models) - model_ids:
            self.models.pop(old).release()


def score_current(
    stream: DataFrame,
    store: Store,
    weights: Callable[[], dict[str, int]] | None,
    name: str,
    key: str,
    path: str,
    checkpoint: str,
    once: bool = True,
    rejects: str | None = None,
) -> StreamingQuery:
    """Score arriving rows with whatever model is current when a micro-batch starts.

    ``weights`` returns ``{reference: percent}`` (champion at 100 % by default) and is asked
    again for every batch, as are the aliases, so a promotion takes effect on a running
    stream. A model is read when it is first met and kept while it is in use. Every row carries the
    version that scored it. A batch writes its own folder and overwrites it when it is repeated
    after a failure. Rows that do not fit the model they are routed to go to ``rejects``
    (``<path>-rejected`` by default) with a reason; features of another type than those the model
    was registered with raise.
    """
    rejects = rejects or f"{path}-rejected"
    cache = ModelCache(store)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        routes = weights() if weights else {f"models:/{name}@{CHAMPION}": 100}
        current = {uri: cache.resolve(name, uri) for uri, percent in routes.items() if percent}
        versions = list(current.values())
        for version in versions:
            store.check_signature(version, batch)
        models = [cache.get(version) for version in versions]
        # Of the row's own model; with one scan, as a batch that is kept takes several times its size.
        own = lambda values: reduce(
            lambda before, uv: before.when(F.col("served_model") == uv[0], F.lit(uv[1])), zip(current, values), F
        )
        rows = route(batch, key, routes).withColumn("model_version", own(v.version for v in versions))
        which = own(range(len(models)))
        _score_batch(
            rows, own(m.n_features for m in models), lambda rows: score_routed(rows, models, which), path, rejects, batch_id, "parquet"
        )
        cache.keep({version.model_id for version in versions})

    writer = stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def instant(column: str, kind: str) -> Column:
    """A timestamp without time zone read as UTC; other timestamps as they are."""
    if kind != "timestamp_ntz":
        return F.col(column).cast("timestamp")
    micros = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {column})"
    return F.expr(f"timestamp_micros({micros})")


def windowed_quality(
    scored: DataFrame, time_col: str = "ts", window: str = "1 day", late: str = "1 hour"
) -> DataFrame:
    """Accuracy per time window of rows with ``label`` and ``predicted_class``. On a stream
    the watermark closes a window ``late`` after its end."""
    hit = (F.col("predicted_class") == F.col("label")).cast("double")
    kind = scored.schema[time_col].dataType.simpleString()
    return (
        scored.withColumn("_ts", instant(time_col, kind))
        .withWatermark("_ts", late)
        .groupBy(F.window("_ts", window).alias("w"))
        .agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))
        .select(F.col("w.start").alias("window_start"), "n", "accuracy")
    )
