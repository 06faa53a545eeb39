"""Tracking runs and registered models, kept as append-only parquet tables."""

from __future__ import annotations

import json
import threading
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..operators.binning import EDGE_SCHEMA
from ..operators.registry import CHAMPION, alias_current, latest_version, resolve_uri
from ..operators.scoring import score
from .files import SHARD_RESULT, read_shard_results

SCHEMAS = {
    "bin_edges": "model_id STRING, " + EDGE_SCHEMA,
    "model_nodes": (
        "model_id STRING, round INT, class_id INT, node_id INT, is_leaf BOOLEAN, feature INT, "
        "split_bin INT, threshold DOUBLE, missing_left BOOLEAN, left_id INT, right_id INT, "
        "leaf_value DOUBLE, gain DOUBLE, cover DOUBLE"
    ),
    "model_versions": (
        "name STRING, version INT, run_id STRING, model_id STRING, num_class INT, "
        "num_features INT, signature_json STRING, input_example_json STRING, test_size DOUBLE, "
        "split_seed INT, split_cuts_json STRING, max_samples BIGINT, sample_cut STRING"
    ),
    "model_aliases": "name STRING, alias STRING, version INT, seq BIGINT",
    "runs": "run_id STRING, parent_run_id STRING, run_name STRING, status STRING, started_at TIMESTAMP",
    "run_params": "run_id STRING, key STRING, value STRING",
    "run_metrics": "run_id STRING, key STRING, step INT, value DOUBLE",
    "trial_results": (
        "search_id STRING, trial INT, shard INT, status STRING, auc DOUBLE, accuracy DOUBLE, "
        "train_seconds DOUBLE, model_id STRING, error STRING"
    ),
}
# Tables with one folder per model, written whole or not at all.
_BY_MODEL = ("bin_edges", "model_nodes")


def check_features(signature_json: str, schema: T.StructType, model: str = "the model") -> None:
    """Raise when the features of a table or stream are of another type than a signature says."""
    wanted = T.StructType.fromJson(json.loads(signature_json)["inputs"])["features"].dataType
    got = schema["features"].dataType
    if not isinstance(got, T.ArrayType) or got.elementType != wanted.elementType:
        raise TypeError(f"{model} takes features as {wanted}, not as {got}")


# Claims of threads of one driver; those of different drivers are kept apart by the file system.
_CLAIMS = threading.Lock()


class Store:
    """Tables below one shared folder. Every addition is a folder of its own, so that several writers do
    not meet; of version numbers each is given out once (``claim_version``)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def append(self, table: str, rows) -> None:
        """Add a DataFrame, or a list of tuples in schema order."""
        schema = T.StructType.fromDDL(SCHEMAS[table])
        if isinstance(rows, DataFrame):
            df = rows
        else:
            df = self.spark.createDataFrame(rows, schema).coalesce(1)
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        df.write.parquet(f"{self.path(table)}/{uuid.uuid4().hex}")

    def read(self, table: str) -> DataFrame:
        """The whole table; empty before its first row."""
        reader = self.spark.read.schema(SCHEMAS[table]).option("recursiveFileLookup", True)
        try:
            return reader.parquet(self.path(table))
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return self.spark.createDataFrame([], SCHEMAS[table])

    def shard_results(self, search_id: str) -> DataFrame:
        """Results of one search's shards; empty before the first."""
        try:
            return read_shard_results(self.spark, self.path("shard_results"), search_id)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return self.spark.createDataFrame([], f"{SHARD_RESULT}, search_id STRING")

    # Runs ---------------------------------------------------------------------

    def log_run(
        self,
        run_name: str,
        params: dict | None = None,
        metrics: dict | None = None,
        curves: DataFrame | None = None,
        parent_run_id: str | None = None,
        status: str = "FINISHED",
        run_id: str | None = None,
    ) -> str:
        """One run with its parameters, metrics and per-round curves
        ``(step, train_mlogloss, test_mlogloss)``. A parent makes it a nested run."""
        run_id = run_id or uuid.uuid4().hex
        started = self.spark.range(1).select(
            F.lit(run_id).alias("run_id"), F.lit(parent_run_id).cast("string").alias("parent_run_id"),
            F.lit(run_name).alias("run_name"), F.lit(status).alias("status"),
            F.current_timestamp().alias("started_at"),
        )
        self.append("runs", started)
        if params:
            self.append("run_params", [(run_id, k, str(v)) for k, v in params.items()])
        if metrics:
            known = [(run_id, k, 0, float(v)) for k, v in metrics.items() if v is not None]
            self.append("run_metrics", known)
        if curves is not None:
            pairs = F.array(*[
                F.struct(F.lit(k).alias("key"), F.col(k).alias("value"))
                for k in ("train_mlogloss", "test_mlogloss")
            ])
            long = curves.select("step", F.inline(pairs)).where("value IS NOT NULL")
            self.append("run_metrics", long.select(F.lit(run_id).alias("run_id"), "key", "step", "value"))
        return run_id

    def end_run(self, run_id: str, run_name: str, status: str, parent_run_id: str | None = None) -> None:
        """Log how a run ended; its last logged row is its state (``registry.run_states``)."""
        self.log_run(run_name, parent_run_id=parent_run_id, status=status, run_id=run_id)

    # Models -------------------------------------------------------------------

    def _folder(self, table: str, model_id: str) -> str:
        return f"{self.path(table)}/model_id={model_id}"

    def has_model(self, model_id: str) -> bool:
        """Whether the nodes of a model were written to the end."""
        done = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder("model_nodes", model_id) + "/_SUCCESS")
        return done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done)

    def save_model(self, model_id: str, nodes: DataFrame, edges: DataFrame | None = None) -> None:
        """Write the tables of one model, each as one folder. A model that is stored stays as it
        is, what a lost attempt left behind is replaced; the nodes, which tell whether a model is
        stored, come last."""
        if self.has_model(model_id):
            return
        for table, rows in zip(_BY_MODEL, (edges, nodes)):
            if rows is not None:
                fields = [f for f in T.StructType.fromDDL(SCHEMAS[table]) if f.name != "model_id"]
                columns = [F.col(f.name).cast(f.dataType) for f in fields]
                rows.select(*columns).write.mode("overwrite").parquet(self._folder(table, model_id))

    def load_nodes(self, model_id: str) -> DataFrame:
        """The nodes of one model; only its folder is listed."""
        if not self.has_model(model_id):
            raise LookupError(f"no model {model_id} in {self.root}")
        fields = [f for f in T.StructType.fromDDL(SCHEMAS["model_nodes"]) if f.name != "model_id"]
        nodes = self.spark.read.schema(T.StructType(fields)).parquet(self._folder("model_nodes", model_id))
        return nodes.select(F.lit(model_id).alias("model_id"), "*")

    def claim_version(self, name: str) -> int:
        """The next version number of a model, for this caller alone: whoever creates the number's marker
        file has it, everyone else tries the next one."""
        last = latest_version(self.read("model_versions"), name).first()
        version = (last.version if last else 0) + 1
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = f"{self.root}/version_claims/{quote(name, safe='')}"
        while True:
            marker = hadoop.Path(f"{folder}/{version:08d}")
            with _CLAIMS:
                if marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).createNewFile(marker):
                    return version
            version += 1

    def register(
        self,
        name: str,
        model,
        run_id: str | None = None,
        example: DataFrame | None = None,
        test_size: float = 0.2,
        split_seed: int = 42,
        split_cuts: DataFrame | None = None,
        max_samples: int = 0,
        sample_cut: str | None = None,
    ) -> int:
        """New version of ``name``; a number is lost where registering fails half-way. Keeps the types of inputs and outputs, a few real rows with
        their predictions, and the split with its cuts, so that scoring holds out the same rows
        also when the table has grown since."""
        self.save_model(model.model_id, model.nodes, model.edges)
        version = self.claim_version(name)
        if example is None:
            example = self.spark.createDataFrame([], "features ARRAY<FLOAT>")
        scored = score(
            example.select("features").limit(5), self.load_nodes(model.model_id), model.n_class, model.n_features
        )
        rows = scored.collect()
        signature = {
            "inputs": scored.select("features").schema.jsonValue(),
            "outputs": scored.select("proba").schema.jsonValue(),
        }
        shown = {"inputs": [r.features for r in rows], "predictions": [r.proba for r in rows]}
        cuts = json.dumps([list(r) for r in split_cuts.collect()]) if split_cuts is not None else None
        self.append("model_versions", [(
            name, version, run_id, model.model_id, model.n_class, model.n_features,
            json.dumps(signature), json.dumps(shown), float(test_size), int(split_seed), cuts,
            int(max_samples), sample_cut,
        )])
        return version

    def set_alias(self, name: str, version: int, alias: str = CHAMPION) -> None:
        """Move an alias. The order of moves is a sequence number, so the last one wins."""
        if not self.read("model_versions").where(
            (F.col("name") == name) & (F.col("version") == version)
        ).limit(1).count():
            raise LookupError(f"{name} has no version {version}")
        moves = self.read("model_aliases").agg(F.max("seq").alias("seq")).first().seq
        self.append("model_aliases", [(name, alias, version, (moves or 0) + 1)])

    def alias_version(self, name: str, alias: str = CHAMPION) -> int | None:
        row = alias_current(self.read("model_aliases")).where(
            (F.col("name") == name) & (F.col("alias") == alias)
        ).first()
        return row.version if row else None

    def resolve(self, name: str, uri: str = ""):
        """Row of ``model_versions`` behind a reference; the champion by default, the
        latest version where the reference leads nowhere."""
        request = self.spark.range(1).select(F.lit(uri).alias("uri"))
        got = resolve_uri(request, self.read("model_versions"), self.read("model_aliases"), name).first()
        if got.version is None:
            raise LookupError(f"no version of {got.name or uri}: train and register a model first")
        return self.read("model_versions").where(
            (F.col("name") == got.name) & (F.col("version") == got.version)
        ).first()

    def check_signature(self, version, df: DataFrame) -> None:
        """Raise when the features of ``df`` are of another type than those the model was
        registered with."""
        check_features(version.signature_json, df.schema, f"{version.name} {version.version}")

    def cuts_of(self, version) -> DataFrame | None:
        """The split of a version, one row per class; None where it was registered without."""
        if version.split_cuts_json is None:
            return None
        return self.spark.createDataFrame(
            [tuple(c) for c in json.loads(version.split_cuts_json)], "label INT, cut STRING"
        )
