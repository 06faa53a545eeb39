"""Distributed histogram boosting.

One boosting round grows one tree per class, level by level. A level is one pass over
the rows (partial histograms per task, summed by Spark), a split search on the summed
cells, and a handful of rows on the driver: the chosen splits. Several trials of a
search share every pass. Between rounds only the margins of the rows change; the first
pass of the next round computes them. Losses are kept per block and read now and then.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import asdict, dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.hashing import round_coefficients, row_hash, sample_cutoff
from ..operators.binning import edge_lists, edge_ranks, edge_table
from ..operators.blocks import (
    FIXED,
    WRITTEN,
    bin_blocks,
    block_rows,
    joined,
    lists,
    raw_columns,
    read_blocks,
    to_raw_blocks,
    unpack,
    without_margin,
)
from ..operators.histogram import (
    SPLIT_COLUMNS,
    Grown,
    Level,
    Pass,
    descend,
    fixed_scale,
    level_splits,
    merged_splits,
    slice_count,
)
from ..operators.quantiles import chunk_limit, order_statistics
from ..operators.sampling import sample_features
from ..session import ADAPTIVE, new_path, persisted, remove, written
from ..sources.store import SCHEMAS

NODES = SCHEMAS["model_nodes"]
CURVES = "model_id STRING, step INT, train_mlogloss DOUBLE, test_mlogloss DOUBLE"

# Most histogram cells one pass asks of a task (two BIGINT each); wider levels take
# several passes.
MAX_CELLS = 8_000_000
_STEP = T.StructType(
    [T.StructField("margin", T.BinaryType()), T.StructField("loss", T.ArrayType(T.DoubleType()))]
)
# Looks at a bin that a level costs a task from which on half of them are saved: only the lighter one of
# two siblings is summed then, and the sums of a level are kept for the next. Below, keeping them takes
# longer than summing both. Trees are the same either way.
SUBTRACT_LOOKS = 32_000_000
# Most training rows of one partition of the blocks.
TASK_ROWS = 2_000_000
# Node rows kept on the driver before they are written out.
_FLUSH_NODES = 200_000


@dataclass(frozen=True)
class TrainParams:
    n_estimators: int = 200
    max_depth: int = 8
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    min_child_weight: float = 1.0
    reg_lambda: float = 1.0
    max_bins: int = 64
    seed: int = 42

    def validate(self) -> None:
        problems = [
            name
            for name, ok in (
                ("n_estimators", self.n_estimators >= 1),
                ("max_depth", 1 <= self.max_depth <= 20),
                ("learning_rate", self.learning_rate > 0),
                ("subsample", 0 < self.subsample <= 1),
                ("colsample_bytree", 0 < self.colsample_bytree <= 1),
                ("min_child_weight", self.min_child_weight >= 0),
                ("reg_lambda", self.reg_lambda >= 0),
                ("max_bins", 2 <= self.max_bins <= 32_000),
            )
            if not ok
        ]
        if problems:
            raise ValueError(f"out of range: {', '.join(problems)} in {asdict(self)}")


@dataclass
class Prepared:
    """Binned rows in blocks, shared by all trials, and what was learned while binning."""

    blocks: DataFrame
    edges: DataFrame
    cuts: list[list[float]]
    n_class: int
    n_features: int
    n_train: int
    n_tasks: int
    paths: list[str]

    @property
    def n_bins(self) -> int:
        """Bin numbers in use: 0 for missing values, one more than there are cuts."""
        return max(len(c) for c in self.cuts) + 2

    def release(self) -> None:
        """Give back the memory and delete the written blocks."""
        self.blocks.unpersist()
        for path in self.paths:
            remove(self.blocks.sparkSession, path)
        self.paths.clear()


@dataclass
class Model:
    """A trained ensemble as tables."""

    model_id: str
    nodes: DataFrame
    edges: DataFrame
    curves: DataFrame
    n_class: int
    n_features: int
    params: TrainParams
    train_seconds: float
    extra: dict = field(default_factory=dict)


def prepare(df: DataFrame, max_bins: int = 64, n_trials: int = 1) -> Prepared:
    """Bin ``row_id, features, label, split`` by the quantiles of the training rows and
    persist the result. Rows of other splits are binned with the same edges. Blocks are
    cut for the margins of ``n_trials`` trials.

    ``df`` is read once: its rows are stored in blocks, and checks, edges and bins come from these."""
    spark = df.sparkSession
    known = df.where("split = 'train' OR (split = 'test' AND label IS NOT NULL)").select(
        "features",
        F.col("label").cast("int").alias("label"),
        (F.col("split") == "train").alias("is_train"),
        row_hash("row_id").alias("row_hash"),
    )
    kind = np.dtype(np.float32 if dict(df.dtypes)["features"] == "array<float>" else np.float64)
    raw = known.withColumn("features", F.col("features").cast("array<float>" if kind == np.float32 else "array<double>"))
    raw, raw_path = written(to_raw_blocks(raw).withColumn("task", F.spark_partition_id()), "rows", **WRITTEN)
    raw = read_blocks(raw, raw_path)
    try:
        train = raw.where("is_train")
        seen = train.agg(
            F.max("task").alias("last_task"),
            F.sum("n").alias("n"),
            F.sum("unlabelled").alias("unlabelled"),
            F.min("narrow").alias("narrow"),
            F.max("wide").alias("wide"),
        ).first()
        if not seen.n:
            raise ValueError("no training rows")
        labels = train.select(F.explode("labels").alias("label")).agg(
            F.min("label").alias("low"), F.max("label").alias("top"), F.count_distinct("label").alias("k")
        ).first()
        if seen.unlabelled or labels.low != 0 or labels.top + 1 != labels.k:
            raise ValueError(f"training labels must be 0..K-1 without gaps or nulls: {seen.asDict() | labels.asDict()}")
        if seen.narrow != seen.wide:
            raise ValueError(f"feature counts differ: {seen.narrow} to {seen.wide}")
        tasks = seen.last_task + 1
        spread = max(spark.sparkContext.defaultParallelism, -(-seen.n // TASK_ROWS))
        if tasks < spread:
            raw = raw.repartition(spread)
            tasks = spread
        found, lowest = order_statistics(
            raw.where("is_train").select("n", "features"), raw_columns(kind), edge_ranks(max_bins), chunk_limit(tasks)
        )
        cuts = edge_lists(found, lowest, seen.wide)
        # Every pass reads this table, so it is written once: lost blocks come from here and
        # not from the raw input, and the plans of the rounds stay short.
        rows = block_rows(seen.wide, max(len(c) for c in cuts) + 2, labels.k * n_trials)
        blocks, path = written(bin_blocks(raw, cuts, kind, rows), "blocks", **WRITTEN)
        blocks = read_blocks(blocks, path)
    finally:
        remove(spark, raw_path)
    blocks = persisted(blocks, 1)
    return Prepared(blocks, edge_table(spark, cuts), cuts, labels.k, seen.wide, seen.n, tasks, [path])


class _Round:
    """Trees of one round of all trials while they grow (driver side, a few rows each)."""

    def __init__(self, prepared: Prepared, trials: list[TrainParams], round_no: int):
        self.p, self.trials, self.round_no = prepared, trials, round_no
        k = prepared.n_class
        self.n_trees = len(trials) * k
        self.grown = Grown(self.n_trees)
        self.params = [trials[t // k] for t in range(self.n_trees)]
        self.features = [
            sample_features(prepared.n_features, t.colsample_bytree, t.seed, round_no, c)
            for t in trials
            for c in range(k)
        ]
        self.samples = [
            (*round_coefficients(t.seed, round_no), sample_cutoff(t.subsample)) for t in trials
        ]
        self.active = [round_no < p.n_estimators for p in self.params]
        # (tree, level, position) -> (G, H) of nodes without a split; chosen splits alike.
        self.leaves: dict[tuple[int, int, int], tuple[float, float]] = {}
        self.splits: dict[tuple[int, int, int], object] = {}

    def _pass(self, wanted: list[tuple[int, int]], level: int, scale: float) -> Pass:
        slots = {}
        for tree in sorted({t for t, _ in wanted}):
            at = np.full(1 << level, -1, np.int64)
            mine = sorted(p for t, p in wanted if t == tree)
            at[mine] = np.arange(len(mine))
            slots[tree] = at
        return Pass(
            self.p.n_features, self.p.n_bins, self.p.n_class, scale, self.grown,
            self.samples, self.features, slots,
        )

    def grow(self, blocks: DataFrame, scale: float) -> None:
        lam = [p.reg_lambda for p in self.params]
        weight = [p.min_child_weight for p in self.params]
        chunk = max(1, MAX_CELLS // (self.p.n_features * self.p.n_bins))
        n_slices = slice_count(self.p.n_tasks, self.p.n_features, self.p.n_bins)
        deepest = max(p.max_depth for p in self.params)
        looks = self.p.n_train // self.p.n_tasks * sum(len(f) for f, on in zip(self.features, self.active) if on)
        subtract = looks >= SUBTRACT_LOOKS
        pairs: dict[tuple[int, int], tuple[int, int | None]] = {(t, 0): (0, None) for t in range(self.n_trees) if self.active[t]}
        level, before = 0, []
        while pairs:
            found, kept, todo = [], [], sorted(pairs)
            for start in range(0, len(todo), chunk):
                mine = {k: pairs[k] for k in todo[start : start + chunk]}
                summed = self._pass([(t, small) for (t, _), (small, _) in mine.items()], level, scale)
                step = Level(summed, mine, n_slices, lam, weight, keep=subtract and level + 1 < deepest)
                rows = level_splits(blocks, step, reduce(DataFrame.union, before) if before else None, self.p.n_tasks)
                if step.keep:
                    rows = persisted(rows, 1)
                    kept.append(rows)
                    rows = rows.select(*SPLIT_COLUMNS)
                found += rows.collect()
            for rows in before:
                rows.unpersist()
            before, pairs = kept, self._decide(merged_splits(found), level, subtract)
            level += 1
        for rows in before:
            rows.unpersist()

    def _decide(self, found: list, level: int, subtract: bool) -> dict[tuple[int, int], tuple[int, int | None]]:
        """Takes over the splits of a level. Returns what the next one sums: with ``subtract`` of each parent
        the lighter child, with the other one, else each child for itself."""
        self.grown.add_level()
        pairs: dict[tuple[int, int], tuple[int, int | None]] = {}
        for s in found:
            params = self.params[s.tree]
            # Of a pair only one may have been asked for; the other has its totals from its parent.
            if level and self.leaves[(s.tree, level, s.node)][1] < 2 * params.min_child_weight:
                continue
            if s.feature is None:
                if level == 0:
                    self.leaves[(s.tree, 0, 0)] = (s.g_all, s.h_all)
                continue
            self.splits[(s.tree, level, s.node)] = s
            self.leaves.pop((s.tree, level, s.node), None)
            self.grown.split[level][s.tree, s.node] = True
            self.grown.feature[level][s.tree, s.node] = s.feature
            self.grown.cut[level][s.tree, s.node] = s.bin
            self.grown.missing_right[level][s.tree, s.node] = not s.missing_left
            children = [(s.h_left, 2 * s.node, s.g_left), (s.h_right, 2 * s.node + 1, s.g_right)]
            for h, child, g in children:
                self.leaves[(s.tree, level + 1, child)] = (g, h)
            wanted = [child for h, child, _ in children if h >= 2 * params.min_child_weight]
            if level + 1 >= params.max_depth or not wanted:
                continue
            if subtract:
                (_, small, _), (_, other, _) = sorted(children)
                pairs[(s.tree, s.node)] = (small, other)
            else:
                pairs |= {(s.tree, child): (child, None) for child in wanted}
        return pairs

    def value(self, tree: int, g: float, h: float) -> float:
        below = h + self.params[tree].reg_lambda
        return -g * self.params[tree].learning_rate / below if below > 0 else 0.0

    def leaf_array(self) -> np.ndarray:
        """Leaf value per tree and last-level position."""
        depth = len(self.grown.feature)
        leaf = np.zeros((self.n_trees, 1 << depth))
        for (tree, level, at), (g, h) in self.leaves.items():
            leaf[tree, at << (depth - level)] = self.value(tree, g, h)
        return leaf

    def nodes(self, ids: list[str]) -> list[tuple]:
        k = self.p.n_class
        out = []
        for (tree, level, at), s in self.splits.items():
            me = (1 << level) - 1 + at
            cut = self.p.cuts[s.feature]
            # Bin 0 alone on the left: every value goes right, only missing rows go left.
            threshold = cut[s.bin - 1] if s.bin > 0 else -float("inf")
            out.append((
                ids[tree // k], self.round_no, tree % k, me, False, s.feature, s.bin, threshold,
                s.missing_left, 2 * me + 1, 2 * me + 2, None, s.gain, s.h_left + s.h_right,
            ))
        for (tree, level, at), (g, h) in self.leaves.items():
            me = (1 << level) - 1 + at
            out.append((
                ids[tree // k], self.round_no, tree % k, me, True, None, None, None, None, None,
                None, self.value(tree, g, h), None, h,
            ))
        return out


def _advance(blocks: DataFrame, prepared: Prepared, grown: Grown, leaf: np.ndarray) -> DataFrame:
    """Blocks with the new trees added to their margins, and the summed log loss of each
    trial appended to their history."""
    n_features, n_bins, n_class, n_trees = prepared.n_features, prepared.n_bins, prepared.n_class, len(leaf)
    depth = len(grown.feature)

    @F.arrow_udf(_STEP)
    def stepped(bins: pa.Array, label: pa.Array, row_hash: pa.Array, margin: pa.Array) -> pa.Array:
        columns = {"bins": bins, "label": label, "row_hash": row_hash, "margin": margin}
        blocks = list(unpack(columns, n_features, n_bins, n_trees))
        block = joined(blocks)
        m = block.margin.copy()
        rows = np.arange(len(m), dtype=np.int32)
        for t in range(n_trees):
            for level, at, r in descend(block.bins, rows, t, grown):
                m[r, t] += leaf[t][at << (depth - level)]
        trials = m.reshape(len(m), n_trees // n_class, n_class)
        top = trials.max(axis=2)
        total = np.log(np.exp(trials - top[:, :, None]).sum(axis=2))
        hit = trials[np.arange(len(m)), :, block.label]
        ends = np.cumsum([len(b.label) for b in blocks])
        margins = [part.tobytes() for part in np.split(m, ends[:-1])]
        losses = [part.sum(axis=0) for part in np.split(total + top - hit, ends[:-1])]
        return pa.StructArray.from_arrays([pa.array(margins, pa.binary()), lists(np.array(losses))], ["margin", "loss"])

    step = blocks.withColumn("_step", stepped("bins", "label", "row_hash", "margin"))
    history = F.concat("loss", "_step.loss").alias("loss")
    return step.select(*FIXED, F.col("_step.margin").alias("margin"), history)


def losses_of(blocks: DataFrame, n_steps: int) -> list[tuple[float, float]]:
    """``(train, test)`` log loss of each entry of the loss history: one job for all."""
    sums = []
    for flag in (True, False):
        mine = lambda c, flag=flag: F.sum(F.when(F.col("is_train") == flag, c))
        sums += [(mine(F.get("loss", F.lit(i))) / mine(F.col("n"))).alias(f"{flag}{i}") for i in range(n_steps)]
    got = blocks.agg(*sums).first()
    return [(got[f"True{i}"], got[f"False{i}"]) for i in range(n_steps)]


def boost(
    prepared: Prepared,
    trials: list[TrainParams],
    model_ids: list[str],
    checkpoint_every: int = 10,
    journal: str | None = None,
) -> tuple[list[Model], DataFrame]:
    """Train all trials at once. Returns the models and the blocks with their final margins
    (``n_class`` entries per trial), persisted.

    ``journal`` names a shared folder. What every ``checkpoint_every`` rounds have made is committed
    there, and a later call with the same rows, trials and model ids goes on behind the last commit,
    with the same result. The folder stays until ``remove`` deletes it."""
    for t in trials:
        t.validate()
    spark = prepared.edges.sparkSession
    k = prepared.n_class
    scale = fixed_scale(prepared.n_train)
    started = time.time()
    state = without_margin(prepared.blocks)
    nodes, parts, curves = [], [], []
    before, unread, last_path, done = None, 0, None, 0
    rounds = max(t.n_estimators for t in trials)
    mark = _fingerprint(prepared, trials, model_ids)
    if journal and (entry := _last_commit(spark, journal)):
        if entry.fingerprint != mark:
            raise ValueError(f"{journal} holds another training")
        done, parts, last_path = entry["round"], list(entry.nodes), entry.margins
        curves = [tuple(c) for c in json.loads(entry.curves)]
        saved = prepared.blocks.sparkSession.read.schema(without_margin(prepared.blocks).drop("loss").schema).parquet(last_path)
        state = persisted(saved.withColumn("loss", F.array().cast("array<double>")), 1)
    # The jobs of a level are many, small, and have their partitions given: they need no second plan between
    # their stages. The blocks' session is theirs alone.
    own = prepared.blocks.sparkSession.conf
    adaptive = own.get(ADAPTIVE)
    own.set(ADAPTIVE, "false")
    try:
        for round_no in range(done, rounds):
            current = _Round(prepared, trials, round_no)
            current.grow(state.where("is_train").select("bins", "margin", "label", "row_hash"), scale)
            if before is not None:
                # The first pass of the round has filled the cache of ``state``.
                before.unpersist()
            before, state = state, _advance(state, prepared, current.grown, current.leaf_array())
            state = persisted(state, 1)
            nodes += current.nodes(model_ids)
            if len(nodes) > _FLUSH_NODES:
                parts.append(_write_nodes(spark, nodes))
                nodes = []
            unread += 1
            last = round_no + 1 == rounds
            if last or (round_no + 1) % checkpoint_every == 0:
                for i, (train, test) in enumerate(losses_of(state, unread * len(trials))):
                    step, t = round_no + 1 - unread + i // len(trials), i % len(trials)
                    if step < trials[t].n_estimators:
                        curves.append((model_ids[t], step, train, test))
                unread = 0
                before.unpersist()
                before = None
            if not last and (round_no + 1) % checkpoint_every == 0:
                saved, path = written(state.drop("loss"), "margins", journal, **WRITTEN)
                state.unpersist()
                state = saved.withColumn("loss", F.array().cast("array<double>"))
                if journal:
                    if nodes:
                        parts.append(_write_nodes(spark, nodes, journal))
                        nodes = []
                    _commit(spark, journal, (round_no + 1, mark, path, parts, json.dumps(curves)))
                else:
                    prepared.paths.append(path)
                if last_path:
                    if not journal:
                        prepared.paths.remove(last_path)
                    remove(spark, last_path)
                last_path = path
                state = persisted(state, 1)
    except BaseException:
        for kept in (before, state):
            if kept is not None:
                kept.unpersist()
        raise
    finally:
        own.set(ADAPTIVE, adaptive)
    seconds = time.time() - started
    table = spark.createDataFrame(nodes, NODES)
    for path in parts:
        table = table.unionByName(spark.read.schema(NODES).parquet(path))
    curve_table = spark.createDataFrame(curves, CURVES)
    models = [
        Model(
            model_id,
            table.where(F.col("model_id") == model_id),
            prepared.edges.select(F.lit(model_id).alias("model_id"), "*"),
            curve_table.where(F.col("model_id") == model_id),
            k, prepared.n_features, params, seconds,
        )
        for model_id, params in zip(model_ids, trials)
    ]
    return models, state


def _write_nodes(spark: SparkSession, nodes: list[tuple], folder: str | None = None) -> str:
    path = new_path(spark, "nodes", folder)
    spark.createDataFrame(nodes, NODES).write.parquet(path)
    return path


_ENTRY = "round INT, fingerprint STRING, margins STRING, nodes ARRAY<STRING>, curves STRING"


def _fingerprint(prepared: Prepared, trials: list[TrainParams], model_ids: list[str]) -> str:
    """Digest of all that decides a training's result, but for the rows themselves."""
    facts = [[asdict(t) for t in trials], model_ids, prepared.cuts, prepared.n_class, prepared.n_train]
    return hashlib.md5(json.dumps(facts).encode()).hexdigest()


def _commit(spark: SparkSession, journal: str, entry: tuple) -> None:
    """One more entry. It counts once its folder has been written to the end."""
    spark.createDataFrame([entry], _ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{journal}/entries/{entry[0]:08d}")


def _last_commit(spark: SparkSession, journal: str):
    """The entry of the latest round, or None. A folder that was not finished holds no rows yet."""
    try:
        entries = spark.read.schema(_ENTRY).option("recursiveFileLookup", True).parquet(f"{journal}/entries")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return None
    return entries.orderBy(F.desc("round")).first()


def train(
    df: DataFrame,
    params: TrainParams = TrainParams(),
    model_id: str | None = None,
    journal: str | None = None,
) -> Model:
    """Train one model on ``row_id, features, label, split``. With a ``journal`` (see ``boost``) a training
    whose driver was lost goes on where it was; its model needs an id then."""
    params.validate()
    if journal and not model_id:
        raise ValueError("a training with a journal needs a model id")
    prepared = prepare(df, params.max_bins)
    try:
        (model,), state = boost(prepared, [params], [model_id or uuid.uuid4().hex], journal=journal)
        state.unpersist()
    finally:
        prepared.release()
    return model
