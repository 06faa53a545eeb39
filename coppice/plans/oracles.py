"""The queries of :mod:`queries` as plain SQL on the same tables, for comparison."""

from __future__ import annotations

import hashlib

Y3 = """
SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS row_id,
       CAST(l_quantity AS FLOAT) AS f0, CAST(l_extendedprice AS FLOAT) AS f1, CAST(l_discount AS FLOAT) AS f2,
       CAST(l_tax AS FLOAT) AS f3, CAST(l_quantity > 25 AS INT) + CAST(l_discount > 0.05 AS INT) AS label
FROM lineitem
"""
Y3_WIDE = f"""
SELECT row_id, CAST(f0 AS DOUBLE) AS f0, CAST(f1 AS DOUBLE) AS f1, CAST(f2 AS DOUBLE) AS f2, CAST(f3 AS DOUBLE) AS f3, label
FROM ({Y3})
"""


def split_sql(source: str, key: str, label: str, size: str = "0.2", seed: int = 42) -> str:
    """All columns of ``source`` with ``split``: plain ranks inside each class."""
    return f"""
    SELECT * EXCLUDE (rk, quota), CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS split FROM (
      SELECT r.*, q.quota FROM (
        SELECT s.*, row_number() OVER (PARTITION BY {label} ORDER BY md5(concat_ws(':', '{seed}', {key}))) AS rk
        FROM ({source}) s) r
      JOIN (
        SELECT {label}, fl + CASE WHEN row_number() OVER (ORDER BY ex - fl DESC, {label}) <= seats - sum(fl) OVER ()
                             THEN 1 ELSE 0 END AS quota
        FROM (
          SELECT {label}, count(*) * CAST({size} AS DECIMAL(18,9)) AS ex,
                 CAST(floor(count(*) * CAST({size} AS DECIMAL(18,9))) AS BIGINT) AS fl,
                 CAST(ceil(CAST(sum(count(*)) OVER () AS BIGINT) * CAST({size} AS DECIMAL(18,9))) AS BIGINT) AS seats
          FROM ({source}) c GROUP BY {label})
      ) q USING ({label}))
    """


Y3_SPLIT = split_sql(Y3, "row_id", "label")
BINS = 32
SCALE = 2**20

# Edges of the training rows: values of rank ceil(j * n / bins) above the minimum.
EDGES = f"""
train AS (SELECT * FROM y3s WHERE split = 'train'),
vals AS (
  SELECT 0 AS feature, CAST(f0 AS DOUBLE) AS v FROM train UNION ALL SELECT 1, CAST(f1 AS DOUBLE) FROM train
  UNION ALL SELECT 2, CAST(f2 AS DOUBLE) FROM train UNION ALL SELECT 3, CAST(f3 AS DOUBLE) FROM train),
ranked AS (
  SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) AS rk,
         count(*) OVER (PARTITION BY feature) AS n, min(v) OVER (PARTITION BY feature) AS lo FROM vals),
cuts AS (
  SELECT DISTINCT feature, v FROM ranked JOIN range(1, {BINS}) j(j) ON rk = (j.j * n + {BINS - 1}) // {BINS}
  WHERE v > lo),
edges AS (
  SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY v) AS INT) AS bin, v AS upper FROM cuts)
"""


def _bin(f: str, i: int) -> str:
    return f"CAST(1 + len(list_filter((SELECT u{i} FROM lists), lambda u: u <= CAST({f} AS DOUBLE))) AS INT)"


BINNED = f"""
WITH y3s AS MATERIALIZED ({Y3_SPLIT}), {EDGES},
lists AS (SELECT {", ".join(f"list(upper) FILTER (feature = {i}) AS u{i}" for i in range(4))} FROM edges),
binned AS MATERIALIZED (
  SELECT row_id, split, label, {", ".join(f"{_bin(f'f{i}', i)} AS b{i}" for i in range(4))} FROM y3s)
"""

# Fixed-point derivatives of round 0, where every probability is 1/3.
_G = f"CAST(round_even((1.0::DOUBLE / 3 - CASE WHEN label = tree THEN 1 ELSE 0 END) * {SCALE}, 0) AS BIGINT)"
_H = f"CAST(round_even((1.0::DOUBLE / 3) * (1 - 1.0::DOUBLE / 3) * {SCALE}, 0) AS BIGINT)"
CELLS = BINNED + f""",
long AS (
  SELECT k.tree, label, split, row_id, unnest([0, 1, 2, 3]) AS feature, unnest([b0, b1, b2, b3]) AS bin
  FROM binned, (SELECT unnest([0, 1, 2]) AS tree) k WHERE split = 'train'),
cells AS (
  SELECT tree, 0 AS node, feature, bin, CAST(sum({_G}) AS BIGINT) AS g, CAST(sum({_H}) AS BIGINT) AS h
  FROM long GROUP BY tree, feature, bin)
"""


def gains_sql(cells: str, scale: float) -> str:
    """Admissible splits of histogram cells with lambda 1 and weight 1; no missing values."""
    return f"""
    SELECT *, (gl * gl / (hl + 1) + gr * gr / (hr + 1) - ga * ga / (ha + 1)) * 0.5 AS gain FROM (
      SELECT *, ga - gl AS gr, ha - hl AS hr FROM (
        SELECT tree, node, feature, bin,
          CAST(sum(g) OVER w AS DOUBLE) / {scale} AS gl, CAST(sum(h) OVER w AS DOUBLE) / {scale} AS hl,
          CAST(sum(g) OVER p AS DOUBLE) / {scale} AS ga, CAST(sum(h) OVER p AS DOUBLE) / {scale} AS ha
        FROM {cells}
        WINDOW w AS (PARTITION BY tree, node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING),
               p AS (PARTITION BY tree, node, feature)))
    WHERE hl >= 1 AND hr >= 1
      AND (gl * gl / (hl + 1) + gr * gr / (hr + 1) - ga * ga / (ha + 1)) * 0.5 > 0
    """


def best_sql(gains: str) -> str:
    return f"""
    SELECT * FROM ({gains}) QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, feature, bin) = 1
    """


# The trainer uses a scale of 2^30 at this size.
_BIG = 2**30
BOOST = CELLS.replace(str(SCALE), str(_BIG)) + f""",
best0 AS ({best_sql(gains_sql("cells", float(_BIG)))}),
routed AS (
  SELECT l.*, CASE WHEN r.rb <= b.bin THEN 1 ELSE 2 END AS node
  FROM long l JOIN best0 b USING (tree)
  JOIN (SELECT tree AS rt, row_id AS rid, feature AS rf, bin AS rb FROM long) r
    ON r.rt = l.tree AND r.rid = l.row_id AND r.rf = b.feature),
cells1 AS (
  SELECT tree, node, feature, bin, CAST(sum({_G.replace(str(SCALE), str(_BIG))}) AS BIGINT) AS g,
         CAST(sum({_H.replace(str(SCALE), str(_BIG))}) AS BIGINT) AS h
  FROM routed GROUP BY tree, node, feature, bin),
best1 AS ({best_sql(gains_sql("cells1", float(_BIG)))}),
splits AS (SELECT * EXCLUDE (node), 0 AS node FROM best0 UNION ALL BY NAME SELECT * FROM best1),
children AS (
  SELECT tree, 2 * node + 1 AS node, gl AS g, hl AS h FROM splits
  UNION ALL SELECT tree, 2 * node + 2, gr, hr FROM splits),
nodes AS (
  SELECT tree AS class_id, node AS node_id, false AS is_leaf, feature, bin AS split_bin,
         round(upper, 6) AS threshold, CAST(NULL AS DOUBLE) AS leaf_value, round(gain, 3) AS gain,
         round(hl + hr, 4) AS cover
  FROM splits JOIN edges USING (feature, bin)
  UNION ALL
  SELECT c.tree, c.node, true, NULL, NULL, NULL, round(-c.g * 0.1 / (c.h + 1), 6), NULL, round(c.h, 4)
  FROM children c LEFT JOIN splits s ON s.tree = c.tree AND s.node = c.node WHERE s.tree IS NULL)
"""

# The fixed model of the queries.
_M = {
    1: (
        "CASE WHEN f0 < 25.5 THEN 0.9 ELSE -0.7 END",
        "CASE WHEN f2 < 0.055 THEN 0.25 ELSE 0.5 END",
        "CASE WHEN f0 < 25.5 THEN -0.8 ELSE 0.6 END",
    ),
    2: (
        "CASE WHEN f2 < 0.055 THEN 0.4 WHEN f1 < 30000 THEN -0.2 ELSE -0.45 END",
        "0.125",
        "CASE WHEN f2 < 0.055 THEN -0.5 ELSE 0.35 END",
    ),
}


def fixed_sql(source: str, rounds: int = 2) -> str:
    """All columns of ``source`` (with f0, f1, f2) and the probabilities p0, p1, p2."""
    margins = ", ".join(
        "0.0::DOUBLE" + "".join(f" + CAST({_M[r][k]} AS DOUBLE)" for r in range(1, rounds + 1)) + f" AS m{k}"
        for k in range(3)
    )
    top = "greatest(m0, m1, m2)"
    total = f"(exp(m0 - {top}) + exp(m1 - {top}) + exp(m2 - {top}))"
    probas = ", ".join(f"exp(m{k} - {top}) / {total} AS p{k}" for k in range(3))
    return f"SELECT * EXCLUDE (m0, m1, m2), {probas} FROM (SELECT s.*, {margins} FROM ({source}) s)"


Y3_DOUBLE = f"SELECT row_id, label, CAST(f0 AS DOUBLE) AS f0, CAST(f1 AS DOUBLE) AS f1, CAST(f2 AS DOUBLE) AS f2 FROM ({Y3})"
FIXED = fixed_sql(Y3_DOUBLE)
_ARG3 = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END"
_ROUNDED = "round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2"

# Probabilities of ten classes, long form.
EMB = """
WITH m AS (
  SELECT vec_id, label, class_id, list_sum(list_transform(range(class_id, 64, 10), lambda i: CAST(embedding[i + 1] AS DOUBLE))) AS m
  FROM (SELECT *, unnest(range(0, 10)) AS class_id FROM embeddings)),
p AS (
  SELECT vec_id, label, CAST(class_id AS INT) AS class_id,
         exp(m - max(m) OVER v) / sum(exp(m - max_m)) OVER v AS p
  FROM (SELECT *, max(m) OVER (PARTITION BY vec_id) AS max_m FROM m)
  WINDOW v AS (PARTITION BY vec_id))
"""


def auc_sql(rows: str) -> str:
    """One-vs-rest AUC per class of ``(class_id, p, hit)`` rows from plain average ranks."""
    return f"""
    SELECT class_id, CAST(sum(hit) AS BIGINT) AS positives, CAST(sum(1 - hit) AS BIGINT) AS negatives,
           (sum(hit * rk) - sum(hit) * (sum(hit) + 1) / 2.0) / (CAST(sum(hit) AS DOUBLE) * sum(1 - hit)) AS auc
    FROM (
      SELECT class_id, hit, (rank() OVER (PARTITION BY class_id ORDER BY p) * 2.0
             + count(*) OVER (PARTITION BY class_id, p) - 1) / 2 AS rk FROM {rows})
    GROUP BY class_id
    """


_PRICE = "floor(o_totalprice / 1000) / 1000"
TRIALS = f"""
SELECT o_orderpriority AS search_id, CAST(o_orderkey AS INT) AS trial, CAST(o_custkey % 16 AS INT) AS shard,
       CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'OK' END AS status, {_PRICE} AS auc,
       (o_orderkey % 97) / 97.0::DOUBLE AS accuracy, CAST(o_custkey % 60 AS DOUBLE) AS train_seconds
FROM orders
"""
RUNS = """
SELECT concat('c', c_custkey) AS run_id, NULL AS parent_run_id, c_name AS run_name, 'FINISHED' AS status FROM customer
UNION ALL
SELECT concat('o', o_orderkey), concat('c', o_custkey), concat('trial-', o_orderkey), o_orderstatus FROM orders
"""
CHILDREN = f"""
SELECT r.parent_run_id, p.run_name AS parent_name, r.run_id, r.run_name, r.status
FROM ({RUNS}) r JOIN ({RUNS}) p ON p.run_id = r.parent_run_id
"""
LATEST = "SELECT concat('shop.m', o_custkey) AS name, CAST(max(o_orderkey) AS INT) AS version FROM orders GROUP BY 1"
ALIASES = """
SELECT concat('shop.m', o_custkey) AS name,
       CASE WHEN o_orderpriority LIKE '1%' THEN 'champion' ELSE 'candidate' END AS alias,
       CAST(max(o_orderkey) AS INT) AS version, max(o_orderkey) AS seq FROM orders GROUP BY 1, 2
"""
_SPACE = (
    ("max_depth", "[4, 6, 8, 10, 12]", "INT"),
    ("learning_rate", "[0.02, 0.05, 0.1, 0.2, 0.3]", "DOUBLE"),
    ("subsample", "[0.6, 0.7, 0.8, 0.9, 1.0]", "DOUBLE"),
    ("colsample_bytree", "[0.6, 0.7, 0.8, 0.9, 1.0]", "DOUBLE"),
    ("min_child_weight", "[1, 3, 5, 7]", "INT"),
    ("reg_lambda", "[0.5, 1.0, 2.0, 5.0]", "DOUBLE"),
)


def _hash8(text: str) -> str:
    return f"CAST(concat('0x', substr(md5({text}), 1, 8)) AS BIGINT)"


_GRID_COLUMNS = []
for _name, _values, _kind in _SPACE:
    _digest = _hash8(f"concat_ws(':', 42, c_custkey, '{_name}')")
    _GRID_COLUMNS.append(f"CAST(({_values})[1 + {_digest} % len({_values})] AS {_kind}) AS {_name}")
GRID = f"SELECT CAST(c_custkey AS INT) AS trial, {', '.join(_GRID_COLUMNS)} FROM customer"

# Coefficients of round 3 with seed 42 come from the md5 of '42:3'.
_COEF = "CAST(concat('0x', substr(md5('42:3'), {start}, 7)) AS BIGINT)"
_P = 2**31 - 1

# Requests that parse: two rows each.
REQUESTS = """
SELECT event_id AS request_id, pos, CAST(f0 AS FLOAT)::DOUBLE AS f0, CAST(f1 AS FLOAT)::DOUBLE AS f1,
       CAST(f2 AS FLOAT)::DOUBLE AS f2, CAST(f3 AS FLOAT)::DOUBLE AS f3
FROM (
  SELECT event_id, 0 AS pos, event_id % 50 + 0.5 AS f0, user_id * 1000 AS f1, 0.0625 AS f2, 0.02 AS f3 FROM events
  UNION ALL SELECT event_id, 1, user_id % 50, 100.25, 0.03125, 0.5 FROM events)
WHERE event_id % 10 NOT IN (3, 7)
"""
_TRIAL_SPLIT = split_sql("SELECT o_orderkey, o_orderstatus FROM orders", "o_orderkey", "o_orderstatus")
_Y3_KEYS = f"SELECT row_id, label FROM ({Y3})"

ORACLES = {
    "load_features": Y3_WIDE,
    "load_features_csv": Y3_WIDE,
    "stage_dataset": Y3_WIDE,
    "predictions_csv": f"SELECT row_id, {_ARG3} AS predicted_class, round(greatest(p0, p1, p2), 6) AS predicted_probability, label AS true_label FROM ({FIXED})",
    "shard_results_json": f"SELECT o_orderpriority AS search_id, CAST(o_orderkey AS INT) AS version, {_PRICE} AS auc, CAST(o_custkey AS INT) AS trial_start FROM orders",
    "run_metrics_latest": "SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS key, CAST(max(event_id) AS INT) AS step, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2",
    "label_shift": "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS label FROM orders",
    "label_index": "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INT) AS class_id FROM orders",
    "num_class": f"SELECT max(label) + 1 AS num_class, count(DISTINCT label) AS distinct_labels, min(label) AS min_label FROM ({Y3})",
    "class_distribution": f"SELECT label, count(*) AS n FROM ({Y3}) GROUP BY 1",
    "subsample": "SELECT o_orderkey FROM orders ORDER BY md5(concat_ws(':', '42', o_orderkey)) LIMIT 5000",
    "stratified_split": f"SELECT o_orderkey, split FROM ({_TRIAL_SPLIT})",
    "three_way_split": f"""
        WITH a AS ({_TRIAL_SPLIT}),
        b AS ({split_sql("SELECT o_orderkey, o_orderstatus FROM a WHERE split = 'train'", "o_orderkey", "o_orderstatus", "0.2", 43)})
        SELECT a.o_orderkey, CASE WHEN b.split = 'test' THEN 'validation' ELSE a.split END AS split
        FROM a LEFT JOIN b ON a.o_orderkey = b.o_orderkey""",
    "held_out": f"SELECT row_id, label FROM ({Y3_SPLIT}) WHERE split = 'test'",
    "split_counts": f"SELECT split, label, count(*) AS n FROM ({Y3_SPLIT}) GROUP BY 1, 2",
    "split_overlap": f"""
        WITH a AS ({split_sql(_Y3_KEYS, "row_id", "label")}), b AS ({split_sql(_Y3_KEYS, "row_id", "label", "0.2", 7)})
        SELECT 'train_test' AS pair, count(*) AS overlap FROM a x JOIN a y ON x.row_id = y.row_id WHERE x.split = 'train' AND y.split = 'test'
        UNION ALL SELECT 'two_seeds', count(*) FROM a JOIN b ON a.row_id = b.row_id WHERE a.split = 'test' AND b.split = 'test'""",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "preview": f"SELECT row_id, label, f0, f1, f2, f3 FROM ({Y3_WIDE}) ORDER BY row_id LIMIT 5",
    "tail_rows": f"SELECT row_id, {_ARG3} AS predicted_class FROM ({FIXED}) ORDER BY row_id DESC LIMIT 3",
    "reject_bad_width": """
        SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS row_id,
               concat('expected 4 features, got ', 4 - l_linenumber % 3) AS reason
        FROM lineitem WHERE l_linenumber % 3 <> 0""",
    "quantile_edges": f"WITH y3s AS ({Y3_SPLIT}), {EDGES} SELECT feature, bin, upper FROM edges",
    "bin_features": BINNED + "SELECT row_id, split, b0, b1, b2, b3 FROM binned",
    "row_subsample": f"""
        SELECT row_id FROM ({Y3})
        WHERE (({_hash8("row_id")} % {_P}) * greatest(1, {_COEF.format(start=1)}) + {_COEF.format(start=8)}) % {_P} < {int(0.8 * _P)}""",
    "column_subsample": """
        SELECT round, class_id, feature FROM (
          SELECT round, class_id, CAST(feature AS INT) AS feature, row_number() OVER (PARTITION BY round, class_id
                 ORDER BY md5(concat_ws(':', 42, round, class_id, feature))) AS rk
          FROM (SELECT DISTINCT l_linenumber AS round, CAST(l_quantity > 25 AS INT) + CAST(l_discount > 0.05 AS INT) AS class_id FROM lineitem),
               range(0, 54) f(feature))
        WHERE rk <= 43""",
    "softmax": EMB + "SELECT vec_id, class_id, round(p, 6) AS p FROM p",
    "grad_hess": f"""
        SELECT row_id, class_id, round(1.0 / 3 - CASE WHEN label = class_id THEN 1 ELSE 0 END, 6)::DOUBLE AS g,
               round(2.0::DOUBLE / 9, 6) AS h
        FROM ({Y3}), (SELECT unnest([0, 1, 2]) AS class_id)""",
    "grad_histogram": CELLS + "SELECT tree, node, feature, bin, g, h FROM cells",
    "node_histograms": CELLS + "SELECT tree, node, feature, bin, g, h FROM cells",
    "split_gain": CELLS + f"SELECT tree, node, feature, bin, round(gain, 4) AS gain FROM ({gains_sql('cells', float(SCALE))})",
    "best_split": CELLS + f"SELECT tree, node, feature, bin, round(gain, 4) AS gain, round(hl, 4) AS h_left, round(hr, 4) AS h_right FROM ({best_sql(gains_sql('cells', float(SCALE)))})",
    "leaf_values": CELLS + f"""
        SELECT tree, node, round(-g * 0.1 / (h + 1), 9) AS leaf_value, round(h, 4) AS cover
        FROM (SELECT tree, node, CAST(sum(g) AS DOUBLE) / {SCALE} AS g, CAST(sum(h) AS DOUBLE) / {SCALE} AS h FROM cells WHERE feature = 0 GROUP BY 1, 2)""",
    "boost_round": BOOST + "SELECT * FROM nodes",
    "score_fixed_model": f"SELECT row_id, {_ROUNDED} FROM ({FIXED})",
    "score_native": f"SELECT row_id, {_ROUNDED} FROM ({FIXED})",
    "eval_curve": f"""
        WITH s AS ({split_sql(Y3_DOUBLE, "row_id", "label")}),
        a AS (SELECT 0 AS step, split, label, 1.0::DOUBLE / 3 AS p0, 1.0::DOUBLE / 3 AS p1, 1.0::DOUBLE / 3 AS p2 FROM s
              UNION ALL SELECT 1, split, label, p0, p1, p2 FROM ({fixed_sql("SELECT * FROM s", 1)})
              UNION ALL SELECT 2, split, label, p0, p1, p2 FROM ({fixed_sql("SELECT * FROM s", 2)})),
        l AS (SELECT step, split, -ln(least(greatest([p0, p1, p2][label + 1], pow(2.0, -23)), 1 - pow(2.0, -23))) AS loss FROM a)
        SELECT step, round(avg(loss) FILTER (split = 'train'), 6) AS train_mlogloss,
               round(avg(loss) FILTER (split = 'test'), 6) AS test_mlogloss FROM l GROUP BY step""",
    "argmax_class": EMB + "SELECT vec_id, min(class_id) FILTER (p = top) AS predicted_class, round(max(p), 6) AS predicted_probability FROM (SELECT *, max(p) OVER (PARTITION BY vec_id) AS top FROM p) GROUP BY vec_id",
    "accuracy": f"SELECT round(avg(CAST({_ARG3} = label AS INT)), 9) AS accuracy, count(*) AS n FROM ({FIXED})",
    "log_loss": EMB + "SELECT round(avg(-ln(least(greatest(p, pow(2.0, -23)), 1 - pow(2.0, -23)))), 6) AS log_loss FROM p WHERE class_id = label",
    "confusion": f"SELECT label, {_ARG3} AS predicted_class, count(*) AS n FROM ({FIXED}) GROUP BY 1, 2",
    "auc_per_class": EMB + f"SELECT class_id, positives, negatives, round(auc, 9) AS auc FROM ({auc_sql('(SELECT class_id, p, CAST(label = class_id AS INT) AS hit FROM p)')})",
    "auc_ties": f"""
        WITH f AS ({FIXED}), l AS (SELECT k AS class_id, [p0, p1, p2][k + 1] AS p, CAST(label = k AS INT) AS hit FROM f, (SELECT unnest([0, 1, 2]) AS k))
        SELECT class_id, positives, negatives, round(auc, 9) AS auc FROM ({auc_sql("l")})""",
    "auc_crowded": f"""
        WITH s AS (SELECT CAST(l_quantity + l_extendedprice / 4000 > 30 AS INT) AS label, CASE WHEN l_linenumber + l_suppkey % 50 = 1
            THEN l_discount ELSE CAST(0.3 AS DOUBLE) + (l_extendedprice * 7 + l_partkey) * CAST(1e-13 AS DOUBLE) END AS score FROM lineitem),
        l AS (SELECT k AS class_id, CASE k WHEN 0 THEN 1 - score ELSE score END AS p, CAST(label = k AS INT) AS hit FROM s, (SELECT unnest([0, 1]) AS k))
        SELECT class_id, positives, negatives, round(auc, 9) AS auc FROM ({auc_sql("l")})""",
    "auc_ovr_macro": EMB + f"SELECT round(avg(auc), 9) AS auc_ovr_macro FROM ({auc_sql('(SELECT class_id, p, CAST(label = class_id AS INT) AS hit FROM p)')})",
    "curve_gap": """
        SELECT CAST(l_suppkey AS VARCHAR) AS run_id, l_linenumber AS step, max(l_extendedprice) FILTER (l_linestatus = 'O') AS train_value,
               max(l_extendedprice) FILTER (l_linestatus <> 'O') AS test_value,
               round(max(l_extendedprice) FILTER (l_linestatus <> 'O') - max(l_extendedprice) FILTER (l_linestatus = 'O'), 2) AS gap
        FROM lineitem GROUP BY 1, 2""",
    "trial_grid": GRID,
    "trial_shard": f"SELECT * FROM ({GRID}) WHERE trial >= 40 AND trial < 115",
    "shard_plan": "SELECT CAST(floor(c_custkey / ceil((SELECT count(*) FROM customer) / 7.0)) AS INT) AS shard, CAST(min(c_custkey) AS INT) AS trial_start, count(*) AS trial_count FROM customer GROUP BY 1",
    "trial_success": f"SELECT search_id, status, count(*) AS n FROM ({TRIALS}) GROUP BY 1, 2",
    "best_of_shard": f"SELECT search_id, shard, trial, auc, round(accuracy, 6) AS accuracy FROM ({TRIALS}) WHERE status = 'OK' QUALIFY row_number() OVER (PARTITION BY search_id, shard ORDER BY auc DESC, trial) = 1",
    "search_summary": f"""
        WITH t AS ({TRIALS}), b AS (SELECT * FROM t WHERE status = 'OK' QUALIFY row_number() OVER (PARTITION BY search_id ORDER BY auc DESC, trial) = 1)
        SELECT t.search_id, count(*) AS trials, count(*) FILTER (t.status = 'OK') AS succeeded, sum(t.train_seconds) AS train_seconds,
               any_value(b.auc) AS best_auc, round(any_value(b.accuracy), 6) AS best_accuracy
        FROM t JOIN b USING (search_id) GROUP BY 1""",
    "global_best": f"""
        SELECT search_id, auc, version, shards FROM (
          SELECT o_orderpriority AS search_id, CAST(o_orderkey AS INT) AS version, {_PRICE} AS auc, count(*) OVER (PARTITION BY o_orderpriority) AS shards FROM orders)
        QUALIFY row_number() OVER (PARTITION BY search_id ORDER BY auc DESC, version DESC) = 1""",
    "register_version": f"SELECT concat('shop.m', c_custkey) AS name, CAST(coalesce(version, 0) + 1 AS INT) AS version FROM customer LEFT JOIN ({LATEST}) l ON l.name = concat('shop.m', c_custkey)",
    "alias_current": ALIASES,
    "latest_version": LATEST,
    "serving_version": f"""
        SELECT concat('shop.m', c_custkey) AS name, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE '' END AS requested,
               CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS INT) ELSE version END AS version
        FROM customer LEFT JOIN ({LATEST}) l ON l.name = concat('shop.m', c_custkey)""",
    "resolve_uri": f"""
        WITH q AS (
          SELECT o_orderkey, o_orderkey % 4 AS kind,
                 concat('shop.m', CASE WHEN o_orderkey % 4 = 3 THEN o_custkey + 1 ELSE o_custkey END) AS name,
                 CASE o_orderkey % 4 WHEN 1 THEN 'candidate' WHEN 3 THEN 'champion' END AS alias FROM orders)
        SELECT o_orderkey, q.name, CASE WHEN kind = 0 THEN CAST(o_orderkey AS INT) ELSE coalesce(a.version, l.version) END AS version,
               CASE WHEN kind = 0 THEN 'version' WHEN a.version IS NOT NULL THEN 'alias' WHEN l.version IS NOT NULL THEN 'latest' ELSE 'missing' END AS found_by
        FROM q LEFT JOIN ({ALIASES}) a ON a.name = q.name AND a.alias = q.alias LEFT JOIN ({LATEST}) l ON l.name = q.name""",
    "child_runs": CHILDREN,
    "compare_trials": f"""
        WITH m AS (
          SELECT concat('o', l_orderkey) AS run_id, l_returnflag AS key, max({{'s': l_linenumber, 'v': l_extendedprice}}).v AS value
          FROM lineitem GROUP BY 1, 2)
        SELECT *, row_number() OVER (PARTITION BY parent_run_id ORDER BY "A" DESC NULLS LAST, run_name, run_id) AS rank FROM (
        SELECT c.parent_run_id, c.run_id, c.run_name, {", ".join(f"max(value) FILTER (key = '{k}') AS {chr(34)}{k}{chr(34)}" for k in "ANR")}
        FROM ({CHILDREN}) c LEFT JOIN m USING (run_id) GROUP BY 1, 2, 3)""",
    "batch_inference": f"""
        SELECT row_id, {_ARG3} AS predicted_class, round(greatest(p0, p1, p2), 6) AS predicted_probability, label AS true_label, 1 AS model_version
        FROM ({fixed_sql(f"SELECT * FROM ({split_sql(Y3_DOUBLE, 'row_id', 'label', '0.25', 11)}) WHERE split = 'test'")})""",
    "score_stream": f"SELECT row_id, {_ROUNDED} FROM ({FIXED})",
    "score_current": f"""
        WITH r AS (SELECT *, {_hash8("concat_ws(':', 42, row_id)")} % 100 < 70 AS champion FROM ({Y3_DOUBLE}))
        SELECT row_id, 2 AS model_version, {_ROUNDED} FROM ({fixed_sql("SELECT * FROM r WHERE champion", 1)})
        UNION ALL SELECT row_id, 1, {_ROUNDED} FROM ({fixed_sql("SELECT * FROM r WHERE NOT champion", 2)})""",
    "traffic_route": f"""
        SELECT event_id, CASE WHEN b < 80 THEN 'stable' WHEN b < 95 THEN 'canary' ELSE 'shadow' END AS served_model
        FROM (SELECT event_id, {_hash8("concat_ws(':', 42, user_id)")} % 100 AS b FROM events)""",
    "parse_request": REQUESTS,
    "rejected_requests": "SELECT event_id AS request_id, 'malformed request' AS reason FROM events WHERE event_id % 10 IN (3, 7)",
    "request_response": f"SELECT request_id, pos, {_ARG3} AS predicted_class, round(greatest(p0, p1, p2), 6) AS predicted_probability FROM ({fixed_sql(REQUESTS)})",
    "daily_quality": """
        SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n,
               round(avg(CAST((event_type = 'click') = (value > 10) AS INT)), 6) AS accuracy FROM events GROUP BY 1""",
}

# Odd inputs ---------------------------------------------------------------------

_STATUS = "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS o_orderstatus FROM orders"
_WIDE_VALUE = """
CASE WHEN l_suppkey % 10 = 0 THEN CAST('inf' AS DOUBLE) WHEN l_suppkey % 10 = 1 THEN CAST('-inf' AS DOUBLE)
     ELSE l_extendedprice * pow(2.0::DOUBLE, (l_partkey % 200 - 100)::DOUBLE) END"""
_HALF = f"""
SELECT * REPLACE (CASE WHEN CAST(split_part(row_id, ':', 2) AS INT) % 2 = 1 THEN label END AS label) FROM ({Y3_DOUBLE})"""
_OLD = f"SELECT * FROM ({Y3}) WHERE CAST(split_part(row_id, ':', 1) AS BIGINT) % 10 <> 0"
_RANK = "md5(concat_ws(':', '42', row_id))"
_STUMP = " ".join(
    f"0.0078125 * (2 * len(list_filter(t{k}, lambda t: t <= CAST(f1 AS DOUBLE))) - len(t{k})) AS m{k}," for k in range(3)
)

ORACLES |= {
    "split_null_labels": f"""
        SELECT o_orderkey, split FROM ({split_sql(f"SELECT * FROM ({_STATUS}) WHERE o_orderstatus IS NOT NULL", "o_orderkey", "o_orderstatus")})
        UNION ALL SELECT o_orderkey, 'unlabelled' FROM ({_STATUS}) WHERE o_orderstatus IS NULL""",
    "split_crowded": ORACLES["stratified_split"],
    "quantile_edges_wide": f"""
        WITH v AS (SELECT {_WIDE_VALUE} AS v, l_linenumber FROM lineitem),
        vals AS (SELECT 0 AS feature, v FROM v UNION ALL SELECT 1, CASE WHEN l_linenumber % 2 = 0 THEN v ELSE -v END FROM v),
        ranked AS (
          SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) AS rk,
                 count(*) OVER (PARTITION BY feature) AS n, min(v) OVER (PARTITION BY feature) AS lo FROM vals),
        cuts AS (
          SELECT DISTINCT feature, v FROM ranked JOIN range(1, {BINS}) j(j) ON rk = (j.j * n + {BINS - 1}) // {BINS}
          WHERE v > lo)
        SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY v) AS INT) AS bin,
               CASE WHEN NOT isinf(v) THEN v END AS upper, CAST(CASE WHEN isinf(v) THEN sign(v) ELSE 0 END AS INT) AS infinite
        FROM cuts""",
    "score_large_model": f"""
        WITH t AS (SELECT {", ".join(f"list(p_retailprice * 20) FILTER (p_partkey % 3 = {k}) AS t{k}" for k in range(3))} FROM part),
        m AS (SELECT row_id, {_STUMP} FROM ({Y3}) CROSS JOIN t),
        e AS (SELECT row_id, exp(m0) AS e0, exp(m1) AS e1, exp(m2) AS e2 FROM m)
        SELECT row_id, {", ".join(f"round(e{k} / (e0 + e1 + e2), 6) AS p{k}" for k in range(3))} FROM e""",
    "reregister_scores": ORACLES["score_fixed_model"],
    "batch_inference_unlabelled": f"""
        SELECT row_id, {_ARG3} AS predicted_class, label AS true_label FROM ({fixed_sql(f"""
          SELECT * EXCLUDE (split) FROM ({split_sql(f"SELECT * FROM ({_HALF}) WHERE label IS NOT NULL", 'row_id', 'label', '0.25', 11)}) WHERE split = 'test'
          UNION ALL SELECT * FROM ({_HALF}) WHERE label IS NULL""")})""",
    "grown_table": f"""
        WITH old AS ({split_sql(_OLD, "row_id", "label")}),
        cut AS (SELECT label, max({_RANK}) FILTER (split = 'test') AS cut FROM old GROUP BY label)
        SELECT count(*) AS n, count(*) AS labelled, 0 AS trained_rows_scored
        FROM ({Y3}) JOIN cut USING (label) WHERE {_RANK} <= cut""",
    "stream_rejects": """
        SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS row_id,
               CASE WHEN l_linenumber % 3 = 0 THEN 'scored' ELSE concat('expected 4 features, got ', 4 - l_linenumber % 3) END AS reason
        FROM lineitem""",
    "request_edge_cases": """
        SELECT event_id AS request_id, CAST(NULL AS INT) AS pos, CASE event_id % 5 WHEN 0 THEN 'no inputs' ELSE 'malformed request' END AS outcome
        FROM events WHERE event_id % 5 IN (0, 3)
        UNION ALL SELECT event_id, 0, CASE event_id % 5 WHEN 1 THEN 'expected 4 features, got 3' WHEN 2 THEN 'no features' ELSE 'answered' END
        FROM events WHERE event_id % 5 IN (1, 2, 4)
        UNION ALL SELECT event_id, 1, 'answered' FROM events WHERE event_id % 5 = 2""",
}

# Whole trainings -----------------------------------------------------------------


def _tree_features(round_no: int, tree: int, ratio: float = 0.8, seed: int = 42) -> str:
    order = sorted(range(4), key=lambda f: hashlib.md5(f"{seed}:{round_no}:{tree}:{f}".encode()).hexdigest())
    return ", ".join(map(str, sorted(order[: int(ratio * 4)])))


def boost_sql(rounds: int, depth: int, rate: float, ratio: float = 0.8, seed: int = 42) -> str:
    """A training with row and feature samples: ``m0`` ... hold the margins of every row after each
    round, as plain steps: derivatives, histogram, best split and routing of each level, leaves."""
    top = "greatest(m0, m1, m2)"
    out = [
        f"""{BINNED},
        st0 AS MATERIALIZED (
          SELECT row_id, split, label, [b0, b1, b2, b3] AS bins, {_hash8("row_id")} % {_P} AS hash,
                 0.0::DOUBLE AS m0, 0.0::DOUBLE AS m1, 0.0::DOUBLE AS m2 FROM binned)"""
    ]
    for r in range(rounds):
        digest = hashlib.md5(f"{seed}:{r}".encode()).hexdigest()
        a, b = max(1, int(digest[:7], 16)), int(digest[7:14], 16)
        used = " WHEN ".join(f"{k} THEN [{_tree_features(r, k, ratio, seed)}]" for k in range(3))
        out.append(f"""
        e{r} AS (SELECT *, exp(m0 - {top}) AS e0, exp(m1 - {top}) AS e1, exp(m2 - {top}) AS e2 FROM st{r}),
        t{r}_0 AS MATERIALIZED (
          SELECT row_id, split, label, bins, tree, 0 AS node, CASE tree WHEN {used} END AS used,
                 split = 'train' AND (hash * {a} + {b}) % {_P} < {int(ratio * _P)} AS sampled,
                 CAST(round_even((p - CASE WHEN label = tree THEN 1 ELSE 0 END) * {_BIG}, 0) AS BIGINT) AS g,
                 CAST(round_even(p * (1 - p) * {_BIG}, 0) AS BIGINT) AS h
          FROM (SELECT *, unnest([0, 1, 2]) AS tree, unnest([e0, e1, e2]) / (e0 + e1 + e2) AS p FROM e{r}))""")
        for lv in range(depth):
            out.append(f"""
            c{r}_{lv} AS (
              SELECT tree, node, feature, bin, CAST(sum(g) AS BIGINT) AS g, CAST(sum(h) AS BIGINT) AS h
              FROM (SELECT tree, node, g, h, unnest(used) AS feature, unnest(list_transform(used, lambda f: bins[f + 1])) AS bin
                    FROM t{r}_{lv} WHERE sampled AND node >= {2 ** lv - 1}) GROUP BY ALL),
            s{r}_{lv} AS MATERIALIZED ({best_sql(gains_sql(f"c{r}_{lv}", float(_BIG)))}),
            t{r}_{lv + 1} AS MATERIALIZED (
              SELECT t.* REPLACE (CASE WHEN s.tree IS NULL THEN t.node WHEN t.bins[s.feature + 1] <= s.bin THEN 2 * t.node + 1
                                  ELSE 2 * t.node + 2 END AS node)
              FROM t{r}_{lv} t LEFT JOIN s{r}_{lv} s ON t.tree = s.tree AND t.node = s.node)""")
        splits = " UNION ALL ".join(f"SELECT tree, node, gl, hl, gr, hr FROM s{r}_{lv}" for lv in range(depth))
        out.append(f"""
        v{r} AS (
          SELECT tree, node, -g * {rate!r}::DOUBLE / (h + 1) AS v
          FROM (SELECT tree, 2 * node + 1 AS node, gl AS g, hl AS h FROM ({splits})
                UNION ALL SELECT tree, 2 * node + 2, gr, hr FROM ({splits}))),
        st{r + 1} AS MATERIALIZED (
          SELECT s.* REPLACE (m0 + v0 AS m0, m1 + v1 AS m1, m2 + v2 AS m2)
          FROM st{r} s JOIN (
            SELECT row_id, {", ".join(f"max(v) FILTER (t.tree = {k}) AS v{k}" for k in range(3))}
            FROM t{r}_{depth} t JOIN v{r} v ON t.tree = v.tree AND t.node = v.node GROUP BY row_id) USING (row_id))""")
    return ",".join(out)


_LOSS = "ln(exp(m0 - {t}) + exp(m1 - {t}) + exp(m2 - {t})) + {t} - [m0, m1, m2][label + 1]".format(t="greatest(m0, m1, m2)")
_ARGM = "CASE WHEN m0 >= m1 AND m0 >= m2 THEN 0 WHEN m1 >= m2 THEN 1 ELSE 2 END"

ORACLES |= {
    "train_predict": boost_sql(5, 3, 0.3) + f"""
        SELECT row_id, {_ARGM} AS predicted_class, label AS true_label,
               round(1 / (exp(m0 - t) + exp(m1 - t) + exp(m2 - t)), 6) AS predicted_probability
        FROM (SELECT *, greatest(m0, m1, m2) AS t FROM st5) WHERE split = 'test'""",
    "train_curve": boost_sql(3, 3, 0.3) + " UNION ALL ".join(
        f"""
        SELECT 'y3' AS model_id, {r} AS step, round(avg({_LOSS}) FILTER (split = 'train'), 6) AS train_mlogloss,
               round(avg({_LOSS}) FILTER (split = 'test'), 6) AS test_mlogloss FROM st{r + 1}"""
        for r in range(3)
    ),
}
