"""SQL counterparts of the manifest and the mixing."""

from __future__ import annotations

from .merkle import FANOUT, FIELDS
from .mixing import REPEATS, TOLERANCE, WEIGHTS, WORD

# Levels that the SQL unrolls; a level of one node changes nothing, so more than needed do no harm.
_LEVELS = 6


def _encoded(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(columns: list[str]) -> str:
    return "sha256(" + " || ".join(_encoded(c) for c in columns) + ")"


# Checksum of a text: the table of the polynomial, then one step for each byte.
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))))"
_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))), "
    "lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])), 4294967295)"
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _tree(name: str, base: str) -> str:
    """CTEs ``name0`` ... of the nodes (g, pos, node, cnt) of each level, from ``base``, with those of their runs."""
    out = [f"{name}0 AS (SELECT g, pos, node, count(*) OVER (PARTITION BY g) AS cnt FROM {base})"]
    for k in range(_LEVELS):
        out.append(
            f"{name}{k}r AS (SELECT g, pos // {FANOUT} AS run, cnt, list(node ORDER BY pos) AS nodes FROM {name}{k} GROUP BY g, pos // {FANOUT}, cnt)"
        )
        out.append(
            f"{name}{k + 1} AS (SELECT g, run AS pos, CASE WHEN cnt = 1 THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END AS node, "
            f"count(*) OVER (PARTITION BY g) AS cnt FROM {name}{k}r)"
        )
    return ",\n".join(out)


def _climb(name: str, base: str, tree: str) -> str:
    """CTEs that take each document of ``base`` up a tree: its digest folded with its siblings, and these."""
    out, last = [], base
    for k in range(_LEVELS):
        around = f"nodes[:pos % {FANOUT}], {{}}nodes[pos % {FANOUT} + 2:]"
        joined = f"list_concat({around.format('[folded], ')})"
        out.append(
            f"{name}{k} AS (SELECT d.* EXCLUDE (pos, folded, proof), pos // {FANOUT} AS pos, "
            f"CASE WHEN r.cnt = 1 THEN folded ELSE sha256(array_to_string({joined}, '')) END AS folded, "
            f"CASE WHEN r.cnt = 1 THEN proof ELSE proof || array_to_string(list_concat({around.format('')}), '') END AS proof "
            f"FROM {last} d JOIN {tree}{k}r r ON r.g = d.g AND r.run = d.pos // {FANOUT})"
        )
        last = f"{name}{k}"
    return ",\n".join(out)


MERKLE_SQL = f"""
WITH c AS (SELECT {_CRC_TABLE} AS crc),
l AS (SELECT doc_id, source, {_leaf(list(FIELDS))} AS leaf, CASE WHEN {_CRC32} % 5 = 0
        THEN {_leaf([*FIELDS[:-1], f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"])} END AS altered FROM documents, c),
d AS (SELECT doc_id, leaf, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        coalesce(altered, leaf) AS folded, '' AS proof FROM l),
{_tree("a", "(SELECT g, pos, leaf AS node FROM d)")},
{_tree("b", f"(SELECT 0 AS g, g - 1 AS pos, node FROM a{_LEVELS})")},
{_climb("u", "d", "a")},
s AS (SELECT u.* EXCLUDE (g, pos), t.node AS subroot, 0 AS g, u.g - 1 AS pos FROM u{_LEVELS - 1} u JOIN a{_LEVELS} t USING (g)),
{_climb("v", "s", "b")}
SELECT doc_id, leaf, subroot, t.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.node AS verified
FROM v{_LEVELS - 1} JOIN b{_LEVELS} t USING (g)
"""

_WEIGHT = f"[{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]"

MIX_SQL = f"""
WITH RECURSIVE
d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
        md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '-')) AS key FROM documents),
z AS (SELECT source, CAST(sum(size) AS BIGINT) AS total FROM d GROUP BY source),
w AS (SELECT *, {_WEIGHT} AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS src FROM z),
o AS (SELECT *, row_number() OVER (ORDER BY total * {6 * REPEATS} // weight, src) AS nth FROM w),
p AS (SELECT *, sum(total) OVER () - coalesce({REPEATS} * sum(total) OVER before, 0) AS open_words,
        sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight FROM o
      WINDOW before AS (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min(nth) AS nth FROM p WHERE {REPEATS} * total * open_weight >= weight * open_words),
t AS (SELECT source, src, total,
        CASE WHEN p.nth < f.nth THEN CAST({REPEATS} * total AS DOUBLE) ELSE CAST(weight * x.open_words AS DOUBLE) / CAST(x.open_weight AS DOUBLE) END AS target,
        CAST(CASE WHEN p.nth < f.nth THEN {REPEATS} * total ELSE weight * x.open_words // x.open_weight END AS BIGINT) AS budget
      FROM p, f, (SELECT p.open_words, p.open_weight FROM p JOIN f USING (nth)) x),
r AS (SELECT d.*, t.src, t.total, t.target, t.budget, row_number() OVER (PARTITION BY t.src ORDER BY key) AS nth
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT src, 0 AS nth, CASE WHEN total = 0 THEN 0 ELSE budget % total END AS open_words, CAST(4611686018427387904 AS BIGINT) AS most,
        total = 0 OR budget % total = 0 AS done, false AS taken, budget FROM t
      UNION ALL
      SELECT k.src, r.nth,
        CASE WHEN NOT done AND size <= open_words THEN open_words - size ELSE open_words END,
        CASE WHEN NOT done AND size > open_words AND size <= most THEN open_words ELSE most END,
        done OR (size > open_words AND size <= most AND open_words <= k.budget * CAST({TOLERANCE} AS DOUBLE)),
        NOT done AND size <= open_words, k.budget
      FROM k JOIN r ON r.src = k.src AND r.nth = k.nth + 1)
SELECT doc_id, size, total AS source_size, target,
  CAST(size * ((CASE WHEN total = 0 THEN 0 ELSE r.budget // total END) + CASE WHEN k.taken THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r JOIN k USING (src, nth)
"""
