"""SQL for the manifest: every level a step, one row a node; and the check sum of a text."""

from __future__ import annotations

LEAF_LEVELS = 13  # 3 ** 13 = 1,594,323 documents a source
SOURCE_LEVELS = 8

_FIELDS = ("doc_id", "source", "lang", "n_chars")


def crc32_of(value: str) -> str:
    """The unsigned CRC-32 of a text of ASCII characters."""
    codes = (
        f"list_transform(range(1, length({value}) + 1), "
        f"lambda i: CAST(ascii(substr({value}, i, 1)) AS BIGINT))"
    )
    byte = "lambda c, b: list_reduce(range(8), lambda t, j: xor(t >> 1, 3988292384 * (t & 1)), "
    full = "CAST(4294967295 AS BIGINT)"
    return f"xor(list_reduce({codes}, {byte}xor(c, b)), {full}), 4294967295)"


def _leaf(text: str) -> str:
    parts = [f"CAST({name} AS VARCHAR)" for name in _FIELDS] + [text]
    return "sha256(" + " || ".join(
        f"coalesce(strlen({part}) || ':' || {part}, '-')" for part in parts
    ) + ")"


def _levels(name: str, lowest: str, count: int) -> str:
    """CTEs ``{name}0`` to ``{name}{count}``: ``tree, place, n, hash``; n nodes at that level."""
    steps = [f"{name}0 AS ({lowest})"]
    for i in range(count):
        steps.append(
            f"""{name}{i}r AS (SELECT tree, place // 3 AS run, max(n) AS n,
  string_agg(hash, '' ORDER BY place) AS text FROM {name}{i} GROUP BY tree, place // 3),
{name}{i + 1} AS (SELECT tree, run AS place, (n + 2) // 3 AS n,
  CASE WHEN n > 1 THEN sha256(text) ELSE text END AS hash FROM {name}{i}r)"""
        )
    return ",\n".join(steps)


def _walk(name: str, rows: str, levels: str, place: str, tree: str, count: int) -> str:
    """CTEs that lead rows up a tree: ``proof`` and ``folded`` grow where a level has siblings."""
    steps = [f"{name}0 AS (SELECT *, {place} AS up FROM {rows})"]
    for i in range(count):
        left = "substr(r.text, 1, (w.up % 3) * 64)"
        right = "substr(r.text, (w.up % 3) * 64 + 65)"
        steps.append(
            f"""{name}{i + 1} AS (SELECT w.* REPLACE (w.up // 3 AS up,
  CASE WHEN r.n > 1 THEN w.proof || {left} || {right} ELSE w.proof END AS proof,
  CASE WHEN r.n > 1 THEN sha256({left} || w.folded || {right}) ELSE w.folded END AS folded)
  FROM {name}{i} w JOIN {levels}{i}r r ON r.tree = w.{tree} AND r.run = w.up // 3)"""
        )
    return ",\n".join(steps)


def manifest_sql(altered: str) -> str:
    """The rows of the manifest query; ``altered`` is the text as met later, in SQL."""
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
    {_leaf(altered)} AS folded
  FROM documents),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY tree) AS n, '' AS proof
  FROM leaves),
{_levels("l", "SELECT tree, place, n, leaf AS hash FROM numbered", LEAF_LEVELS)},
tops AS (
  SELECT tree AS source, hash AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place,
    count(*) OVER () AS n, '' AS tree
  FROM l{LEAF_LEVELS}),
{_levels("s", "SELECT tree, place, n, subroot AS hash FROM tops", SOURCE_LEVELS)},
{_walk("w", "numbered", "l", "place", "tree", LEAF_LEVELS)},
met AS (
  SELECT w.*, t.subroot, t.place AS source_place, '' AS whole
  FROM w{LEAF_LEVELS} w JOIN tops t ON t.source = w.tree),
{_walk("v", "(SELECT * EXCLUDE (up) FROM met)", "s", "source_place", "whole", SOURCE_LEVELS)}
SELECT v.doc_id, v.leaf, v.subroot, r.hash AS root, sha256(v.proof) AS proof_sha256,
  v.folded AS folded_root, v.folded = r.hash AS verified
FROM v{SOURCE_LEVELS} v, s{SOURCE_LEVELS} r
"""
