"""SQL with the rows of the queries on pairs, lines and vectors."""

from __future__ import annotations

_SPACE = r"\x20\x09-\x0D"


def _lowered(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(key: str) -> str:
    """CTEs over ``links(a, b)``, both ways: ``least``, the smallest key that each one reaches."""
    return f"""
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS {key}, min(b) AS lowest FROM reach GROUP BY a)"""


_VECTORS = """
vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

NEAR_VECTORS = f"""
WITH RECURSIVE {_VECTORS},
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_dot_product(x.v, x.v) > 0 AND list_dot_product(y.v, y.v) > 0
    AND list_cosine_similarity(x.v, y.v) >= 0.98),
{_components("vec_id")},
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links,
  least(e.vec_id, coalesce(l.lowest, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(l.lowest, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counted c USING (vec_id) LEFT JOIN least l USING (vec_id)"""

TOP_K = f"""
WITH {_VECTORS},
cells AS (
  SELECT vec_id, list_transform(v, lambda x: CAST(floor(1024 * x) AS DOUBLE)) AS v FROM vectors),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM cells q JOIN cells c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
  FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10"""

LINES = rf"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM cut),
keyed AS (
  SELECT *, {_lowered(f"regexp_replace(line, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')")} AS key
  FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (
  SELECT k.*, coalesce(k.doc_id <> r.first, false) AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

SHINGLES = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_lowered("text")}, '[^{_SPACE}]+') AS words FROM documents),
sets AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1),
      lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END)) AS shingle
  FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
met AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM met JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 90 * (p.n + q.n - shared)),
{_components("doc_id")}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles,
  least(d.doc_id, coalesce(l.lowest, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l USING (doc_id)"""
