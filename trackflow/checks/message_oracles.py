"""Expected results of the message queries, computed from the event columns."""

from __future__ import annotations

from trackflow.checks.message_queries import SMALL_BLOCK, SMALL_LIMIT
from trackflow.functions.text import PROLOG

_PAYLOAD = f"""
  CASE event_type
    WHEN 'signup' THEN '{{"filePath":"u' || user_id || '","mark":"START"}}'
    WHEN 'purchase' THEN '{{"filePath":"u' || user_id || '","mark":"END","lineCount":0}}'
    WHEN 'error' THEN '{PROLOG}'
    WHEN 'click' THEN '<c id="' || event_id || '"/>'
    ELSE '<v>' || CAST(value AS DECIMAL(10,2)) || '</v>'
  END"""

_JUNK = """CASE WHEN event_type IN ('click', 'view') AND event_id % 7 = 0 THEN ',"' ELSE '' END"""

_PAD = "CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE chr(9) END"

# Lines that survive prolog and envelope, their sessions and the first END of each session.
_FRAMES = f"""
WITH lines AS (
  SELECT user_id AS channel, event_id AS "offset", {_PAYLOAD} AS clean,
    {_JUNK} || {_PAYLOAD} AS line,
    CASE event_type WHEN 'signup' THEN 'START' WHEN 'purchase' THEN 'END' END AS marker
  FROM events WHERE event_type <> 'error' AND event_id % 97 <> 0),
started AS (
  SELECT *, max(CASE WHEN marker = 'START' THEN "offset" END) OVER (
    PARTITION BY channel ORDER BY "offset" ROWS UNBOUNDED PRECEDING) AS start_offset
  FROM lines),
ends AS (
  SELECT channel, start_offset, min("offset") AS end_offset
  FROM started WHERE marker = 'END' GROUP BY channel, start_offset),
framed AS (
  SELECT s.*, e.end_offset, coalesce(s."offset" > e.end_offset, false) AS closed,
    coalesce(md5(s.channel || ':' || s.start_offset), 'null') AS session_id,
    CASE WHEN marker = 'START' THEN 'start' WHEN s.start_offset IS NULL THEN 'orphan'
      WHEN s."offset" > e.end_offset THEN 'trailing' WHEN marker = 'END' THEN 'end'
      ELSE 'content' END AS phase
  FROM started s LEFT JOIN ends e
    ON s.channel = e.channel AND s.start_offset IS NOT DISTINCT FROM e.start_offset),
status AS (
  SELECT channel, session_id, start_offset, end_offset, end_offset IS NOT NULL AS is_complete,
    count(*) FILTER (marker IS NULL AND NOT closed) AS n_lines
  FROM framed GROUP BY ALL),
documents_all AS (
  SELECT channel, session_id, start_offset, end_offset,
    count(*) FILTER (marker IS NULL) AS n_lines,
    coalesce(sum(strlen(line)) FILTER (marker IS NULL), 0) AS n_bytes,
    coalesce(string_agg(clean, '' ORDER BY "offset") FILTER (marker IS NULL), '') AS xml,
    coalesce(string_agg(clean, chr(10) ORDER BY "offset") FILTER (marker IS NULL), '')
      AS xml_lines
  FROM framed WHERE end_offset IS NOT NULL AND NOT closed
  GROUP BY channel, session_id, start_offset, end_offset)
"""

_FRAMED = f"""{_FRAMES}
SELECT channel, "offset", session_id, start_offset, phase, closed FROM framed"""

_DOCUMENT_COLUMNS = "channel, session_id, start_offset, end_offset, n_lines"

_DOCUMENTS = f"""{_FRAMES}
SELECT {_DOCUMENT_COLUMNS}, xml FROM documents_all WHERE start_offset IS NOT NULL"""

_MARKED = """
SELECT user_id AS channel, event_id AS "offset",
  CASE event_type WHEN 'signup' THEN 'START' WHEN 'purchase' THEN 'END' END AS marker
FROM events WHERE event_type <> 'error' AND event_id % 97 <> 0"""


def spread_columns(source: str, names: list[str], keep: str) -> str:
    """Bit spreading of 16-bit columns by shift and mask, one step per sub-query."""
    for shift, mask in [
        (16, 0xFF0000FF),
        (8, 0xF00F00F00F),
        (4, 0xC30C30C30C3),
        (2, 0x249249249249),
    ]:
        steps = ", ".join(f"({n} | ({n} << {shift})) & {mask} AS {n}" for n in names)
        source = f"(SELECT {keep}, {steps} FROM {source})"
    return source


def morton_cells(lon: str, lat: str, ts: str) -> str:
    """Cell columns x, y, t of a place and a time."""
    year_start = f"make_timestamp(year({ts}), 1, 1, 0, 0, 0)"
    next_year = f"make_timestamp(year({ts}) + 1, 1, 1, 0, 0, 0)"
    seconds = f"((epoch_us({ts}) - epoch_us({year_start})) // 1000000)"
    length = f"((epoch_us({next_year}) - epoch_us({year_start})) // 1000000)"
    return (
        f"least(CAST(floor(({lon} + 180.0) / 360.0 * 65536) AS BIGINT), 65535) AS x,"
        f" least(CAST(floor(({lat} + 90.0) / 180.0 * 65536) AS BIGINT), 65535) AS y,"
        f" CAST({seconds} * 65536 // {length} AS BIGINT) AS t"
    )


_SQL_FUNCTIONS = f"""
SELECT channel, "offset", marker, clean, x | (y << 1) | (t << 2) AS st_key
FROM {spread_columns(f'''(
  SELECT user_id AS channel, event_id AS "offset",
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'signup' THEN 'START'
      WHEN event_type = 'purchase' THEN 'END' END AS marker,
    CASE WHEN event_id % 97 <> 0 THEN {_PAYLOAD} END AS clean,
    {morton_cells("CAST(user_id % 360 - 180 AS DOUBLE)",
                  "CAST(event_id % 180 - 90 AS DOUBLE)", "ts")}
  FROM events)''', ["x", "y", "t"], 'channel, "offset", marker, clean')}"""

_VALUE = f"""
  'contentType' || CASE WHEN event_id % 97 = 0 THEN '' ELSE '"text/plain"' END
  || {_PAD} || {_JUNK} || {_PAYLOAD} || {_PAD}"""

ORACLES = {
    "decode_raw": f"""
SELECT user_id AS channel, event_id AS "offset", {_VALUE} AS value FROM events""",
    "raw_entries": f"""
SELECT md5(user_id || ':' || event_id) AS entry_id, {_VALUE} AS entry_data FROM events""",
    "drop_prolog": """
SELECT user_id AS channel, event_id AS "offset" FROM events WHERE event_type <> 'error'""",
    "strip_envelope": f"""
SELECT user_id AS channel, event_id AS "offset",
  CASE WHEN event_id % 97 <> 0 THEN {_JUNK} || {_PAYLOAD} END AS line,
  CASE WHEN event_id % 97 = 0 THEN 'no_envelope' END AS reject_reason
FROM events WHERE event_type <> 'error'""",
    "envelope_rejects": """
SELECT user_id AS channel, event_id AS "offset", 'no_envelope' AS reject_reason
FROM events WHERE event_type <> 'error' AND event_id % 97 = 0""",
    "mark_lines": _MARKED,
    "clean_lines": f"""
SELECT user_id AS channel, event_id AS "offset", {_PAYLOAD} AS clean,
  CAST(strlen({_JUNK} || {_PAYLOAD}) AS BIGINT) AS line_bytes
FROM events WHERE event_type IN ('click', 'view') AND event_id % 97 <> 0""",
    "assign_sessions": _FRAMED,
    "assign_sessions_blocked": _FRAMED,
    "line_table": f"""{_FRAMES}
SELECT channel, "offset", session_id AS id, line AS xml FROM framed""",
    "session_status": f"""{_FRAMES}
SELECT channel, session_id, is_complete, start_offset, end_offset, n_lines FROM status""",
    "completed_sessions": f"""{_FRAMES}
SELECT channel, session_id, is_complete, start_offset, end_offset, n_lines FROM status
WHERE is_complete AND start_offset IS NOT NULL""",
    "unclosed_sessions": f"""{_FRAMES}
SELECT channel, session_id, is_complete, start_offset, end_offset, n_lines FROM status
WHERE NOT is_complete AND start_offset IS NOT NULL""",
    "apply_status": f"""{_FRAMES}
SELECT channel, session_id, arg_max(marker = 'END', "offset") AS value, max("offset") AS seq
FROM framed WHERE marker IS NOT NULL AND start_offset IS NOT NULL
GROUP BY channel, session_id HAVING arg_max(phase, "offset") <> 'trailing'""",
    "session_lines_for": f"""{_FRAMES}
SELECT f.channel, f.session_id, f."offset" FROM framed f
JOIN status s ON f.channel = s.channel AND f.session_id = s.session_id
WHERE s.is_complete AND s.start_offset IS NOT NULL AND s.n_lines >= 3""",
    "content_lines": f"""{_FRAMES}
SELECT channel, session_id, "offset" FROM framed WHERE marker IS NULL""",
    "count_lines": f"""{_FRAMES}
SELECT channel, session_id, count(*) AS n_lines FROM framed WHERE marker IS NULL
GROUP BY channel, session_id""",
    "assemble": _DOCUMENTS,
    "assemble_orphans": f"""{_FRAMES}
SELECT {_DOCUMENT_COLUMNS}, xml_lines AS xml FROM documents_all""",
    "assemble_limited": f"{_DOCUMENTS} AND n_bytes <= {SMALL_LIMIT}",
    "oversize_lines": f"""{_FRAMES}
SELECT f.channel, f.session_id, f.start_offset, f."offset", f.clean AS text
FROM framed f JOIN documents_all d ON f.channel = d.channel AND f.session_id = d.session_id
WHERE d.start_offset IS NOT NULL AND d.n_bytes > {SMALL_LIMIT}
  AND f.marker IS NULL AND NOT f.closed""",
    "document_parts": f"""{_FRAMES}
SELECT channel, session_id, start_offset,
  "offset" // {SMALL_BLOCK} - coalesce(start_offset // {SMALL_BLOCK}, 0) AS part,
  count(*) AS n_lines, string_agg(clean, chr(10) ORDER BY "offset") AS text
FROM framed WHERE marker IS NULL AND NOT closed AND end_offset IS NOT NULL
GROUP BY channel, session_id, start_offset, "offset" // {SMALL_BLOCK}""",
    "document_stats": f"""{_FRAMES}
SELECT {_DOCUMENT_COLUMNS}, CAST(length(xml) AS INTEGER) AS n_chars_in,
  CAST(length(xml) AS INTEGER) AS n_chars_out
FROM documents_all WHERE start_offset IS NOT NULL""",
    "reassemble_text": r"""
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines,
  array_to_string(list_transform(string_split(text, chr(10)),
    lambda x: regexp_replace(x, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')), '') AS text
FROM documents""",
    "frame_stream": _DOCUMENTS,
    "stream_lines": f"""{_FRAMES}
SELECT channel, "offset", session_id AS id, line AS xml FROM framed""",
    "stream_documents": _DOCUMENTS,
    "stream_unclosed": f"""{_FRAMES}
SELECT s.channel, s.session_id, s.start_offset FROM status s
WHERE NOT s.is_complete AND s.start_offset IS NOT NULL AND EXISTS (
  SELECT 1 FROM status n WHERE n.channel = s.channel AND n.start_offset > s.start_offset)""",
    "stream_stateful": f"""{_FRAMES}
SELECT channel, 'document' AS kind, start_offset, end_offset, n_lines, xml
FROM documents_all WHERE start_offset IS NOT NULL
UNION ALL SELECT channel, 'outside' AS kind, NULL AS start_offset, "offset" AS end_offset,
  CAST(1 AS BIGINT) AS n_lines, clean AS xml
FROM framed WHERE phase IN ('orphan', 'trailing') AND marker IS NULL""",
    "stream_table": _MARKED,
    "sql_functions": _SQL_FUNCTIONS,
    "sql_views": f"""{_FRAMES}
SELECT f.channel, f.session_id, count(*) AS n_lines, max(f."offset") AS last_offset
FROM framed f JOIN status s ON f.channel = s.channel AND f.session_id = s.session_id
WHERE s.is_complete AND f.marker IS NULL GROUP BY f.channel, f.session_id""",
}
