"""Expected results of the track queries, computed from the order and line item columns."""

from __future__ import annotations

from trackflow.checks.message_oracles import morton_cells, spread_columns
from trackflow.checks.track_queries import BOX
from trackflow.sources.adapters import RICH

# Items of all orders that have any, numbered as in the messages; kept_idx leaves out videos.
_ITEMS = """
WITH items AS (
  SELECT l.*, o.*, 'm' || o_orderkey AS message_id, o_orderkey % 101 = 0 AS broken,
    row_number() OVER message AS item_no,
    CASE WHEN l_returnflag <> 'R' THEN 'TrackPoint' WHEN l_linestatus = 'F'
      THEN 'VideoInformation' ELSE 'TrackObject' END AS kind,
    CAST(l_discount AS DECIMAL(10,2)) = 0.10 AS no_course,
    CAST(CAST((l_partkey % 3600) / 10 - 180 AS DECIMAL(6,1)) AS VARCHAR) AS lon,
    CAST(CAST((l_suppkey % 1800) / 10 - 90 AS DECIMAL(6,1)) AS VARCHAR) AS lat,
    CAST(l_linenumber AS VARCHAR) AS elev,
    CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR) AS speed,
    CAST((l_partkey * 7) % 360 AS VARCHAR) AS course,
    CASE WHEN l_partkey % 2 = 0 THEN 'AUTOMATIC_ESTIMATED' ELSE 'MANUAL' END AS source
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
  WINDOW message AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_shipdate)),
messages AS (
  SELECT message_id, o_orderkey, o_custkey, o_orderdate, broken, count(*) AS n_items,
    bool_or(kind = 'TrackPoint' AND no_course) AS lacks_course,
    count(*) FILTER (kind = 'TrackPoint' AND source <> 'MANUAL') AS n_tokens
  FROM items GROUP BY ALL),
kept AS (
  SELECT i.*, 'p' || l_orderkey || '-' || item_no AS uuid,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS item_time,
    row_number() OVER (PARTITION BY i.message_id ORDER BY item_no) - 1 AS kept_idx
  FROM items i JOIN messages m ON i.message_id = m.message_id
  WHERE NOT m.broken AND NOT m.lacks_course AND kind <> 'VideoInformation'),
points AS (SELECT * FROM kept WHERE kind = 'TrackPoint'),
typed AS (
  SELECT message_id, uuid AS item_uuid, l_shipdate AS "time", CAST(lon AS DOUBLE) AS lon,
    CAST(lat AS DOUBLE) AS lat, CAST(elev AS DOUBLE) AS elev, CAST(speed AS DOUBLE) AS speed,
    CAST(course AS DOUBLE) AS course, source, l_returnflag = 'A' AS position_is_origin,
    kept_idx AS item_idx, 't' || l_orderkey AS track_uuid
  FROM points)
"""

_TYPED = 'message_id, item_uuid, "time", lon, lat, elev, speed, course, source, position_is_origin'

_KEYED = f"""(SELECT *, year("time") AS time_bin, x | (y << 1) | (t << 2) AS st_key
FROM {spread_columns(f'(SELECT *, {morton_cells("lon", "lat", chr(34) + "time" + chr(34))} FROM typed)',
                     ["x", "y", "t"], "* EXCLUDE (x, y, t)")})"""

_SUMMARY = """
summaries AS (
  SELECT m.message_id, m.o_custkey, count(k.kind) AS n_items
  FROM messages m LEFT JOIN kept k ON m.message_id = k.message_id
  WHERE NOT m.broken AND NOT m.lacks_course GROUP BY m.message_id, m.o_custkey)
"""

_WITH_SUMMARY = f"{_ITEMS.rstrip()},{_SUMMARY}"


def _number(text: str) -> str:
    """A decimal as JSON has it: without zeros at its end."""
    return f"CASE WHEN contains({text}, '.') THEN rtrim(rtrim({text}, '0'), '.') ELSE {text} END"


_POSITION_JSON = (
    f"""'"elevation":' || elev || ',"latitude":' || {_number("lat")} || ',"longitude":'"""
    f""" || {_number("lon")}"""
)

# The whole of an item as the message has it, repaired nowhere.
_ITEM_JSON = f"""
CASE kind WHEN 'VideoInformation' THEN '{{"_type":"VideoInformation","frame":1}}'
  WHEN 'TrackObject' THEN '{{"_type":"TrackObject","note":"n' || l_linenumber || '"}}'
ELSE '{{"TrackPointDetail":{{"pointDetailCovarianceMatrix":{{"c":0}},"pointDetailPosition":'
  || CASE l_returnflag WHEN 'A' THEN
    '{{"_type":"LocalCartesianPosition","localSystem":{{"origin":{{' || {_POSITION_JSON}
    || '}}}},"x":1,"y":2,"z":3}}'
    ELSE '{{"_type":"GeodeticPosition",' || {_POSITION_JSON} || '}}' END
  || ',"pointDetailVelocity":{{"vx":1}}}},"_type":"TrackPoint","ignored":1,'
  || '"trackItemSecurity":{{"level":"UNCLASSIFIED"}},"trackItemSource":"radar","trackItemTime":"'
  || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '","trackItemUUID":"p' || l_orderkey || '-'
  || item_no || '",' || CASE WHEN no_course THEN '' ELSE '"trackPointCourse":' || course || ',' END
  || '"trackPointObjectMask":"NONE","trackPointPosition":{{' || {_POSITION_JSON}
  || '}},"trackPointSource":"' || replace(source, '_', ' ') || '","trackPointSpeed":'
  || {_number("speed")} || ',"trackPointType":"MEASURED"}}' END"""

_WITH_BODIES = f"""{_ITEMS.rstrip()},
bodies AS (
  SELECT m.message_id, md5(m.message_id) AS doc_id,
    '{{"_version":1,"junk":"x","messageSecurity":"UNCLASSIFIED","msgCreatedTime":"'
    || strftime(m.o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","senderId":"c' || m.o_custkey
    || '","stanagVersion":3,"tracks":{{"items":'
    || CASE WHEN m.n_items = 1 THEN min({_ITEM_JSON})
       ELSE '[' || string_agg({_ITEM_JSON}, ',' ORDER BY i.item_no) || ']' END
    || ',"trackUUID":"t' || m.o_orderkey || '"}}}}' AS json
  FROM messages m JOIN items i ON m.message_id = i.message_id
  WHERE NOT m.broken GROUP BY m.message_id, m.o_orderdate, m.o_custkey, m.o_orderkey, m.n_items)
"""

_POSITION_XML = (
    "'<latitude>' || lat || '</latitude><longitude>' || lon || '</longitude><elevation>'"
    " || elev || '</elevation>'"
)

_ITEM_XML = f"""
CASE WHEN kind = 'TrackObject'
  THEN '<items type="TrackObject"><note>n' || l_linenumber || '</note></items>'
ELSE '<items type="TrackPoint"><trackItemUUID>' || uuid || '</trackItemUUID>'
  || '<trackItemSecurity><level>UNCLASSIFIED</level></trackItemSecurity>'
  || '<trackItemTime>' || item_time || '</trackItemTime>'
  || '<trackItemSource>radar</trackItemSource><trackItemComment></trackItemComment>'
  || '<trackPointPosition>' || {_POSITION_XML} || '</trackPointPosition>'
  || '<trackPointSpeed>' || speed || '</trackPointSpeed>'
  || '<trackPointCourse>' || course || '</trackPointCourse>'
  || '<trackPointType>MEASURED</trackPointType>'
  || '<trackPointSource>' || source || '</trackPointSource>'
  || '<trackPointObjectMask>NONE</trackPointObjectMask><TrackPointDetail>'
  || '<pointDetailVelocity><vx>1</vx></pointDetailVelocity>'
  || '<pointDetailCovarianceMatrix><c>0</c></pointDetailCovarianceMatrix>'
  || '<pointDetailPosition type="GeodeticPosition">' || {_POSITION_XML}
  || '</pointDetailPosition></TrackPointDetail></items>' END"""

_MESSAGE_XML = f"""{_ITEMS},
bodies AS (
  SELECT m.*, coalesce(string_agg({_ITEM_XML}, '' ORDER BY kept_idx)
    FILTER (k.message_id IS NOT NULL), '') AS body
  FROM messages m LEFT JOIN kept k ON m.message_id = k.message_id
  WHERE NOT m.broken AND NOT m.lacks_course GROUP BY ALL)
SELECT message_id, '<TrackMessage><messageSecurity>UNCLASSIFIED</messageSecurity>'
  || '<msgCreatedTime>' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '</msgCreatedTime>'
  || '<stanagVersion>3.0</stanagVersion><senderId>c' || o_custkey || '</senderId><tracks>'
  || '<trackUUID>t' || o_orderkey || '</trackUUID>' || body || '</tracks></TrackMessage>'
  AS track_xml
FROM bodies"""


def _rich(sql: str) -> str:
    """SQL that writes messages with the extra content; attributes of a track do not stay."""
    for plain, rich in RICH.items():
        kept = rich.replace('<tracks n="1"><!-- <items type="x"> -->', "<tracks>")
        sql = sql.replace(plain, kept.replace("'", "''"))
    return sql


_STATUS = RICH["<tracks>"].split("-->")[1]
_LAST = RICH["</tracks>"].removesuffix("</tracks>")

_FEATURES = f"""{_ITEMS}
SELECT {_TYPED}, CAST(time_bin AS BIGINT) AS time_bin, st_key FROM {_KEYED}"""

# Leaf fields of the messages, the types inference gives them, and the item they come with.
_SCHEMA_ROWS = """
  ('_corrupt_record', 'string', 'broken'), ('_version', 'bigint', NULL),
  ('junk', 'string', NULL), ('messageSecurity', 'string', NULL),
  ('msgCreatedTime', 'timestamp', NULL), ('senderId', 'string', NULL),
  ('stanagVersion', 'double', NULL), ('tracks.trackUUID', 'string', NULL),
  ('tracks.items[]._type', 'string', NULL),
  ('tracks.items[].frame', 'bigint', 'VideoInformation'),
  ('tracks.items[].note', 'string', 'TrackObject'),
  ('tracks.items[].ignored', 'bigint', 'TrackPoint'),
  ('tracks.items[].trackItemComment', 'string', 'TrackPoint'),
  ('tracks.items[].trackItemSecurity.level', 'string', 'TrackPoint'),
  ('tracks.items[].trackItemSource', 'string', 'TrackPoint'),
  ('tracks.items[].trackItemTime', 'timestamp', 'TrackPoint'),
  ('tracks.items[].trackItemUUID', 'string', 'TrackPoint'),
  ('tracks.items[].trackPointCourse', 'bigint', 'TrackPoint'),
  ('tracks.items[].trackPointObjectMask', 'string', 'TrackPoint'),
  ('tracks.items[].trackPointPosition.elevation', 'bigint', 'TrackPoint'),
  ('tracks.items[].trackPointPosition.latitude', 'double', 'TrackPoint'),
  ('tracks.items[].trackPointPosition.longitude', 'double', 'TrackPoint'),
  ('tracks.items[].trackPointSource', 'string', 'TrackPoint'),
  ('tracks.items[].trackPointSpeed', 'double', 'TrackPoint'),
  ('tracks.items[].trackPointType', 'string', 'TrackPoint')"""

_DETAIL = "tracks.items[].TrackPointDetail"

_DETAIL_ROWS = f"""
  ('{_DETAIL}.pointDetailCovarianceMatrix.c', 'bigint', 'TrackPoint'),
  ('{_DETAIL}.pointDetailVelocity.vx', 'bigint', 'TrackPoint'),
  ('{_DETAIL}.pointDetailPosition._type', 'string', 'TrackPoint'),
  ('{_DETAIL}.pointDetailPosition.elevation', 'bigint', 'N'),
  ('{_DETAIL}.pointDetailPosition.latitude', 'double', 'N'),
  ('{_DETAIL}.pointDetailPosition.longitude', 'double', 'N'),
  ('{_DETAIL}.pointDetailPosition.x', 'bigint', 'A'),
  ('{_DETAIL}.pointDetailPosition.y', 'bigint', 'A'),
  ('{_DETAIL}.pointDetailPosition.z', 'bigint', 'A'),
  ('{_DETAIL}.pointDetailPosition.localSystem.origin.elevation', 'bigint', 'A'),
  ('{_DETAIL}.pointDetailPosition.localSystem.origin.latitude', 'double', 'A'),
  ('{_DETAIL}.pointDetailPosition.localSystem.origin.longitude', 'double', 'A')"""

ORACLES = {
    "infer_schema": f"""{_ITEMS},
seen AS (
  SELECT kind AS what FROM items WHERE NOT broken
  UNION SELECT l_returnflag FROM items WHERE NOT broken
  UNION SELECT 'broken' FROM messages WHERE broken)
SELECT path, type FROM (VALUES {_SCHEMA_ROWS}, {_DETAIL_ROWS}) AS leaves(path, type, what)
WHERE what IS NULL OR what IN (SELECT what FROM seen)""",
    "repair_tokens": f"""{_ITEMS}
SELECT message_id, 0 AS n_broken, CAST(n_tokens AS INTEGER) AS n_repaired FROM messages""",
    "document_lengths": f"""{_ITEMS}
SELECT message_id, CAST(n_tokens * length(' ESTIMATED') AS INTEGER) AS n_chars_less
FROM messages""",
    "parse_messages": f"""{_ITEMS}
SELECT message_id, CASE WHEN broken THEN 'malformed_xml' END AS parse_error,
  CASE WHEN NOT broken THEN 'c' || o_custkey END AS sender,
  CASE WHEN NOT broken THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS created,
  CASE WHEN NOT broken THEN 't' || o_orderkey END AS track_uuid,
  CASE WHEN NOT broken THEN n_items END AS n_items
FROM messages""",
    "header": f"""{_ITEMS}
SELECT message_id, 'UNCLASSIFIED' AS "messageSecurity", 1 AS "n_messageSecurity",
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "msgCreatedTime", 1 AS "n_msgCreatedTime",
  '3.0' AS "stanagVersion", 1 AS "n_stanagVersion",
  'c' || o_custkey AS "senderId", 1 AS "n_senderId",
  'messageSecurity,msgCreatedTime,stanagVersion,senderId,tracks' AS fields
FROM messages WHERE NOT broken""",
    "route_items": f"""{_ITEMS}
SELECT message_id, 't' || l_orderkey AS track_uuid, kept_idx AS item_idx, kind AS item_type,
  CASE WHEN kind = 'TrackObject' THEN '<note>n' || l_linenumber || '</note>' END AS raw
FROM kept""",
    "project_points": f"""{_ITEMS}
SELECT message_id, uuid AS "trackItemUUID",
  '<level>UNCLASSIFIED</level>' AS "trackItemSecurity", item_time AS "trackItemTime",
  'radar' AS "trackItemSource", '' AS "trackItemComment", speed AS "trackPointSpeed",
  course AS "trackPointCourse", 'MEASURED' AS "trackPointType", source AS "trackPointSource",
  'NONE' AS "trackPointObjectMask", lat AS latitude, lon AS longitude, elev AS elevation
FROM points""",
    "project_detail": f"""{_ITEMS}
SELECT uuid AS item_uuid, '<vx>1</vx>' AS "pointDetailVelocity",
  '<c>0</c>' AS "pointDetailCovarianceMatrix", 'GeodeticPosition' AS position_type,
  lat AS latitude, lon AS longitude, elev AS elevation,
  l_returnflag = 'A' AS position_is_origin
FROM points""",
    "geodetic_position": f"""{_ITEMS}
SELECT uuid AS item_uuid,
  CASE l_returnflag WHEN 'A' THEN 'LocalCartesianPosition' ELSE 'GeodeticPosition' END
    AS type_before,
  CASE l_returnflag WHEN 'A' THEN '1' END AS x_before, 'GeodeticPosition' AS type_after,
  CAST(NULL AS VARCHAR) AS x_after, lat AS latitude, lon AS longitude, elev AS elevation
FROM points""",
    "valid_messages": f"""{_ITEMS}
SELECT message_id FROM messages WHERE NOT broken AND NOT lacks_course""",
    "rejected_messages": f"""{_ITEMS}
SELECT message_id,
  CASE WHEN broken THEN 'malformed_xml' ELSE 'missing_child:trackPointCourse' END
    AS reject_reason,
  CASE WHEN broken THEN '' ELSE 'trackPointCourse' END AS missing
FROM messages WHERE broken OR lacks_course""",
    "message_json": f"{_WITH_BODIES} SELECT doc_id, json FROM bodies",
    "concat_json": f"""{_ITEMS}
SELECT message_id, count(*) AS n_rows,
  string_agg('{{"type":"' || kind || '"'
    || CASE kind WHEN 'TrackPoint' THEN ',"uuid":"' || uuid || '"' ELSE '' END || '}}', ''
    ORDER BY kept_idx) AS json
FROM kept GROUP BY message_id""",
    "to_track_xml": _MESSAGE_XML,
    "rewrite_track_xml": _rich(_MESSAGE_XML),
    "track_children": _rich(
        f"""{_ITEMS}, children AS (
  SELECT message_id, kept_idx + 2 AS child_idx, 'items' AS name, kind AS type, {_ITEM_XML} AS xml
  FROM kept
  UNION ALL SELECT message_id, 1, 'trackUUID', NULL,
    '<trackUUID>t' || o_orderkey || '</trackUUID>'
  FROM messages WHERE NOT broken AND NOT lacks_course
  UNION ALL SELECT message_id, 0, 'trackStatus', NULL, '{_STATUS}'
  FROM messages WHERE NOT broken AND NOT lacks_course
  UNION ALL SELECT m.message_id, 2 + count(k.kind), 'last', NULL, '{_LAST}'
  FROM messages m LEFT JOIN kept k ON k.message_id = m.message_id
  WHERE NOT m.broken AND NOT m.lacks_course GROUP BY m.message_id)
SELECT message_id, CAST(0 AS BIGINT) AS track_idx, CAST(child_idx AS BIGINT) AS child_idx, name,
  type, xml
FROM children"""
    ),
    "raw_items": _rich(
        f"""{_ITEMS}
SELECT message_id, item_no - 1 AS item_no, '<note>n' || l_linenumber || '</note>' AS raw
FROM kept WHERE kind = 'TrackObject'"""
    ),
    "reparse_track_xml": f"""{_ITEMS}
SELECT message_id, item_uuid, "time", lon, lat, elev, speed FROM typed""",
    "track_points": f"{_ITEMS} SELECT {_TYPED}, item_idx, track_uuid FROM typed",
    "st_index": f"""{_ITEMS}
SELECT item_uuid, CAST(time_bin AS BIGINT) AS time_bin, st_key FROM {_KEYED}""",
    "lines_to_track_points": f"{_ITEMS} SELECT {_TYPED}, st_key FROM {_KEYED}",
    "feature_sink": _FEATURES,
    "range_points": f"""{_ITEMS} SELECT {_TYPED}, st_key FROM {_KEYED}
WHERE lon BETWEEN {BOX[0]} AND {BOX[2]} AND lat BETWEEN {BOX[1]} AND {BOX[3]}
  AND "time" BETWEEN TIMESTAMP '{BOX[4]}' AND TIMESTAMP '{BOX[5]}'""",
    "document_sink": f"""{_WITH_BODIES}
SELECT 'lake' AS "index", 'track_message' AS type, doc_id, json AS body FROM bodies""",
    "message_sink": f"""{_WITH_SUMMARY}
SELECT message_id, 'c' || o_custkey AS sender, n_items FROM summaries""",
    "fan_out": f"""{_WITH_BODIES}
SELECT 'document' AS sink, doc_id AS id, json AS body FROM bodies
UNION ALL SELECT 'feature' AS sink, item_uuid AS id, CAST(st_key AS VARCHAR) AS body
FROM {_KEYED}""",
    "tagged_outputs": f"""{_WITH_BODIES}
SELECT 'document' AS kind, message_id, doc_id AS name, json AS value FROM bodies
UNION ALL SELECT 'rejected' AS kind, message_id, NULL AS name,
  CASE WHEN broken THEN 'malformed_xml' ELSE 'missing_child:trackPointCourse' END AS value
FROM messages WHERE broken OR lacks_course
UNION ALL SELECT 'point' AS kind, message_id, item_uuid AS name,
  concat_ws(':', time_bin, st_key, 0, item_idx, track_uuid, '') AS value
FROM {_KEYED}""",
    "sink_report": f"""{_ITEMS}
SELECT count(*) FILTER (NOT broken) AS n_accepted, count(*) FILTER (broken) AS n_rejected
FROM messages""",
}
