"""SQL for the repair of conversations: the cheapest edits by a step a row."""

from __future__ import annotations

from trackflow.llm.manifest_sql import crc32_of

_STATES = "(VALUES (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS s(state, fit, next)"

# Ways to go on before a row: no inserted turn, one, or two.
_OPENED = f"""
  SELECT key, pos, state, cost, audit, done FROM step
  UNION ALL SELECT key, pos, next, cost + 2, audit || 'I',
    done || [if(fit = 'u', 'user:', 'assistant:')] FROM step JOIN {_STATES} USING (state)
  UNION ALL SELECT key, pos, t.next, cost + 4, audit || 'II',
    done || [if(s.fit = 'u', 'user:', 'assistant:'), if(t.fit = 'u', 'user:', 'assistant:')]
    FROM step JOIN {_STATES} USING (state) JOIN {_STATES.replace(" AS s(", " AS t(")}
    ON s.next = t.state"""

_WHITE = r"[\x20\x09-\x0D]"

REPAIR = rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, coalesce('=' || conv_id, '') AS key, turn, coalesce(role, ' ') AS role,
    coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
summed AS (SELECT *, {crc32_of("name")} % 20 AS damage FROM named),
harmed AS (
  SELECT key, turn, if(damage = 4, 'user', role) AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM summed, range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY key ORDER BY turn NULLS FIRST, encode(role), sha256(text)) AS pos
  FROM harmed),
judged AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN regexp_matches(text, '[^.!?\x20\x09-\x0D]{_WHITE}*\z') THEN 'truncated' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY key ORDER BY pos) || left(role, 1) AS pair
  FROM placed),
counted AS (
  SELECT key, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY key),
step AS (
  SELECT key, CAST(0 AS BIGINT) AS pos, 0 AS state, 0 AS cost, '' AS audit,
    CAST([] AS VARCHAR[]) AS done
  FROM counted
  UNION ALL
  SELECT key, pos, state, unnest.cost, unnest.audit, unnest.done FROM (
    SELECT key, pos, state,
      unnest([min({{'cost': cost, 'audit': audit, 'done': done}})]) AS "unnest"
    FROM (
      SELECT o.key, j.pos, o.state, cost + 3 AS cost, audit || 'D' AS audit, done
      FROM ({_OPENED}) o JOIN judged j ON j.key = o.key AND j.pos = o.pos + 1
      UNION ALL
      SELECT o.key, j.pos, if(j.initial = 's', 1, s.next), cost + if(fault = 'truncated', 1, 0),
        audit || 'K', done || [role || ':' || text]
      FROM ({_OPENED}) o JOIN judged j ON j.key = o.key AND j.pos = o.pos + 1
        JOIN {_STATES} ON s.state = o.state
      WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate')
        AND (j.initial = s.fit OR j.initial = 's' AND o.state = 0)
      UNION ALL
      SELECT o.key, j.pos, s.next, cost + 2 + if(fault = 'truncated', 1, 0), audit || 'R',
        done || [if(fit = 'u', 'user', 'assistant') || ':' || text]
      FROM ({_OPENED}) o JOIN judged j ON j.key = o.key AND j.pos = o.pos + 1
        JOIN {_STATES} ON s.state = o.state
      WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate'))
    GROUP BY key, pos, state)),
ended AS (
  SELECT key, min({{'cost': cost, 'audit': audit, 'done': done}}) AS best
  FROM ({_OPENED}) JOIN counted USING (key) WHERE pos = n AND state IN (0, 3) GROUP BY key)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
  coalesce(best.audit, '') AS audit,
  sha256(coalesce(array_to_string(best.done, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, key FROM named) c
  LEFT JOIN counted USING (key) LEFT JOIN ended USING (key)
"""
