"""Helpers to assemble oracle SQL: adapters are found by name in the body."""

from __future__ import annotations

import re

from racelake import fixtures as fx


def oracle(body: str) -> str:
    names = sorted(set(re.findall(r"\bfx_[a-z0-9_]+\b", body)))
    names = [n for n in names if n in fx.ADAPTERS]
    if not names:
        return body
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {fx.cte_sql(names)},\n{stripped[5:]}"
    return fx.oracle_with(names, body)


def session_map_sql(sessions: str, races: str) -> str:
    """Session -> round with main/canonical flags (DuckDB)."""
    return f"""(
SELECT s.session_key, s.year AS season, mr.round, s.session_name, s.session_type,
       CASE WHEN s.session_type = 'Race' AND NOT s.is_main THEN 'Sprint'
            WHEN s.session_type = 'Qualifying' AND NOT s.is_main THEN 'Sprint Qualifying'
            ELSE s.session_type END AS canonical_type,
       s.is_main, s.date_start
FROM (SELECT *, row_number() OVER (PARTITION BY meeting_key, session_type ORDER BY date_start DESC) = 1 AS is_main
      FROM {sessions}) s
LEFT JOIN (
  SELECT rs.meeting_key, rs.year, min(jr.round) AS round
  FROM (SELECT meeting_key, year, CAST(date_start AS DATE) AS race_date_utc FROM {sessions} WHERE session_type = 'Race') rs
  JOIN {races} jr ON jr.season = rs.year
   AND (jr.race_date = rs.race_date_utc OR jr.race_date = CAST(rs.race_date_utc - INTERVAL 1 DAY AS DATE))
  GROUP BY rs.meeting_key, rs.year
) mr ON mr.meeting_key = s.meeting_key AND mr.year = s.year
)"""


BRIDGE = "(SELECT DISTINCT jolpica_driver_id, openf1_driver_number, season FROM fx_driver_id_map)"
SMAP = session_map_sql("fx_stg_sessions", "fx_races")
