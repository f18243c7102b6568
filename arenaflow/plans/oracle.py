"""DuckDB SQL for every registered query: the differential oracle.

Written from the meaning of each query, not from the Spark plans: the logs are
rebuilt from the test tables by the mapping of :mod:`arenaflow.sources.fixtures`;
the consolidated view is a full join of the match log with one row per match
of the participant log; a match qualifies by the existence of a fitting
participant and admission (a semi join); the era rule is one condition.
"""

from __future__ import annotations

from arenaflow.sources.fixtures import FIXTURE_AUDIT_COUNT, FIXTURE_LOOKUP_BATTLEID, FIXTURE_PARAMS as P

# The exported fields, in record order ('' marks an empty field).
MEASURES = (
    "gold", "score", "kill", "death", "assist", "rank_tid", "continuekill", "towerkill", "creepkill", "dmgtohero",
    "dmgtotower", "dmgreceived", "magdmgreceived", "doublekill", "triblekill", "quadrakill", "pentakill",
    "healingtohero", "herotid", "modetid", "usernum",
)
EMPTY = ("continuekill", "doublekill")
KILLS = ("faction_1_total_kill", "faction_2_total_kill", "faction_total_kill")
MATCH_ATTRIBUTES = (
    "gametype", "modetid", "battletid", "begintime", "playtime", "playersnum", "usernum",
    "fakeusernum", "robotnum", "gather_report_sec", "illegal_player_1", "illegal_player_3",
)
# The code points that count as white space in a version.
WHITE = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

IN_RUN = f"BETWEEN '{P.start_date}' AND '{P.end_date}'"
ALLOWED = ", ".join(f"'{v}'" for v in P.version_allow_list)
FIELDS = ", ".join(f"'' AS {m}" if m in EMPTY else m for m in MEASURES)


def _record(fields) -> str:
    """A packed record: the fields as text, joined by U+0001, NULL as empty text."""
    return "concat_ws(chr(1), " + ", ".join(f"ifnull(CAST({f} AS VARCHAR), '')" for f in fields) + ")"


def _grouped(usable: str) -> str:
    """First usable version of each match."""
    return f"SELECT battleid, min({usable}) AS keyversion FROM participants GROUP BY ALL"


BASE = f"""
WITH participants AS (
  SELECT l_orderkey AS battleid,
         l_suppkey AS role_id,
         substr(CAST(l_shipdate AS VARCHAR), 1, 19) AS logtime,
         CAST(CASE WHEN l_linestatus = 'F' THEN 1 WHEN l_returnflag = 'A' THEN NULL ELSE 2 END AS INTEGER) AS factionid,
         CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN CASE WHEN l_orderkey % 2 = 0 THEN '   ' ELSE chr(9) END WHEN 4 THEN 'null'
              WHEN 5 THEN ' NULL ' ELSE 'v' || CAST(l_partkey % 7 AS VARCHAR) END AS keyversion,
         CAST(CASE WHEN l_returnflag = 'R' THEN 8 ELSE 10 END AS INTEGER) AS usernum,
         CAST(l_linenumber AS INTEGER) AS modetid,
         CAST(l_partkey % 5 AS INTEGER) AS herotid,
         CAST(floor(l_extendedprice + 0.5) AS BIGINT) AS gold,
         CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS score,
         CAST(l_quantity AS BIGINT) AS kill,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(floor(l_tax * 100 + 0.5) AS BIGINT) END AS death,
         l_partkey AS assist,
         CAST(l_linenumber AS BIGINT) AS rank_tid,
         l_partkey % 11 AS towerkill,
         l_suppkey % 13 AS creepkill,
         CAST(l_quantity AS BIGINT) * 100 + l_linenumber AS dmgtohero,
         l_orderkey % 1000 AS dmgtotower,
         (l_partkey * 7) % 1000 AS dmgreceived,
         (l_partkey + l_suppkey) % 500 AS magdmgreceived,
         CAST(l_linenumber % 2 AS BIGINT) AS triblekill,
         CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_linenumber % 3 AS BIGINT) END AS quadrakill,
         CAST(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS BIGINT) AS pentakill,
         CAST(floor(l_tax * 1000 + 0.5) AS BIGINT) AS healingtohero
  FROM lineitem
),
matches AS (
  SELECT o_orderkey AS battleid,
         o_orderstatus AS gametype,
         CAST(o_custkey % 7 + 1 AS INTEGER) AS modetid,
         o_orderpriority AS battletid,
         substr(CAST(o_orderdate AS VARCHAR), 1, 19) AS begintime,
         CAST(floor(o_totalprice + 0.5) AS BIGINT) % 3600 AS playtime,
         CAST(10 AS INTEGER) AS playersnum,
         CAST(CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 8 END AS INTEGER) AS usernum,
         CAST(o_custkey % 3 AS INTEGER) AS fakeusernum,
         CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey % 2 END AS INTEGER) AS robotnum,
         o_orderkey % 60 AS gather_report_sec,
         CASE WHEN o_custkey % 4 = 0 THEN CAST(o_custkey AS VARCHAR) || ',' || o_orderstatus END AS illegal_player_1,
         CAST(o_custkey % 10 AS VARCHAR) AS illegal_player_3
  FROM orders
),
admissions AS MATERIALIZED (
  SELECT DISTINCT l_orderkey AS matching_id,
         l_suppkey AS role_id,
         CAST(floor(s_acctbal + 0.5) AS BIGINT) AS team_elo,
         substr(CAST(o_orderdate AS VARCHAR), 1, 19) AS logtime,
         substr(CAST(o_orderdate + INTERVAL 1 DAY * (l_suppkey % 3 * 60) AS VARCHAR), 1, 10) AS pt_dt
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
),
played AS (
  SELECT *, left(logtime, 10) AS day,
         CASE WHEN trim(keyversion, ' ') NOT IN ('', 'null', 'Null', 'NULL') THEN keyversion END AS usable
  FROM participants
),
per_match AS (
  SELECT battleid, min(day) AS pt_dt, min(usable) AS keyversion,
         CAST(sum(kill * CAST(factionid IS NOT DISTINCT FROM 1 AS INTEGER)) AS BIGINT) AS faction_1_total_kill,
         CAST(sum(kill * CAST(factionid IS NOT DISTINCT FROM 2 AS INTEGER)) AS BIGINT) AS faction_2_total_kill,
         CAST(sum(kill) AS BIGINT) AS faction_total_kill
  FROM played GROUP BY ALL
),
known AS (
  SELECT *, {", ".join(f"CAST({k} AS VARCHAR) AS {k}_text" for k in KILLS)}
  FROM (SELECT battleid, {", ".join(MATCH_ATTRIBUTES)} FROM matches) FULL JOIN per_match USING (battleid)
),
fitting AS (
  SELECT day AS pt_dt, battleid, role_id, {FIELDS}
  FROM played
  WHERE day {IN_RUN} AND usernum = {P.usernum} AND list_contains({list(P.modetids)}, modetid)
    AND herotid = {P.hero_id} AND score >= {P.score} AND battleid IS NOT NULL
),
rated AS (
  SELECT matching_id AS battleid, role_id, team_elo FROM admissions WHERE team_elo >= {P.team_elo}
),
dated AS (
  SELECT battleid, keyversion, {", ".join(f"{k}_text AS {k}" for k in KILLS)} FROM known WHERE pt_dt {IN_RUN}
),
match_days AS (
  SELECT DISTINCT pt_dt, left(pt_dt, 7) AS pt_dt_date, battleid
  FROM fitting
  SEMI JOIN rated USING (battleid, role_id)
),
qualified AS (SELECT * FROM match_days JOIN dated USING (battleid)),
eligible AS MATERIALIZED (SELECT * FROM qualified WHERE pt_dt >= '{P.version_cutoff}' OR keyversion IN ({ALLOWED})),
qualified_roles AS (
  SELECT DISTINCT *, left(pt_dt, 7) AS pt_dt_date
  FROM fitting JOIN rated USING (battleid, role_id) JOIN dated USING (battleid)
),
eligible_roles AS (SELECT * FROM qualified_roles WHERE pt_dt >= '{P.version_cutoff}' OR keyversion IN ({ALLOWED})),
lineup AS (
  SELECT e.pt_dt, e.battleid, p.battleid AS played_battleid, p.role_id, p.* EXCLUDE (battleid, role_id)
  FROM eligible e JOIN (SELECT battleid, role_id, {FIELDS} FROM played WHERE day {IN_RUN}) p USING (battleid)
),
detail AS (
  SELECT lineup.* EXCLUDE (played_battleid), team_elo
  FROM lineup LEFT JOIN (SELECT matching_id, role_id, team_elo FROM admissions WHERE left(logtime, 10) {IN_RUN}) a
    ON a.matching_id = lineup.battleid AND a.role_id = lineup.role_id
)
"""

DETAIL_RECORD = _record(("battleid", "role_id", *MEASURES, "team_elo"))
MATCH_RECORD = _record(("battleid", "keyversion", *KILLS))
ROLE_RECORD = _record(("battleid", "role_id", "keyversion", *MEASURES, "team_elo", *KILLS))


def _wide(pattern: str) -> str:
    """Every attribute of a match as text; ``pattern`` forms the text of a value."""
    own = [pattern.format(c) + f" AS {c}" for c in ("pt_dt", *MATCH_ATTRIBUTES, "keyversion")]
    kills = [pattern.format(f"{k}_text") + f" AS {k}" for k in KILLS]
    return f"SELECT battleid, {', '.join(own + kills)} FROM known"


def _per_month(rows: str) -> str:
    return f"SELECT left(pt_dt, 7) AS pt_dt_date, count(*) AS record_count FROM {rows} GROUP BY ALL"


VIEW = f"SELECT battleid, pt_dt, keyversion, {', '.join(f'{k}_text AS {k}' for k in KILLS)} FROM known"
# the JSON scan reads measures as doubles; line 3 of a match is written with half a point more
DOUBLES = [m for m in MEASURES if m not in (*EMPTY, "herotid", "modetid", "usernum")]
SCANNED = ", ".join(f"CAST({m} AS DOUBLE)" + (" + 0.5 * CAST(rank_tid = 3 AS INTEGER)" if m == "score" else "") + f" AS {m}" for m in DOUBLES)
SCANNED_PLAIN = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in DOUBLES)

# which rules a participant row passes on the way to the match export, in order
RULES = ("match_id", "date", "lobby", "mode", "hero", "score", "admitted", "rated", "match_date", "version")
RULED = f"""(
  SELECT day, battleid, ifnull(list_position(oks, false), {len(RULES) + 1}) AS step, oks FROM (
    SELECT day, p.battleid, list_transform([
      p.battleid IS NOT NULL, day {IN_RUN}, usernum = {P.usernum}, list_contains({list(P.modetids)}, modetid), herotid = {P.hero_id},
      score >= {P.score}, s.matching_id IS NOT NULL, s.elo >= {P.team_elo}, m.pt_dt {IN_RUN}, day >= '{P.version_cutoff}' OR m.keyversion IN ({ALLOWED})
    ], lambda x: ifnull(x, false)) AS oks
    FROM played p
    LEFT JOIN (SELECT matching_id, role_id, max(team_elo) AS elo FROM admissions GROUP BY ALL) s ON s.matching_id = p.battleid AND s.role_id = p.role_id
    LEFT JOIN per_match m ON m.battleid = p.battleid
  ) r
)"""
STEPS = [*RULES, "kept"]
# rules that no row of the match passes
NEVER = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT bool_or(oks[{k}]) THEN '{rule}' END" for k, rule in enumerate(RULES, 1)) + ")"

# what a raw line's odd number is worth as text, by the rank in the line; the fifth is infinite
ODD_GOLD = (
    "CASE rank_tid WHEN 1 THEN '1' || repeat('0', 33) WHEN 2 THEN '0.1234567' WHEN 3 THEN '0.0000001' WHEN 4 THEN '0' WHEN 5 THEN NULL "
    "WHEN 6 THEN '1.0E40' WHEN 7 THEN '12.5' ELSE CAST(gold AS VARCHAR) END"
)

FINAL = {
    "json_log_scan": f"SELECT * REPLACE ({SCANNED}) FROM participants",
    "json_odd_numbers": (
        f"SELECT battleid, role_id, CAST(rank_tid AS DOUBLE) AS rank_tid, {_record(('battleid', 'role_id', ODD_GOLD, 'kill', 'death'))} AS record, "
        "CASE WHEN rank_tid = 5 THEN 'gold' END AS uncast FROM participants"
    ),
    "indexed_date_range": f"SELECT * REPLACE ({SCANNED_PLAIN}) FROM participants WHERE left(logtime, 10) {IN_RUN}",
    "catalog_scan": "FROM eligible",
    "sink_roundtrip": f"SELECT pt_dt, {MATCH_RECORD} AS battle_info FROM eligible",
    "export_readback": (
        "SELECT pt_dt, battleid, keyversion, " + ", ".join(f"CAST({k} AS BIGINT) AS {k}" for k in KILLS) + " FROM eligible"
    ),
    "published_exports": (
        f"SELECT 'battle_info' AS export, pt_dt, {MATCH_RECORD} AS battle_info FROM eligible "
        f"UNION ALL SELECT 'player_info', pt_dt, {DETAIL_RECORD} FROM detail"
    ),
    "verified_readback": (
        "SELECT pt_dt, width, count(*) AS records, true AS file_of_date, 'same' AS status FROM ("
        f"SELECT pt_dt, CAST({len(MEASURES) + 7} AS INTEGER) AS width FROM eligible_roles "
        "UNION ALL SELECT left(begintime, 10), 2 FROM matches WHERE battleid % 50 = 0) r GROUP BY ALL"
    ),
    "framed_sections": (
        "SELECT conv_id, ifnull(string_agg(text || chr(10), '' ORDER BY turn) FILTER (text <> ''), '') AS section_text, "
        "count(*) FILTER (text <> '') AS frame_count, 'ok' AS status FROM conversations GROUP BY ALL"
    ),
    "framed_split_sections": (
        "SELECT conv_id, ifnull(string_agg(text || chr(10), '' ORDER BY turn) FILTER (text <> ''), '') AS section_text, "
        "count(*) FILTER (text <> '') AS frame_count, 'ok' AS status FROM conversations GROUP BY ALL"
    ),
    # of two sections the last counts; a file that ends within a header gives no text
    "framed_odd_sections": (
        "SELECT conv_id, CASE WHEN conv_id % 3 <> 2 THEN ifnull(string_agg(text || chr(10), '' ORDER BY turn) FILTER (counts), '') END AS section_text, "
        "CASE WHEN conv_id % 3 = 2 THEN 0 ELSE count(*) FILTER (counts) END AS frame_count, "
        "CASE WHEN conv_id % 3 = 2 THEN 'truncated_header' ELSE 'ok' END AS status "
        "FROM (SELECT *, text <> '' AND (turn > 1 OR conv_id % 3 <> 1 OR max(turn) OVER (PARTITION BY conv_id) < 1) AS counts FROM conversations) c "
        "GROUP BY conv_id"
    ),
    "participant_projection": f"SELECT day AS pt_dt, battleid, role_id, {FIELDS} FROM played",
    "date_month_keys": "SELECT battleid, role_id, day AS pt_dt, left(day, 7) AS pt_dt_date FROM played",
    "date_range_filter": f"SELECT * FROM participants WHERE left(logtime, 10) {IN_RUN}",
    "participant_filter": "FROM fitting",
    "admission_filter": "SELECT battleid AS matching_id, role_id, team_elo FROM rated",
    "admission_window": f"SELECT matching_id, role_id, team_elo, pt_dt FROM admissions WHERE pt_dt {IN_RUN}",
    "point_lookup": f"SELECT DISTINCT * FROM participants WHERE battleid = {FIXTURE_LOOKUP_BATTLEID}",
    "compact_dates": (
        "SELECT day AS pt_dt, strftime(CAST(day AS DATE), '%Y%m%d') AS compact, day AS iso_sliced, day AS iso_checked "
        "FROM (SELECT DISTINCT day FROM played) d"
    ),
    "match_kill_totals": f"SELECT battleid, {', '.join(KILLS)} FROM per_match",
    "first_non_null": "SELECT battleid, min(day) AS pt_dt, min(keyversion) AS keyversion FROM played GROUP BY ALL",
    "first_earliest": (
        "SELECT battleid, min(day) AS pt_dt, first(usable ORDER BY logtime, usable) FILTER (usable IS NOT NULL) AS keyversion FROM played GROUP BY ALL"
    ),
    "first_valid_version": "SELECT battleid, keyversion FROM per_match",
    "first_valid_ws": _grouped(
        f"CASE WHEN regexp_replace(keyversion, '^{WHITE}+|{WHITE}+$', '', 'g') NOT IN ('', 'null', 'Null', 'NULL') THEN keyversion END"
    ),
    "match_view": VIEW,
    "match_view_in_range": f"{VIEW} WHERE pt_dt {IN_RUN}",
    "match_view_wide": _wide("CAST({0} AS VARCHAR)"),
    "incremental_match_view": _wide("CAST({0} AS VARCHAR)"),
    "first_token": _wide("split_part(CAST({0} AS VARCHAR), ',', 1)"),
    "duplicate_audit": (
        f"SELECT battleid, count(*) AS row_count FROM played WHERE day {IN_RUN} GROUP BY ALL HAVING count(*) = {FIXTURE_AUDIT_COUNT}"
    ),
    "heavy_hitters": "SELECT rank_tid, count(*) AS row_count FROM participants GROUP BY ALL HAVING count(*) > (SELECT count(*) FROM participants) / 10",
    "salted_rank_join": (
        "SELECT battleid, role_id, rank_tid, kill, rank_tid AS r_rank, CAST(sum(kill) OVER (PARTITION BY rank_tid) AS BIGINT) AS rank_kills FROM participants"
    ),
    "drop_funnel": f"SELECT left(day, 7) AS pt_dt_date, {STEPS}[step] AS reason, count(*) AS row_count FROM {RULED} r GROUP BY ALL",
    "match_reasons": (
        f"SELECT battleid, count(*) AS row_count, count(*) FILTER (step = {len(STEPS)}) AS kept_rows, {STEPS}[max(step)] AS furthest, "
        f"{NEVER} AS never_passed FROM {RULED} r WHERE battleid IS NOT NULL GROUP BY battleid"
    ),
    "join_admissions": "FROM fitting JOIN rated USING (battleid, role_id)",
    "join_match_view": "FROM fitting JOIN rated USING (battleid, role_id) JOIN dated USING (battleid)",
    "expand_participants": "FROM lineup",
    "left_join_miss": (
        "SELECT m.battleid, gametype, p.battleid AS played_battleid, role_id, kill FROM matches m LEFT JOIN participants p USING (battleid)"
    ),
    "player_detail": "FROM detail",
    "bucketed_admissions": "FROM fitting JOIN rated USING (battleid, role_id)",
    "bucketed_detail": "FROM detail",
    "detail_stored_date": (
        f"SELECT lineup.* EXCLUDE (played_battleid), team_elo FROM lineup LEFT JOIN "
        f"(SELECT matching_id, role_id, team_elo FROM admissions WHERE pt_dt {IN_RUN}) a "
        "ON a.matching_id = lineup.battleid AND a.role_id = lineup.role_id"
    ),
    "qualified_participants": "FROM qualified_roles",
    "qualified_matches": "FROM qualified",
    "version_allow_list": f"FROM qualified WHERE keyversion IN ({ALLOWED})",
    "version_allow_semi": "FROM qualified WHERE keyversion BETWEEN 'v2' AND 'v4'",
    "era_rule": "FROM eligible",
    "era_rule_reduced": "FROM eligible",
    "union_all_branches": "FROM eligible",
    "union_distinct_branches": "FROM eligible_roles",
    "packed_matches": f"SELECT pt_dt, {MATCH_RECORD} AS battle_info FROM eligible",
    "packed_participants": f"SELECT pt_dt, {ROLE_RECORD} AS battle_info FROM eligible_roles",
    "packed_players": f"SELECT pt_dt, {DETAIL_RECORD} AS battle_info FROM detail",
    "monthly_matches": _per_month("eligible"),
    "monthly_participants": _per_month("(SELECT DISTINCT left(pt_dt, 7) AS pt_dt, battleid, role_id, keyversion FROM eligible_roles)"),
    "monthly_players": _per_month("detail"),
}

ORACLE_SQL: dict[str, str] = {name: BASE + (sql if sql.startswith("SELECT") else "SELECT * " + sql) for name, sql in FINAL.items()}
