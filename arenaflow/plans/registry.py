"""Registered queries over the test tables: one per inventory operator.

Each entry takes ``(spark, sf_dir)``, derives the three logs from the test
tables under ``sf_dir`` and returns a lazy DataFrame.  The I/O entries write to
a fresh folder under the shared checkpoint folder and return the read-back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenaflow.functions import compact_to_iso, compact_to_iso_checked, date_key, iso_to_compact, month_key, pack_record
from arenaflow.operators import (
    duplicate_audit,
    era_rule_union,
    first_earliest,
    first_non_null,
    first_valid_version,
    first_valid_version_ws,
    in_key_window,
    in_log_window,
    join_admissions,
    join_match_view,
    left_join,
    match_kill_totals,
    match_view,
    participant_projection,
    point_lookup,
    qualifying_participants,
    rated_admissions,
    version_allowed,
    version_allowed_semi,
)
from arenaflow.operators.funnel import drop_funnel, match_reasons, passed_rules
from arenaflow.operators.heavy import heavy_hitters, salted_join
from arenaflow.operators.sizing import materialize
from arenaflow.plans import jobs
from arenaflow.schemas import CORRUPT_COLUMN, PARTICIPANTS, UNCAST_COLUMN
from arenaflow.session import scratch_dir
from arenaflow.sources import bucketed, exports, file_index, fixtures, framed, framed_split, logs as logsrc, publication, verified
from arenaflow.sources.fixtures import FIXTURE_AUDIT_COUNT, FIXTURE_LOOKUP_BATTLEID, FIXTURE_PARAMS as P
from arenaflow.streaming import match_state

Query = Callable[[SparkSession, str], DataFrame]


def _logs(spark: SparkSession, sf_dir: str) -> logsrc.Logs:
    return fixtures.load(spark, sf_dir)


def _qualifying_rows(spark, sf_dir):
    return participant_projection(qualifying_participants(_logs(spark, sf_dir).participants, P))


def _rated_admission_rows(spark, sf_dir):
    return rated_admissions(_logs(spark, sf_dir).admissions, P.team_elo).select("matching_id", "role_id", "team_elo")


# --- scans, sources, sinks -------------------------------------------------

def json_log_scan(spark, sf_dir):
    """Participant log written as a JSON-lines tree, some numbers in another JSON
    form and some lines broken, read back through the glob: every line that is
    JSON is a row, with all its values."""
    root = scratch_dir(spark, "json-log")
    participants = _logs(spark, sf_dir).participants
    text = F.to_json(F.struct(*participants.columns))
    line = (
        F.when(F.col("rank_tid") == 1, F.regexp_replace(text, r'"kill":(\d+)', r'"kill":$1.0'))
        .when(F.col("rank_tid") == 2, F.regexp_replace(text, r'"(kill|usernum)":(\d+)', r'"$1":"$2"'))
        .when(F.col("rank_tid") == 3, F.regexp_replace(text, r'"score":(\d+)', r'"score":$1.5'))
        .when(F.col("rank_tid") == 7, F.concat(text, F.lit("\n{\"battleid\": 99, \"role_id\":")))
        .otherwise(text)
    )
    glob = logsrc.write_json_tree(participants, root, line=line, compression="gzip")
    good, _bad = logsrc.split_corrupt(logsrc.read_json_log(spark, glob, PARTICIPANTS))
    return good


def json_odd_numbers(spark, sf_dir):
    """Measures as raw JSON may spell them (huge, tiny, negative zero, infinite, a number as text), read back
    and packed: what an export prints, and which fields were not of their type."""
    participants = _logs(spark, sf_dir).participants
    text = F.to_json(F.struct(*participants.columns))
    spellings = {1: "1e33", 2: "0.1234567", 3: "1e-7", 4: "-0.0", 5: '"Infinity"', 6: "1e40", 7: '"12.50"'}
    line = text
    for rank, number in spellings.items():
        line = F.when(F.col("rank_tid") == rank, F.regexp_replace(text, r'"gold":-?\d+', f'"gold":{number}')).otherwise(line)
    glob = logsrc.write_json_tree(participants, scratch_dir(spark, "json-odd"), line=line, compression="gzip")
    found = logsrc.read_json_log(spark, glob, PARTICIPANTS)
    fields = ("battleid", "role_id", "gold", "kill", "death")
    return found.select("battleid", "role_id", "rank_tid", pack_record(found, fields).alias("record"), F.array_join(UNCAST_COLUMN, ",").alias("uncast"))


def indexed_date_range(spark, sf_dir):
    """The participant log as a JSON tree with a file index: a date range opens only the files that overlap it."""
    root = scratch_dir(spark, "json-indexed")
    glob = logsrc.write_json_tree(_logs(spark, sf_dir).participants, f"{root}/log", compression="gzip")
    file_index.update_index(spark, glob, f"{root}/index")
    found = file_index.read_json_log_range(spark, glob, PARTICIPANTS, f"{root}/index", P.start_date, P.end_date)
    return found.drop(UNCAST_COLUMN, CORRUPT_COLUMN)


def catalog_scan(spark, sf_dir):
    """The match export's eligible set, its logs read as named tables."""
    lg = _logs(spark, sf_dir)
    names = [f"arenaflow_{n}" for n in ("participants", "matches", "admissions")]
    for name, df in zip(names, (lg.participants, lg.matches, lg.admissions), strict=True):
        df.createOrReplaceTempView(name)
    return jobs.eligible_matches(logsrc.Logs.from_tables(spark, *names), P)


def _written_match_export(spark, sf_dir) -> str:
    root = scratch_dir(spark, "export")
    path = P.export_path(root, "battle_info")
    exports.write_keyed_text(jobs.packed_matches(jobs.eligible_matches(_logs(spark, sf_dir), P)), path)
    return path


def sink_roundtrip(spark, sf_dir):
    """Match records written as date-keyed text, read back as (pt_dt, battle_info)."""
    return exports.read_keyed_text(spark, _written_match_export(spark, sf_dir))


def export_readback(spark, sf_dir):
    """A written match export read back and split into typed columns."""
    records = exports.read_keyed_text(spark, _written_match_export(spark, sf_dir))
    fields = [("battleid", "bigint"), ("keyversion", "string")] + [(f, "bigint") for f in jobs.TOTAL_FIELDS]
    return exports.unpack(records, fields)


def published_exports(spark, sf_dir):
    """Both exports of a run, published together over an earlier publication, read through the manifest."""
    lg, root = _logs(spark, sf_dir), scratch_dir(spark, "published")
    publication.publish(spark, P, root, {n: lambda: lg.participants.select(F.lit("1999-01-01").alias("pt_dt"), F.lit("old").alias("battle_info"))
                                         for n in ("battle_info", "player_info")}, rebalance=False)  # of one date
    jobs.publish_match_exports(lg, P, root)
    publication.expire_publications(spark, P, root, ("battle_info", "player_info"))
    both = publication.read_published(spark, P, root)
    return reduce(DataFrame.unionAll, [df.select(F.lit(name).alias("export"), "pt_dt", "battle_info") for name, df in both.items()])


def verified_readback(spark, sf_dir):
    """Participant records written with fingerprints, checked and split on reading: counts by date, width and kind."""
    path = f"{scratch_dir(spark, 'verified')}/battle_total"
    lg = _logs(spark, sf_dir)
    records = jobs.packed_participants(jobs.eligible_participants(lg, P))
    odd = lg.matches.where("battleid % 50 = 0").select(date_key("begintime").alias("pt_dt"), pack_record(lg.matches, ("battleid", "gametype")).alias("battle_info"))
    verified.write_verified_text(records.unionAll(odd), path)
    fields = [(name, "string") for name in jobs.PARTICIPANT_RECORD]
    good, wrong = verified.read_verified(spark, path, fields)
    kinds = good.select("pt_dt", F.lit(len(fields)).alias("width"), "_file").unionAll(wrong.select("pt_dt", "_width", "_file"))
    counts = kinds.groupBy("pt_dt", "width").agg(
        F.count(F.lit(1)).alias("records"), F.bool_and(F.contains("_file", F.concat(F.lit("/pt_dt="), "pt_dt", F.lit("/")))).alias("file_of_date")
    )
    status = verified.check_export(spark, path).select(F.col("pt_dt").alias("_day"), "status")
    return counts.join(status, F.col("pt_dt") == F.col("_day")).drop("_day")


def framed_sections(spark, sf_dir):
    """Conversations framed into gzip files (one per conversation), then each
    file's last section extracted by a distributed binary scan."""
    conv = fixtures.table(spark, sf_dir, "conversations")
    return framed.conversation_sections(spark, conv, scratch_dir(spark, "framed"))


def framed_split_sections(spark, sf_dir):
    """Conversations framed into gzip files of members of two turns; each file's last section put together from its members."""
    out = scratch_dir(spark, "framed-split")
    conv = fixtures.table(spark, sf_dir, "conversations")
    framed.write_frame_files(conv.withColumn("kind", F.lit("frame")), out, enclosed=True, member_frames=2)
    index = materialize(framed_split.index_members(spark, out), "framed-index")
    conv_id = F.regexp_extract("path", r"conv_(-?\d+)\.gz$", 1).cast("bigint").alias("conv_id")
    return framed_split.split_sections(index).select(conv_id, "section_text", "frame_count", "status")


def framed_odd_sections(spark, sf_dir):
    """Files with frames outside the markers, several sections, or a cut header."""
    conv = fixtures.table(spark, sf_dir, "conversations")
    first, last = F.lit(-1).cast("bigint"), F.lit(1 << 40)
    turns = conv.select("conv_id", (F.col("turn") * 2).alias("turn"), F.lit("frame").alias("kind"), "text")
    ids = conv.select("conv_id").distinct()

    def item(rows, turn, kind, text):
        return rows.select("conv_id", turn.alias("turn"), F.lit(kind).alias("kind"), F.lit(text).alias("text"))

    items = (
        turns.unionAll(item(ids, first - 1, "frame", "stray"))
        .unionAll(item(ids, first, "marker", None))
        .unionAll(item(conv.where("turn = 1 AND conv_id % 3 = 1"), F.lit(3).cast("bigint"), "marker", None))
        .unionAll(item(ids, last, "marker", None))
        .unionAll(item(ids, last + 1, "frame", "tail"))
        .unionAll(item(ids.where("conv_id % 3 = 2"), last + 2, "raw", "ab"))
    )
    out = scratch_dir(spark, "framed-odd")
    framed.write_frame_files(items, out)
    return framed.file_sections(spark, out)


# --- projections and filters ----------------------------------------------

def participant_projection_q(spark, sf_dir):
    return participant_projection(_logs(spark, sf_dir).participants)


def date_month_keys(spark, sf_dir):
    return _logs(spark, sf_dir).participants.select(
        "battleid", "role_id", date_key("logtime").alias("pt_dt"), month_key(date_key("logtime")).alias("pt_dt_date")
    )


def date_range_filter(spark, sf_dir):
    return in_log_window(_logs(spark, sf_dir).participants, P.start_date, P.end_date)


def participant_filter(spark, sf_dir):
    return _qualifying_rows(spark, sf_dir)


def admission_filter(spark, sf_dir):
    return _rated_admission_rows(spark, sf_dir)


def admission_window(spark, sf_dir):
    """Admissions with a stored date, which may differ from their log time's, filtered on that date."""
    adm = _logs(spark, sf_dir).admissions
    return in_key_window(adm, P.start_date, P.end_date).select("matching_id", "role_id", "team_elo", "pt_dt")


def point_lookup_q(spark, sf_dir):
    return point_lookup(_logs(spark, sf_dir).participants, FIXTURE_LOOKUP_BATTLEID)


def compact_dates(spark, sf_dir):
    keys = _logs(spark, sf_dir).participants.select(date_key("logtime").alias("pt_dt")).distinct()
    compact = keys.withColumn("compact", iso_to_compact("pt_dt"))
    return compact.select(
        "pt_dt",
        "compact",
        compact_to_iso("compact").alias("iso_sliced"),
        compact_to_iso_checked("compact").alias("iso_checked"),
    )


# --- aggregates --------------------------------------------------------------

def match_kill_totals_q(spark, sf_dir):
    return match_kill_totals(_logs(spark, sf_dir).participants)


def first_non_null_q(spark, sf_dir):
    return first_non_null(_logs(spark, sf_dir).participants)


def first_earliest_q(spark, sf_dir):
    return first_earliest(_logs(spark, sf_dir).participants)


def first_valid_version_q(spark, sf_dir):
    return first_valid_version(_logs(spark, sf_dir).participants)


def first_valid_ws(spark, sf_dir):
    return first_valid_version_ws(_logs(spark, sf_dir).participants)


def match_view_q(spark, sf_dir):
    lg = _logs(spark, sf_dir)
    return match_view(lg.participants, lg.matches)


def match_view_in_range(spark, sf_dir):
    lg = _logs(spark, sf_dir)
    return in_key_window(match_view(lg.participants, lg.matches), P.start_date, P.end_date)


def match_view_wide(spark, sf_dir):
    return jobs.wide_match_view(_logs(spark, sf_dir))


def incremental_match_view(spark, sf_dir):
    """The wide match view kept by batches: both logs land in three batches each, a match's rows spread over
    all of them; a batch is written twice, two are compacted, the last one arrives afterwards."""
    lg, root = _logs(spark, sf_dir), scratch_dir(spark, "match-state")
    batch = F.pmod(F.xxhash64("battleid", "modetid"), F.lit(3))
    for log in match_state.LOGS:
        rows = getattr(lg, log)
        for k in (0, 1, 1):
            match_state.write_batch_states(rows.where(batch == k), log, root, k)
        match_state.compact_states(spark, root, log)
        match_state.expire_states(spark, root, log)
        match_state.write_batch_states(rows.where(batch == 2), log, root, 2)
    return match_state.landed_match_view(spark, root)


def first_token(spark, sf_dir):
    return jobs.wide_match_view(_logs(spark, sf_dir), cut_at_comma=True)


def duplicate_audit_q(spark, sf_dir):
    rows = in_log_window(_logs(spark, sf_dir).participants, P.start_date, P.end_date)
    return duplicate_audit(rows, FIXTURE_AUDIT_COUNT)


def heavy_hitters_q(spark, sf_dir):
    """The ranks that hold more than a tenth of all participant rows."""
    return heavy_hitters(_logs(spark, sf_dir).participants, "rank_tid", 0.1)


def salted_rank_join(spark, sf_dir):
    """Participants beside the kills of all rows of their rank; the ranks with over a tenth of the rows are spread over salts."""
    rows = _logs(spark, sf_dir).participants.select("battleid", "role_id", "rank_tid", "kill")
    ranks = rows.groupBy(F.col("rank_tid").alias("r_rank")).agg(F.sum("kill").alias("rank_kills"))
    return salted_join(rows, ranks, "rank_tid", "r_rank", heavy_hitters(rows, "rank_tid", 0.1))


def drop_funnel_q(spark, sf_dir):
    return drop_funnel(passed_rules(_logs(spark, sf_dir), P))


def match_reasons_q(spark, sf_dir):
    return match_reasons(passed_rules(_logs(spark, sf_dir), P))


def monthly_matches(spark, sf_dir):
    return jobs.monthly_match_counts(_logs(spark, sf_dir), P)


def monthly_participants(spark, sf_dir):
    return jobs.monthly_participant_counts(_logs(spark, sf_dir), P)


def monthly_players(spark, sf_dir):
    return jobs.monthly_player_counts(_logs(spark, sf_dir), P)


# --- joins -------------------------------------------------------------------

def join_admissions_q(spark, sf_dir):
    return join_admissions(_qualifying_rows(spark, sf_dir), _rated_admission_rows(spark, sf_dir))


def join_match_view_q(spark, sf_dir):
    rows = join_admissions(_qualifying_rows(spark, sf_dir), _rated_admission_rows(spark, sf_dir))
    return join_match_view(rows, jobs.match_values(_logs(spark, sf_dir), P))


def expand_participants(spark, sf_dir):
    lg = _logs(spark, sf_dir)
    return jobs.expanded_participants(lg, P, jobs.eligible_matches(lg, P))


def left_join_miss(spark, sf_dir):
    """Every match of the match log with its participants' roles; a match without any keeps one row."""
    lg = _logs(spark, sf_dir)
    roles = lg.participants.select(F.col("battleid").alias("played_battleid"), "role_id", "kill")
    return left_join(lg.matches.select("battleid", "gametype"), roles, [("battleid", "played_battleid")])


def detail_stored_date(spark, sf_dir):
    """Participant detail, its ratings windowed on the stored date."""
    lg = _logs(spark, sf_dir)
    return jobs.participant_detail(lg, P, jobs.eligible_matches(lg, P), admission_window="pt_dt")


def _bucketed(spark, sf_dir, hot_rows: int):
    prefix = f"arenaflow_{uuid.uuid4().hex}"
    bucketed.land_bucketed(spark, _logs(spark, sf_dir), prefix, scratch_dir(spark, "bucketed"), 8, hot_rows)
    return bucketed.bucketed_logs(spark, prefix)


def bucketed_admissions(spark, sf_dir):
    """Qualifying participants with their ratings, over logs in buckets of the match id; matches of over six rows are kept apart."""
    def job(lg):
        qualifying = participant_projection(qualifying_participants(lg.participants, P))
        return join_admissions(qualifying, rated_admissions(lg.admissions, P.team_elo).select("matching_id", "role_id", "team_elo"))

    return bucketed.by_match(_bucketed(spark, sf_dir, 6), job)


def bucketed_detail(spark, sf_dir):
    """The participant detail over logs in buckets of the match id."""
    return bucketed.by_match(_bucketed(spark, sf_dir, 6), lambda lg: jobs.participant_detail(lg, P, jobs.eligible_matches(lg, P)))


def player_detail(spark, sf_dir):
    lg = _logs(spark, sf_dir)
    return jobs.participant_detail(lg, P, jobs.eligible_matches(lg, P))


# --- qualifying, era rule, set operations -----------------------------------

def qualified_participants(spark, sf_dir):
    return jobs.qualified_participants(_logs(spark, sf_dir), P)


def qualified_matches(spark, sf_dir):
    return jobs.qualified_matches(_logs(spark, sf_dir), P)


def version_allow_list(spark, sf_dir):
    return version_allowed(jobs.qualified_matches(_logs(spark, sf_dir), P), P.version_allow_list)


def version_allow_semi(spark, sf_dir):
    """The allow-list as a table: here the versions that the log has from v2 to v4."""
    lg = _logs(spark, sf_dir)
    listed = lg.participants.where(F.col("keyversion").between("v2", "v4")).select("keyversion").distinct()
    return version_allowed_semi(jobs.qualified_matches(lg, P), listed)


def era_rule(spark, sf_dir):
    return jobs.eligible_matches(_logs(spark, sf_dir), P)


def era_rule_reduced(spark, sf_dir):
    """The eligible matches, the participant log reduced to the candidate matches below the aggregation."""
    return jobs.eligible_matches(_logs(spark, sf_dir), P, reduce_keys=True)


def union_all_branches(spark, sf_dir):
    q = jobs.qualified_matches(_logs(spark, sf_dir), P)
    return era_rule_union(q, P.version_cutoff, P.version_allow_list, distinct=False)


def union_distinct_branches(spark, sf_dir):
    q = jobs.qualified_participants(_logs(spark, sf_dir), P)
    return era_rule_union(q, P.version_cutoff, P.version_allow_list, distinct=True)


# --- exports -----------------------------------------------------------------

def packed_matches(spark, sf_dir):
    return jobs.packed_matches(jobs.eligible_matches(_logs(spark, sf_dir), P))


def packed_participants(spark, sf_dir):
    return jobs.packed_participants(jobs.eligible_participants(_logs(spark, sf_dir), P))


def packed_players(spark, sf_dir):
    lg = _logs(spark, sf_dir)
    return jobs.packed_players(jobs.participant_detail(lg, P, jobs.eligible_matches(lg, P)))


QUERIES: dict[str, Query] = {
    "json_log_scan": json_log_scan,
    "json_odd_numbers": json_odd_numbers,
    "indexed_date_range": indexed_date_range,
    "catalog_scan": catalog_scan,
    "sink_roundtrip": sink_roundtrip,
    "export_readback": export_readback,
    "published_exports": published_exports,
    "verified_readback": verified_readback,
    "framed_sections": framed_sections,
    "framed_split_sections": framed_split_sections,
    "framed_odd_sections": framed_odd_sections,
    "participant_projection": participant_projection_q,
    "date_month_keys": date_month_keys,
    "date_range_filter": date_range_filter,
    "participant_filter": participant_filter,
    "admission_filter": admission_filter,
    "admission_window": admission_window,
    "point_lookup": point_lookup_q,
    "compact_dates": compact_dates,
    "match_kill_totals": match_kill_totals_q,
    "first_non_null": first_non_null_q,
    "first_earliest": first_earliest_q,
    "first_valid_version": first_valid_version_q,
    "first_valid_ws": first_valid_ws,
    "match_view": match_view_q,
    "match_view_in_range": match_view_in_range,
    "match_view_wide": match_view_wide,
    "incremental_match_view": incremental_match_view,
    "first_token": first_token,
    "duplicate_audit": duplicate_audit_q,
    "heavy_hitters": heavy_hitters_q,
    "salted_rank_join": salted_rank_join,
    "drop_funnel": drop_funnel_q,
    "match_reasons": match_reasons_q,
    "join_admissions": join_admissions_q,
    "join_match_view": join_match_view_q,
    "expand_participants": expand_participants,
    "left_join_miss": left_join_miss,
    "player_detail": player_detail,
    "bucketed_admissions": bucketed_admissions,
    "bucketed_detail": bucketed_detail,
    "detail_stored_date": detail_stored_date,
    "qualified_participants": qualified_participants,
    "qualified_matches": qualified_matches,
    "version_allow_list": version_allow_list,
    "version_allow_semi": version_allow_semi,
    "era_rule": era_rule,
    "era_rule_reduced": era_rule_reduced,
    "union_all_branches": union_all_branches,
    "union_distinct_branches": union_distinct_branches,
    "packed_matches": packed_matches,
    "packed_participants": packed_participants,
    "packed_players": packed_players,
    "monthly_matches": monthly_matches,
    "monthly_participants": monthly_participants,
    "monthly_players": monthly_players,
}
