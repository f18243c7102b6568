"""The extraction jobs as lazy DataFrame plans.

* match export: qualifying matches (match x date grain) after the era rule,
  5-field records keyed by date;
* participant export: qualifying participants after the era rule, 28-field records;
* participant detail: every participant of an eligible match, 24-field records;
* monthly QA counts of the match and detail records;
* the wide consolidated match view.

Nothing is collected to the driver; each function returns a DataFrame and the
caller decides the action (a sink write, a count, a comparison).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenaflow.functions import date_key, month_key, pack_record
from arenaflow.operators.aggregates import TOTAL_FIELDS, match_view, monthly_counts
from arenaflow.operators.filters import (
    era_rule,
    in_key_window,
    in_log_window,
    qualifying_participants,
    rated_admissions,
)
from arenaflow.operators.joins import admitted_keys, join_admissions, join_match_view, left_join, match_join
from arenaflow.operators.keys import key_bitmap, maybe_among
from arenaflow.operators.projections import PARTICIPANT_FIELDS, participant_columns, participant_projection
from arenaflow.operators.sizing import materialize_at, remove_folder
from arenaflow.params import RunParams
from arenaflow.sources.logs import Logs

# Export record layouts, in field order.
MATCH_RECORD = ("battleid", "keyversion", *TOTAL_FIELDS)
PARTICIPANT_RECORD = (
    "battleid", "role_id", "keyversion", *PARTICIPANT_FIELDS[2:], "team_elo", *TOTAL_FIELDS,
)
DETAIL_RECORD = (*PARTICIPANT_FIELDS, "team_elo")
QUALIFIED_MATCH_COLUMNS = ("pt_dt", "pt_dt_date", "battleid", "keyversion", *TOTAL_FIELDS)

# Whether the qualifying jobs reduce the participant log to the candidate matches before aggregating it, unless told.
REDUCE_KEYS = False


def match_values(logs: Logs, p: RunParams, with_match_log: bool = False, candidates: DataFrame | None = None) -> DataFrame:
    """Per-match values of the consolidated view whose date lies in the run range.

    The match log only contributes matches without participant rows, whose date
    is NULL and fails the range test, so it is skipped unless asked for; NULL
    match ids are dropped before the shuffle (they cannot join).

    ``candidates`` (with a column ``battleid``) are the matches that the caller will keep: rows of
    other matches are dropped below the aggregation by a bitmap of bounded size, whole groups at a
    time, so that only the candidates (and a few others) are aggregated and shuffled.  The
    caller's join with the candidates makes the result exact.
    """
    participants, matches = logs.participants, logs.matches if with_match_log else None
    if candidates is not None:
        bitmap = key_bitmap(candidates, "battleid")
        participants = maybe_among(participants, bitmap, "battleid")
        matches = maybe_among(matches, bitmap, "battleid") if matches is not None else None
    return in_key_window(match_view(participants, matches, drop_null_ids=True), p.start_date, p.end_date)


def qualified_matches(logs: Logs, p: RunParams, with_match_log: bool = False, reduce_keys: bool = REDUCE_KEYS) -> DataFrame:
    """Distinct (date, match) pairs with a qualifying, admitted, rated participant,
    with the match's version and kill totals.

    The grain is match x date of the qualifying participant row.  The rating and
    role are not output, so the admission join is a semi join, and since the
    match values depend on the match id alone the DISTINCT runs on the two keys
    before the join with the view.  The view is aggregated over the
    participant log with a map-side partial step (about one shuffled row per match), with
    ``reduce_keys`` over the rows of the candidate matches alone (see :func:`match_values`).
    """
    qualifying = qualifying_participants(logs.participants, p, logs.partition_key).select(
        date_key("logtime").alias("pt_dt"), "role_id", "battleid"
    )
    rated_adm = rated_admissions(logs.admissions, p.team_elo)
    keys = admitted_keys(qualifying, rated_adm).select("pt_dt", "battleid").distinct()
    out = join_match_view(keys, match_values(logs, p, with_match_log, keys if reduce_keys else None))
    return out.withColumn("pt_dt_date", month_key("pt_dt")).select(*QUALIFIED_MATCH_COLUMNS)


def qualified_participants(logs: Logs, p: RunParams, with_match_log: bool = False, reduce_keys: bool = REDUCE_KEYS) -> DataFrame:
    """Distinct qualifying participant rows with rating and match values.

    A role admitted twice with different ratings gives two rows; exact
    duplicates collapse.
    """
    qualifying = participant_projection(qualifying_participants(logs.participants, p, logs.partition_key))
    rated_adm = rated_admissions(logs.admissions, p.team_elo)
    rated = join_admissions(qualifying, rated_adm).distinct()
    out = join_match_view(rated, match_values(logs, p, with_match_log, rated if reduce_keys else None))
    return out.select(
        "pt_dt", *PARTICIPANT_FIELDS, month_key("pt_dt").alias("pt_dt_date"), "team_elo",
        "keyversion", *TOTAL_FIELDS,
    )


def eligible_matches(logs: Logs, p: RunParams, reduce_keys: bool = REDUCE_KEYS) -> DataFrame:
    """Qualified matches that pass the version-era rule."""
    return era_rule(qualified_matches(logs, p, reduce_keys=reduce_keys), p.version_cutoff, p.version_allow_list)


def eligible_participants(logs: Logs, p: RunParams, reduce_keys: bool = REDUCE_KEYS) -> DataFrame:
    """Qualified participants that pass the version-era rule."""
    return era_rule(qualified_participants(logs, p, reduce_keys=reduce_keys), p.version_cutoff, p.version_allow_list)


def packed_matches(eligible: DataFrame) -> DataFrame:
    """``(pt_dt, battle_info)`` 5-field match records."""
    return eligible.select("pt_dt", pack_record(eligible, MATCH_RECORD).alias("battle_info"))


def packed_participants(eligible_rows: DataFrame) -> DataFrame:
    """``(pt_dt, battle_info)`` 28-field participant records."""
    return eligible_rows.select("pt_dt", pack_record(eligible_rows, PARTICIPANT_RECORD).alias("battle_info"))


def _played(logs: Logs, p: RunParams) -> DataFrame:
    """Participant rows in the date range, the match id as ``played_battleid``."""
    rows = in_log_window(logs.participants, p.start_date, p.end_date, partition_key=logs.partition_key)
    return rows.select(F.col("battleid").alias("played_battleid"), *participant_columns(exclude=("battleid",)))


def expanded_participants(logs: Logs, p: RunParams, eligible: DataFrame) -> DataFrame:
    """Each eligible (date, match) pair with every participant row of the match in the date range.

    ``eligible`` comes from :func:`eligible_matches` of the same logs and run, so
    the participant row that made a match eligible is itself in the date range
    and the left join of the definition never misses: it is written as an inner
    join, which cuts the participant rows to the eligible matches first and lets
    adaptive execution split a hot match on either side.

    Output: ``pt_dt``, ``battleid`` of the eligible side, ``played_battleid`` and the
    participant fields of the joined row.
    """
    # The pairs come out of a join on the match id; dealing them anew makes this join shuffle
    # both sides itself, which adaptive execution needs to split a hot match (or to broadcast them).
    pairs = eligible.select("pt_dt", "battleid")
    if not logs.co_partitioned:
        pairs = pairs.hint("rebalance")
    return match_join(pairs, _played(logs, p), [("battleid", "played_battleid")])


def participant_detail(logs: Logs, p: RunParams, eligible: DataFrame, admission_window: str = "logtime") -> DataFrame:
    """Every participant row (in the date range) of every eligible match, with
    the role's rating (admissions in the date range), keyed by the match's
    qualifying date.

    The participant rows are cut to the eligible matches (see
    :func:`expanded_participants`) before the left join with the ratings, which
    is keyed on (match, role), so a hot match spreads over its roles.
    Duplicates multiply (bag semantics).  The plan is the same at every size.

    ``admission_window="pt_dt"`` is the warehouse dialect: admissions are
    windowed on their stored date column (which may differ from the date of
    ``logtime``) instead of on ``logtime``.
    """
    if admission_window == "logtime":
        adm = in_log_window(logs.admissions, p.start_date, p.end_date, partition_key=logs.partition_key)
    elif admission_window == "pt_dt":
        adm = in_key_window(logs.admissions, p.start_date, p.end_date, "pt_dt")
    else:
        raise ValueError(f"admission_window must be 'logtime' or 'pt_dt', not {admission_window!r}")
    ratings = adm.select(F.col("matching_id"), F.col("role_id").alias("rated_role_id"), F.col("team_elo"))
    rows = left_join(expanded_participants(logs, p, eligible), ratings, [("played_battleid", "matching_id"), ("role_id", "rated_role_id")])
    return rows.select("pt_dt", *DETAIL_RECORD)


def packed_players(detail: DataFrame) -> DataFrame:
    """``(pt_dt, battle_info)`` 24-field participant-detail records."""
    return detail.select("pt_dt", pack_record(detail, DETAIL_RECORD).alias("battle_info"))


def monthly_match_counts(logs: Logs, p: RunParams) -> DataFrame:
    return monthly_counts(packed_matches(eligible_matches(logs, p)))


def monthly_player_counts(logs: Logs, p: RunParams) -> DataFrame:
    return monthly_counts(packed_players(participant_detail(logs, p, eligible_matches(logs, p))))


def monthly_participant_counts(logs: Logs, p: RunParams) -> DataFrame:
    """Eligible participants per month, each (month, match, role, version) counted once."""
    rows = eligible_participants(logs, p).select("pt_dt_date", "battleid", "role_id", "keyversion").distinct()
    return rows.groupBy("pt_dt_date").agg(F.count(F.lit(1)).alias("record_count"))


def wide_match_view(logs: Logs, cut_at_comma: bool = False) -> DataFrame:
    """All match-log attributes plus the participant aggregates, one row per match."""
    return match_view(logs.participants, logs.matches, wide=True, cut_at_comma=cut_at_comma)


@dataclass(frozen=True)
class ExportPaths:
    battle_info: str
    player_info: str


def run_match_exports(logs: Logs, p: RunParams, root: str, **sink_options) -> ExportPaths:
    """Writes the match records and the participant-detail records.

    The eligible set feeds both exports; it is written once to the shared
    checkpoint folder (surviving the loss of any executor) instead of being
    recomputed from the logs by the second write.
    """
    from arenaflow.sources.exports import write_keyed_text

    eligible, folder = materialize_at(eligible_matches(logs, p), "eligible")
    try:
        paths = ExportPaths(p.export_path(root, "battle_info"), p.export_path(root, "player_info"))
        write_keyed_text(packed_matches(eligible), paths.battle_info, **sink_options)
        detail = participant_detail(logs, p, eligible)
        write_keyed_text(packed_players(detail), paths.player_info, **sink_options)
        return paths
    finally:
        remove_folder(eligible.sparkSession, folder)


def publish_match_exports(logs: Logs, p: RunParams, root: str, **sink_options) -> dict:
    """:func:`run_match_exports` as one publication: readers get both new exports or both old ones.

    Returns the manifest (see :mod:`arenaflow.sources.publication`).
    """
    from arenaflow.sources.publication import publish

    eligible, folder = materialize_at(eligible_matches(logs, p), "eligible")
    try:
        records = {
            "battle_info": lambda: packed_matches(eligible),
            "player_info": lambda: packed_players(participant_detail(logs, p, eligible)),
        }
        return publish(eligible.sparkSession, p, root, records, **sink_options)
    finally:
        remove_folder(eligible.sparkSession, folder)


def run_participant_export(logs: Logs, p: RunParams, root: str, **sink_options) -> str:
    """Writes the 28-field participant records (ISO dates in the path)."""
    from arenaflow.sources.exports import write_keyed_text

    path = p.export_path(root, "battle_total", compact=False)
    write_keyed_text(packed_participants(eligible_participants(logs, p)), path, **sink_options)
    return path
