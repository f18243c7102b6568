"""One ``DataFrame -> DataFrame`` function per inventory operator."""

from arenaflow.operators.aggregates import (
    duplicate_audit,
    first_earliest,
    first_non_null,
    first_valid_version,
    first_valid_version_ws,
    match_kill_totals,
    match_view,
    monthly_counts,
)
from arenaflow.operators.filters import (
    era_rule,
    era_rule_union,
    in_key_window,
    in_log_window,
    point_lookup,
    qualifying_participants,
    rated_admissions,
    version_allowed,
    version_allowed_semi,
)
from arenaflow.operators.joins import admitted_keys, join_admissions, join_match_view, left_join, match_join
from arenaflow.operators.projections import participant_projection
from arenaflow.operators.setops import union_all, union_distinct

__all__ = [
    "admitted_keys",
    "duplicate_audit",
    "era_rule",
    "era_rule_union",
    "first_earliest",
    "first_non_null",
    "first_valid_version",
    "first_valid_version_ws",
    "in_key_window",
    "in_log_window",
    "join_admissions",
    "join_match_view",
    "left_join",
    "match_join",
    "match_kill_totals",
    "match_view",
    "monthly_counts",
    "participant_projection",
    "point_lookup",
    "qualifying_participants",
    "rated_admissions",
    "union_all",
    "union_distinct",
    "version_allowed",
    "version_allowed_semi",
]
