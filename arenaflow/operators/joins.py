"""Equi-joins of the qualifying step and the participant detail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cond(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]):
    cond = None
    for lk, rk in pairs:
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return cond


def left_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``left LEFT JOIN right`` on equal key pairs; output columns of both sides.

    Column names of the two sides must not clash.  Adaptive execution splits a
    hot key of the left (preserved) side only; where a right key can hold a large share of the
    rows and no left row can miss, use :func:`match_join`.
    """
    return left.join(right, _cond(left, right, pairs), "left")


def match_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Inner join on equal key pairs: adaptive execution may split a hot key of
    either side, and may broadcast the smaller one."""
    return left.join(right, _cond(left, right, pairs), "inner")


def join_admissions(qualifying: DataFrame, admissions: DataFrame) -> DataFrame:
    """Qualifying participant rows with their admission rating.

    Inner join on (match id, role id); bag semantics, so duplicated admissions
    multiply rows.  Adds ``team_elo``.
    """
    a = admissions.select(
        F.col("matching_id").alias("_a_match"), F.col("role_id").alias("_a_role"), F.col("team_elo")
    )
    out = qualifying.join(
        a, (qualifying["battleid"] == a["_a_match"]) & (qualifying["role_id"] == a["_a_role"]), "inner"
    )
    return out.drop("_a_match", "_a_role")


def admitted_keys(qualifying: DataFrame, admissions: DataFrame) -> DataFrame:
    """Qualifying rows that have at least one admission (semi join, no fan-out).

    Equals :func:`join_admissions` followed by a projection that drops the
    rating and a DISTINCT, for a fraction of the work.
    """
    # De-duplicated keys: partial aggregation collapses a hot (match, role) pair
    # map-side, and the shuffle it needs is the one the join needs.
    a = admissions.select(F.col("matching_id").alias("_a_match"), F.col("role_id").alias("_a_role")).distinct()
    return qualifying.join(
        a, (qualifying["battleid"] == a["_a_match"]) & (qualifying["role_id"] == a["_a_role"]), "left_semi"
    )


def join_match_view(rows: DataFrame, view: DataFrame) -> DataFrame:
    """Rows joined with the per-match values of the consolidated view (inner, on the match id)."""
    v = view.select(
        "battleid", "keyversion", "faction_1_total_kill", "faction_2_total_kill", "faction_total_kill"
    )
    return rows.join(v, "battleid", "inner")
