"""Row filters: date windows, qualifying predicates, version allow-list and era rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.functions import date_range
from arenaflow.params import RunParams


def log_window(df: DataFrame, start: str, end: str, logtime: str = "logtime", partition_key: str | None = None):
    """Condition ``start <= substr(logtime, 1, 10) <= end`` (pushable form).

    ``partition_key`` names a date partition column that holds the date key of
    ``logtime`` by construction (logs landed by :mod:`arenaflow.streaming`); the
    same bounds on it are then added, which is exact and prunes whole date
    partitions at planning time.  Do not pass a stored date that may differ from
    the log time.
    """
    cond = date_range(logtime, start, end)
    if partition_key is not None:
        cond = cond & (F.col(partition_key) >= F.lit(start)) & (F.col(partition_key) <= F.lit(end))
    return cond


def in_log_window(
    df: DataFrame, start: str, end: str, logtime: str = "logtime", partition_key: str | None = None
) -> DataFrame:
    """Rows whose ``substr(logtime, 1, 10)`` lies in ``[start, end]`` (pushable form)."""
    return df.where(log_window(df, start, end, logtime, partition_key))


def in_key_window(df: DataFrame, start: str, end: str, key: str = "pt_dt") -> DataFrame:
    """Rows whose stored date key lies in ``[start, end]``.

    Used on aggregate output (acts as HAVING) and on a stored ``pt_dt`` column,
    where it prunes partitions when the table is laid out by that column.
    """
    return df.where((F.col(key) >= F.lit(start)) & (F.col(key) <= F.lit(end)))


def qualifying_participants(participants: DataFrame, p: RunParams, partition_key: str | None = None) -> DataFrame:
    """Participant rows that qualify a match: known match id, date in range,
    full lobby, one of the modes, the hero, and the score floor."""
    return participants.where(
        F.col("battleid").isNotNull()
        & log_window(participants, p.start_date, p.end_date, partition_key=partition_key)
        & (F.col("usernum") == F.lit(p.usernum))
        & F.col("modetid").isin(*p.modetids)
        & (F.col("herotid") == F.lit(p.hero_id))
        & (F.col("score") >= F.lit(p.score))
    )


def rated_admissions(admissions: DataFrame, min_elo: float) -> DataFrame:
    """Admissions with a team rating at or above ``min_elo``."""
    return admissions.where(F.col("team_elo") >= F.lit(min_elo))


def version_allowed(df: DataFrame, allow_list: Sequence[str], column: str = "keyversion") -> DataFrame:
    """Rows whose version is in the allow-list (``IN`` list; becomes a hash ``InSet``)."""
    return df.where(F.col(column).isin(*allow_list))


def version_allowed_semi(df: DataFrame, allowed: DataFrame | Sequence[str], column: str = "keyversion") -> DataFrame:
    """Same rows as :func:`version_allowed`, with the allow-list as a table.

    ``allowed``: a one-column table of versions, of any size (adaptive execution
    picks the join), or a list.
    """
    if not isinstance(allowed, DataFrame):
        schema = T.StructType([T.StructField("allowed", T.StringType())])
        allowed = df.sparkSession.createDataFrame([(v,) for v in dict.fromkeys(allowed)], schema)
    allowed = allowed.select(F.col(allowed.columns[0]).alias("_allowed"))
    return df.join(allowed, F.col(column) == F.col("_allowed"), "left_semi")


def era_rule(
    df: DataFrame,
    cutoff: str,
    allow_list: Sequence[str],
    date_col: str = "pt_dt",
    version_col: str = "keyversion",
) -> DataFrame:
    """Before ``cutoff`` keep only allow-listed versions; from ``cutoff`` on keep all.

    One filter instead of two filtered scans and a union: the branches are
    disjoint by date, so the rows are the same, and NULL dates or (before the
    cutoff) NULL versions fail both branches as they do in the union form.
    """
    d = F.col(date_col)
    early = (d < F.lit(cutoff)) & F.col(version_col).isin(*allow_list)
    return df.where(early | (d >= F.lit(cutoff)))


def era_rule_union(
    df: DataFrame,
    cutoff: str,
    allow_list: Sequence[str],
    distinct: bool = False,
    date_col: str = "pt_dt",
    version_col: str = "keyversion",
) -> DataFrame:
    """The era rule in its two-branch form (``UNION ALL``, or ``UNION`` when ``distinct``)."""
    from arenaflow.operators.setops import union_all, union_distinct

    d = F.col(date_col)
    early = df.where((d < F.lit(cutoff)) & F.col(version_col).isin(*allow_list))
    late = df.where(d >= F.lit(cutoff))
    return union_distinct(early, late) if distinct else union_all(early, late)


def point_lookup(df: DataFrame, battleid: int, role_id: int | None = None, distinct: bool = True) -> DataFrame:
    """Diagnostic lookup of one match (and optionally one role); distinct whole rows."""
    cond = F.col("battleid") == F.lit(int(battleid))
    if role_id is not None:
        cond = cond & (F.col("role_id") == F.lit(int(role_id)))
    out = df.where(cond)
    return out.distinct() if distinct else out
