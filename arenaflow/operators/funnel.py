"""Why a participant row, or a match, is not in the export.

Every rule that a row must pass on the way to the match export is one bit of a mask, worked out for all rows at
once: the rules of the row itself, whether its role was admitted and rated, and the rules of its match (date of the
match, version era).  Nothing is filtered, so no row is lost on the way, and the masks of one pass answer every
question: the first rule that a row fails, all rules that it fails, how far the rows of a match got.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenaflow.functions import date_key, month_key
from arenaflow.operators.aggregates import match_view
from arenaflow.operators.filters import log_window
from arenaflow.params import RunParams
from arenaflow.sources.logs import Logs

# The rules in the order of the job; a rule's bit is its place.
RULES = ("match_id", "date", "lobby", "mode", "hero", "score", "admitted", "rated", "match_date", "version")
KEPT = "kept"
ALL = (1 << len(RULES)) - 1


def _mask(conditions: dict[str, Column]) -> Column:
    """One bit for every rule whose condition holds; NULL is not passed."""
    mask = F.lit(0)
    for place, rule in enumerate(RULES):
        mask = mask.bitwiseOR(F.when(conditions[rule], F.lit(1 << place)).otherwise(F.lit(0)))
    return mask


def passed_rules(logs: Logs, p: RunParams) -> DataFrame:
    """Every participant row as ``pt_dt``, ``battleid``, ``role_id``, ``passed`` (the mask of the rules it passes).

    The admissions come as one row a (match, role) and the view as one row a match, so both left joins
    keep the rows as they are; their aggregations combine map-side.  Rows without a match id join nothing and
    stay out of the joins, where they would all meet in one task.
    """
    seats = logs.admissions.where(F.col("matching_id").isNotNull() & F.col("role_id").isNotNull()).groupBy(
        F.col("matching_id").alias("_match"), F.col("role_id").alias("_role")
    ).agg(F.max("team_elo").alias("_elo"))
    view = match_view(logs.participants, drop_null_ids=True).select(F.col("battleid").alias("_id"), F.col("pt_dt").alias("_day"), F.col("keyversion").alias("_version"))
    rows = logs.participants
    own = {
        "match_id": F.col("battleid").isNotNull(),
        "date": log_window(rows, p.start_date, p.end_date),
        "lobby": F.col("usernum") == p.usernum,
        "mode": F.col("modetid").isin(*p.modetids),
        "hero": F.col("herotid") == p.hero_id,
        "score": F.col("score") >= p.score,
    }
    rows = rows.select(date_key("logtime").alias("pt_dt"), "battleid", "role_id", *(c.alias(f"_{rule}_ok") for rule, c in own.items()))
    lost, rows = rows.where(F.col("battleid").isNull()), rows.where(F.col("battleid").isNotNull())
    rows = rows.join(seats, (F.col("battleid") == F.col("_match")) & (F.col("role_id") == F.col("_role")), "left")
    rows = rows.join(view, F.col("battleid") == F.col("_id"), "left")
    later = {
        "admitted": F.col("_match").isNotNull(),
        "rated": F.col("_elo") >= p.team_elo,
        "match_date": (F.col("_day") >= p.start_date) & (F.col("_day") <= p.end_date),
        "version": (F.col("pt_dt") >= p.version_cutoff) | F.col("_version").isin(*p.version_allow_list),
    }
    first = {rule: F.col(f"_{rule}_ok") for rule in own}
    known, unknown = _mask(first | later), _mask(first | dict.fromkeys(later, F.lit(False)))
    return rows.select("pt_dt", "battleid", "role_id", known.alias("passed")).unionAll(lost.select("pt_dt", "battleid", "role_id", unknown.alias("passed")))


def first_failed(passed: Column) -> Column:
    """The first rule that a mask lacks, ``kept`` if it lacks none."""
    reason = F.lit(KEPT)
    for place, rule in reversed(list(enumerate(RULES))):
        reason = F.when(passed.bitwiseAND(F.lit(1 << place)) == 0, F.lit(rule)).otherwise(reason)
    return reason


def failed_rules(passed: Column) -> Column:
    """All rules that a mask lacks, as an array of names."""
    return F.array_compact(F.array(*(F.when(passed.bitwiseAND(F.lit(1 << k)) == 0, F.lit(rule)) for k, rule in enumerate(RULES))))


def drop_funnel(masks: DataFrame) -> DataFrame:
    """``pt_dt_date``, ``reason``, ``row_count``: the rows of every month by the first rule they fail.

    The counts add up to all rows.  ``masks`` comes from :func:`passed_rules`.
    """
    return masks.groupBy(month_key("pt_dt").alias("pt_dt_date"), first_failed(F.col("passed")).alias("reason")).agg(F.count(F.lit(1)).alias("row_count"))


def match_reasons(masks: DataFrame) -> DataFrame:
    """``battleid``, ``row_count``, ``kept_rows``, ``furthest`` (the rule at which its best row fails, or ``kept``),
    ``never_passed`` (rules that no row of the match passes, comma-joined): one row a match with an id.

    Bounded state a match (``bit_or``, ``max``), combined map-side.
    """
    steps = F.lit(len(RULES))
    for place in reversed(range(len(RULES))):
        steps = F.when(F.col("passed").bitwiseAND(F.lit(1 << place)) == 0, F.lit(place)).otherwise(steps)
    per_match = masks.where(F.col("battleid").isNotNull()).select("battleid", "passed", steps.alias("_steps")).groupBy("battleid").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("passed") == ALL).alias("kept_rows"),
        F.max("_steps").alias("_steps"),
        F.bit_or("passed").alias("_any"),
    )
    names = F.array(*(F.lit(n) for n in (*RULES, KEPT)))
    return per_match.select(
        "battleid", "row_count", "kept_rows", F.get(names, F.col("_steps")).alias("furthest"), F.array_join(failed_rules(F.col("_any")), ",").alias("never_passed")
    )
