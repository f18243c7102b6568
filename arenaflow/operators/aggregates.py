"""Per-match aggregates and QA counts.

Every aggregate here has bounded per-group state (``min``/``sum``/``count``)
and therefore a map-side partial step: a match (or a date) that holds a large
share of all rows is collapsed before the shuffle instead of being buffered as
a list in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.functions import date_key, first_valid, month_key, number_text, plain_decimal, valid_version, valid_version_ws
from arenaflow.schemas import MATCH_ATTRIBUTES

# Consolidated match record (per-match fields from the participant log).
MATCH_FIELDS = ("pt_dt", "keyversion", "faction_1_total_kill", "faction_2_total_kill", "faction_total_kill")
TOTAL_FIELDS = MATCH_FIELDS[2:]


def _side_kill(side: int) -> Column:
    # NULL side counts as "not this side" (0), a NULL kill is skipped by sum.
    return F.when(F.col("factionid") == F.lit(side), F.col("kill")).otherwise(F.lit(0))


def match_kill_totals(participants: DataFrame) -> DataFrame:
    """Kill totals per match: side 1, side 2 and all sides (NULL match ids form a group)."""
    return participants.groupBy("battleid").agg(
        F.sum(_side_kill(1)).alias("faction_1_total_kill"),
        F.sum(_side_kill(2)).alias("faction_2_total_kill"),
        F.sum("kill").alias("faction_total_kill"),
    )


def first_non_null(participants: DataFrame) -> DataFrame:
    """First non-NULL date key and raw version per match (``min`` as the stable choice)."""
    return participants.groupBy("battleid").agg(
        first_valid(date_key("logtime")).alias("pt_dt"),
        first_valid(F.col("keyversion")).alias("keyversion"),
    )


def first_earliest(participants: DataFrame) -> DataFrame:
    """First non-NULL date key and first usable version per match, taken as the one with the earliest log time.

    The other reading of "first in the group".  Of equal log times the smaller value counts, a
    row without a log time comes after all others.  Bounded state (the least pair), combined map-side.
    """
    def earliest(value: Column) -> Column:
        undated = F.col("logtime").isNull()
        return F.min(F.when(value.isNotNull(), F.struct(undated.alias("undated"), F.col("logtime"), value.alias("value"))))["value"]

    return participants.groupBy("battleid").agg(
        earliest(date_key("logtime")).alias("pt_dt"), earliest(valid_version("keyversion")).alias("keyversion")
    )


def first_valid_version(participants: DataFrame) -> DataFrame:
    """First usable version per match: blank and null-spelled values count as missing."""
    return participants.groupBy("battleid").agg(first_valid(valid_version("keyversion")).alias("keyversion"))


def first_valid_version_ws(participants: DataFrame) -> DataFrame:
    """Stricter variant: any white-space-only text is missing too, and the null
    spellings are tested after stripping all white space."""
    return participants.groupBy("battleid").agg(first_valid(valid_version_ws("keyversion")).alias("keyversion"))


# Inputs of the per-match aggregates of a participant row; the totals among them.
_KEYS, _TOTALS = ("_dt", "_kv"), ("_k1", "_k2", "_kt")


def _participant_side(participants: DataFrame, marked: bool) -> list[Column]:
    """Per-row inputs of the participant aggregates.

    ``marked`` rows come from the participant log; rows of the match log carry
    NULL in every input, so they never change a ``min`` and leave a total NULL
    when a match has no participant row at all.
    """
    if marked:
        values = (date_key("logtime"), valid_version("keyversion"), _side_kill(1), _side_kill(2), F.col("kill"))
    else:
        values = (F.lit(None).cast(t) for t in ("string", "string", "bigint", "bigint", "bigint"))
    return [v.alias(n) for v, n in zip(values, (*_KEYS, *_TOTALS), strict=True)]


def _is_double(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.DoubleType)


def _total_state(c: str, fractional: bool) -> list[Column]:
    """The mergeable state of the sum of an input.

    Integers: their sum.  Doubles: sums in decimals, which no order of the rows can change; ``_fits``
    tells whether 18 digits after the point held every value and the sum, ``_whole_fits`` whether 38
    digits did.
    """
    if not fractional:
        return [F.sum(c).alias(c)]
    part, whole = F.col(c).try_cast("decimal(38,18)"), F.col(c).try_cast("decimal(38,0)")
    none = F.count(c) == 0
    return [
        F.sum(c).alias(c),
        F.try_sum(part).alias(f"{c}_part"),
        (none | (F.bool_and(F.coalesce(part.cast("double") == F.col(c), F.col(c).isNull())) & F.try_sum(part).isNotNull())).alias(f"{c}_fits"),
        F.try_sum(whole).alias(f"{c}_whole"),
        (none | ((F.count(whole) == F.count(c)) & F.try_sum(whole).isNotNull())).alias(f"{c}_whole_fits"),
    ]


def _merged_total(c: str, fractional: bool) -> list[Column]:
    if not fractional:
        return [F.sum(c).alias(c)]
    merged = [F.sum(c).alias(c)]
    for kind in ("part", "whole"):
        value, fits = f"{c}_{kind}", f"{c}_fits" if kind == "part" else f"{c}_whole_fits"
        total = F.try_sum(value)
        merged += [total.alias(value), (F.bool_and(fits) & (total.isNotNull() | (F.count(value) == 0))).alias(fits)]
    return merged


def _total_text(c: str, fractional: bool) -> Column:
    """Text of a total.  Only where a value or the sum passes 38 digits does it come from a sum of doubles,
    whose last digits may follow the order of the rows."""
    if not fractional:
        return F.col(c).cast("string")
    return (
        F.when(F.col(f"{c}_fits"), plain_decimal(f"{c}_part", 18))
        .when(F.col(f"{c}_whole_fits"), plain_decimal(f"{c}_whole", 0))
        .otherwise(number_text(c))
    )


def match_states(participants: DataFrame | None, matches: DataFrame | None = None, wide: bool = False, as_text: bool = False) -> DataFrame:
    """One row per match of the rows given: the mergeable state of every value of the
    consolidated view (minima, sums), see :func:`merged_states` and :func:`view_of_states`.

    Written as a single aggregation over the union of the raw rows of both logs (one shuffle, partial
    aggregation map-side); the match-log rows add only NULL inputs.  ``as_text``
    takes the minima in text order (the dialect that cuts at a comma).
    """
    if wide and matches is None:
        raise ValueError("the wide view needs the match log")
    attr_types = {f.name: f.dataType for f in matches.schema.fields} if wide else {}
    attributes = MATCH_ATTRIBUTES if wide else ()
    rows, fractional = None, False
    if participants is not None:
        rows = participants.select("battleid", *_participant_side(participants, True), *(F.lit(None).cast(attr_types[a]).alias(a) for a in attributes))
        fractional = _is_double(participants, "kill")
    if matches is not None:
        own = matches.select("battleid", *_participant_side(matches, False), *attributes)
        rows = own if rows is None else rows.unionByName(own)

    def pick(c: str) -> Column:
        return first_valid(F.col(c).cast("string") if as_text else F.col(c)).alias(c)

    totals = [state for c in _TOTALS for state in _total_state(c, fractional)]
    return rows.groupBy("battleid").agg(*map(pick, (*_KEYS, *attributes)), *totals)


def _state_kind(states: DataFrame) -> tuple[list[str], bool]:
    """The match attributes among the columns of states, and whether their totals are fractional."""
    return [a for a in MATCH_ATTRIBUTES if a in states.columns], f"{_TOTALS[0]}_part" in states.columns


def merged_states(states: DataFrame) -> DataFrame:
    """States of several parts of the logs as one state per match, whatever the parts and their order."""
    attributes, fractional = _state_kind(states)
    totals = [merged for c in _TOTALS for merged in _merged_total(c, fractional)]
    return states.groupBy("battleid").agg(*(F.min(c).alias(c) for c in (*_KEYS, *attributes)), *totals)


def view_of_states(states: DataFrame, cut_at_comma: bool = False) -> DataFrame:
    """The consolidated view, every value as text, of states that are one per match."""
    attributes, fractional = _state_kind(states)

    def text(c: str) -> Column:
        value = F.col(c).cast("string")
        return F.split_part(value, F.lit(","), F.lit(1)) if cut_at_comma else value

    return states.select(
        "battleid",
        text("_dt").alias("pt_dt"),
        *(text(a).alias(a) for a in attributes),
        text("_kv").alias("keyversion"),
        *(_total_text(c, fractional).alias(name) for c, name in zip(_TOTALS, TOTAL_FIELDS, strict=True)),
    )


def match_view(
    participants: DataFrame,
    matches: DataFrame | None = None,
    wide: bool = False,
    cut_at_comma: bool = False,
    drop_null_ids: bool = False,
) -> DataFrame:
    """One row per match: the union of the match log and the per-match
    aggregates of the participant log, every value as text.

    A single aggregation over the raw rows of both logs (:func:`match_states`) instead of
    aggregate -> union -> aggregate; each value equals the first non-NULL value of the two-level form.

    ``wide`` adds the match-log attributes.  ``cut_at_comma`` applies the other
    dialect's string aggregation, which keeps only the text before the first
    comma (values are then chosen in text order).  ``matches=None`` skips the
    match log: when the view is filtered on its date afterwards this is exact,
    because a match known only to the match log has a NULL date.
    ``drop_null_ids`` removes the NULL match id group before the shuffle.
    """
    if drop_null_ids:
        participants = participants.where(F.col("battleid").isNotNull())
        matches = matches.where(F.col("battleid").isNotNull()) if matches is not None else None
    return view_of_states(match_states(participants, matches, wide, as_text=cut_at_comma), cut_at_comma)


def monthly_counts(df: DataFrame, date_col: str = "pt_dt") -> DataFrame:
    """Record count per month key (``yyyy-MM``) of a date column."""
    return df.groupBy(month_key(date_col).alias("pt_dt_date")).agg(F.count(F.lit(1)).alias("record_count"))


def duplicate_audit(df: DataFrame, count: int, key: str = "battleid") -> DataFrame:
    """Match ids with exactly ``count`` rows (finds duplicated participant rows)."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") == F.lit(int(count)))
    )
