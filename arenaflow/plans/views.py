"""SQL access: the job steps as temporary views, the column rules as SQL functions.

For users who write Spark SQL against named views.  The functions are SQL
user-defined functions, which Spark inlines as ordinary expressions (no Python
at run time); each mirrors a Column builder of :mod:`arenaflow.functions`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from arenaflow.functions.columns import NULL_SPELLINGS, python_whitespace_class
from arenaflow.operators import match_view
from arenaflow.params import RunParams
from arenaflow.plans import jobs
from arenaflow.sources.logs import Logs


def _spellings() -> str:
    return ", ".join(f"'{s}'" for s in NULL_SPELLINGS)


def sql_functions() -> dict[str, str]:
    ws = python_whitespace_class()
    return {
        "date_key": "(logtime STRING) RETURNS STRING RETURN substr(logtime, 1, 10)",
        "month_key": "(pt_dt STRING) RETURNS STRING RETURN substr(pt_dt, 1, 7)",
        "valid_version": (
            f"(kv STRING) RETURNS STRING RETURN CASE WHEN trim(kv) NOT IN ('', {_spellings()}) THEN kv END"
        ),
        "valid_version_ws": (
            "(kv STRING) RETURNS STRING RETURN CASE WHEN kv IS NULL OR kv = '' "
            f"OR kv RLIKE r'^{ws}+$' "
            f"OR regexp_replace(kv, r'^{ws}+|{ws}+$', '') IN ({_spellings()}) THEN NULL ELSE kv END"
        ),
        "compact_to_iso": (
            "(s STRING) RETURNS STRING RETURN concat_ws('-', substr(s, 1, 4), substr(s, 5, 2), substr(s, 7, 2))"
        ),
        "iso_to_compact": "(s STRING) RETURNS STRING RETURN replace(s, '-', '')",
    }


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Creates the SQL functions as temporary functions; returns their names."""
    names = []
    for name, body in sql_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}{body}")
        names.append(prefix + name)
    return names


def register_views(spark: SparkSession, logs: Logs, p: RunParams, prefix: str = "") -> list[str]:
    """Registers the logs and every job step as temporary views (lazy plans,
    nothing is computed or cached here); returns the view names."""
    eligible = jobs.eligible_matches(logs, p)
    views = {
        "participants": logs.participants,
        "matches": logs.matches,
        "admissions": logs.admissions,
        "match_view": match_view(logs.participants, logs.matches),
        "match_view_wide": jobs.wide_match_view(logs),
        "qualified_participants": jobs.qualified_participants(logs, p),
        "qualified_matches": jobs.qualified_matches(logs, p),
        "eligible_participants": jobs.eligible_participants(logs, p),
        "eligible_matches": eligible,
        "packed_matches": jobs.packed_matches(eligible),
        "participant_detail": (detail := jobs.participant_detail(logs, p, eligible)),
        "packed_players": jobs.packed_players(detail),
        "packed_participants": jobs.packed_participants(jobs.eligible_participants(logs, p)),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
