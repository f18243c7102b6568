"""Tiny hand-written logs for the operator tests."""

from __future__ import annotations

from arenaflow.schemas import ADMISSIONS, MATCHES, PARTICIPANTS
from arenaflow.sources.logs import Logs


def participant(battleid, role_id, logtime, **kw):
    row = {f.name: None for f in PARTICIPANTS.fields}
    row.update(
        battleid=battleid, role_id=role_id, logtime=logtime, usernum=10, modetid=1, herotid=3, score=5,
        factionid=1, kill=1, keyversion="v1",
    )
    row.update(kw)
    return tuple(row[f.name] for f in PARTICIPANTS.fields)


def match(battleid, **kw):
    row = {f.name: None for f in MATCHES.fields}
    row.update(battleid=battleid)
    row.update(kw)
    return tuple(row[f.name] for f in MATCHES.fields)


def admission(matching_id, role_id, team_elo, logtime="2021-03-01 10:00:00"):
    return (matching_id, role_id, team_elo, logtime)


def logs(spark, participants=(), matches=(), admissions=()) -> Logs:
    return Logs(
        spark.createDataFrame(list(participants), PARTICIPANTS),
        spark.createDataFrame(list(matches), MATCHES),
        spark.createDataFrame(list(admissions), ADMISSIONS),
    )


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
