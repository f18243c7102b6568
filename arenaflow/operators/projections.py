"""Participant projections shared by the exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenaflow.functions import date_key

# Participant record layout (positions matter in the exports).
# "continuekill" and "doublekill" are constant empty fields, never read from the log.
PARTICIPANT_FIELDS = (
    "battleid", "role_id", "gold", "score", "kill", "death", "assist", "rank_tid",
    "continuekill", "towerkill", "creepkill", "dmgtohero", "dmgtotower", "dmgreceived",
    "magdmgreceived", "doublekill", "triblekill", "quadrakill", "pentakill", "healingtohero",
    "herotid", "modetid", "usernum",
)
CONSTANT_EMPTY_FIELDS = ("continuekill", "doublekill")


def participant_columns(exclude: tuple[str, ...] = ()) -> list[Column]:
    """The participant fields in record order, constants filled in."""
    return [
        F.lit("").alias(c) if c in CONSTANT_EMPTY_FIELDS else F.col(c)
        for c in PARTICIPANT_FIELDS
        if c not in exclude
    ]


def participant_projection(participants: DataFrame, with_date: bool = True) -> DataFrame:
    """``pt_dt`` (date key of the row) plus the participant fields in record order."""
    cols = [date_key("logtime").alias("pt_dt")] if with_date else []
    return participants.select(*cols, *participant_columns())
