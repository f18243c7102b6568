"""Declared schemas of the three logs.

Declaring types replaces schema inference: no extra pass over the input, and the
type of a column cannot drift between runs.  Typed tables hold the measures as
integers; a scan of raw JSON reads them as doubles (:func:`scanned_schema`), and
the exports print an integral double without a fraction.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The participant measures carried into the exports, in record order.
PARTICIPANT_MEASURES = (
    "gold", "score", "kill", "death", "assist", "rank_tid",
    "towerkill", "creepkill", "dmgtohero", "dmgtotower", "dmgreceived",
    "magdmgreceived", "triblekill", "quadrakill", "pentakill", "healingtohero",
)

# Attributes of the match log consolidated by the wide match view.
MATCH_ATTRIBUTES = (
    "gametype", "modetid", "battletid", "begintime", "playtime", "playersnum",
    "usernum", "fakeusernum", "robotnum", "gather_report_sec",
    "illegal_player_1", "illegal_player_3",
)

CORRUPT_COLUMN = "_corrupt_record"
UNCAST_COLUMN = "_uncast"

PARTICIPANTS = T.StructType(
    [
        T.StructField("battleid", T.LongType()),
        T.StructField("role_id", T.LongType()),
        T.StructField("logtime", T.StringType()),
        T.StructField("factionid", T.IntegerType()),
        T.StructField("keyversion", T.StringType()),
        T.StructField("usernum", T.IntegerType()),
        T.StructField("modetid", T.IntegerType()),
        T.StructField("herotid", T.IntegerType()),
    ]
    + [T.StructField(m, T.LongType()) for m in PARTICIPANT_MEASURES]
)

MATCHES = T.StructType(
    [
        T.StructField("battleid", T.LongType()),
        T.StructField("gametype", T.StringType()),
        T.StructField("modetid", T.IntegerType()),
        T.StructField("battletid", T.StringType()),
        T.StructField("begintime", T.StringType()),
        T.StructField("playtime", T.LongType()),
        T.StructField("playersnum", T.IntegerType()),
        T.StructField("usernum", T.IntegerType()),
        T.StructField("fakeusernum", T.IntegerType()),
        T.StructField("robotnum", T.IntegerType()),
        T.StructField("gather_report_sec", T.LongType()),
        T.StructField("illegal_player_1", T.StringType()),
        T.StructField("illegal_player_3", T.StringType()),
    ]
)

ADMISSIONS = T.StructType(
    [
        T.StructField("matching_id", T.LongType()),
        T.StructField("role_id", T.LongType()),
        T.StructField("team_elo", T.LongType()),
        T.StructField("logtime", T.StringType()),
    ]
)


# Fields that a raw scan reads as doubles: a fraction must not cost the value.
MEASURES = frozenset((*PARTICIPANT_MEASURES, "team_elo"))


def scanned_schema(schema: T.StructType) -> T.StructType:
    """The types that a scan of raw JSON lines gives the fields of ``schema``."""
    return T.StructType([T.StructField(f.name, T.DoubleType() if f.name in MEASURES else f.dataType) for f in schema.fields])
