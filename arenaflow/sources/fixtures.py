"""Adapter from the driver's test tables to the three match logs.

The test data is a TPC-H-like star schema; this module derives the participant,
match and admission logs from it with plain column expressions, so every query
reads the given tables and its work grows with them.  The same mapping is
written as SQL in :mod:`arenaflow.plans.oracle` for the DuckDB differential check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arenaflow.params import RunParams
from arenaflow.sources.logs import Logs

# Parameters under which the test tables give non-empty results at every step.
FIXTURE_PARAMS = RunParams(
    start_date="1996-01-01",
    end_date="2000-12-31",
    hero_id=3,
    team_elo=1000,
    modetids=(1, 2, 3, 5, 7),
    sdk_version="fixture",
    score=2,
    version_cutoff="1998-01-01",
    version_allow_list=("v1", "v2", "v3"),
)
# Match id of the point-lookup diagnostic and participant count of the
# duplicate audit on the test tables.
FIXTURE_LOOKUP_BATTLEID = 7
FIXTURE_AUDIT_COUNT = 7


# Declared schemas of the test tables read here: no footer-reading job to
# infer them on every read.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, read with its declared schema."""
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts_text(c: Column) -> Column:
    return F.substring(c.cast("string"), 1, 19)


def _rounded(c: Column) -> Column:
    # half-up rounding with primitive arithmetic (same formula in the oracle)
    return F.floor(c + F.lit(0.5)).cast("bigint")


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    line = F.col("l_linenumber")
    qty = F.col("l_quantity").cast("bigint")
    return li.select(
        F.col("l_orderkey").alias("battleid"),
        F.col("l_suppkey").alias("role_id"),
        _ts_text(F.col("l_shipdate")).alias("logtime"),
        F.when(F.col("l_linestatus") == "F", F.lit(1))
        .when(F.col("l_returnflag") == "A", F.lit(None))
        .otherwise(F.lit(2))
        .cast("int")
        .alias("factionid"),
        F.when(line == 1, F.lit(None).cast("string"))
        .when(line == 2, F.lit(""))
        .when((line == 3) & (F.col("l_orderkey") % 2 == 0), F.lit("   "))
        .when(line == 3, F.lit("\t"))
        .when(line == 4, F.lit("null"))
        .when(line == 5, F.lit(" NULL "))
        .otherwise(F.concat(F.lit("v"), (F.col("l_partkey") % 7).cast("string")))
        .alias("keyversion"),
        F.when(F.col("l_returnflag") == "R", F.lit(8)).otherwise(F.lit(10)).cast("int").alias("usernum"),
        line.cast("int").alias("modetid"),
        (F.col("l_partkey") % 5).cast("int").alias("herotid"),
        _rounded(F.col("l_extendedprice")).alias("gold"),
        _rounded(F.col("l_discount") * 100).alias("score"),
        qty.alias("kill"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("bigint"))
        .otherwise(_rounded(F.col("l_tax") * 100))
        .alias("death"),
        F.col("l_partkey").alias("assist"),
        line.cast("bigint").alias("rank_tid"),
        (F.col("l_partkey") % 11).alias("towerkill"),
        (F.col("l_suppkey") % 13).alias("creepkill"),
        (qty * 100 + line).cast("bigint").alias("dmgtohero"),
        (F.col("l_orderkey") % 1000).alias("dmgtotower"),
        ((F.col("l_partkey") * 7) % 1000).alias("dmgreceived"),
        ((F.col("l_partkey") + F.col("l_suppkey")) % 500).alias("magdmgreceived"),
        (line % 2).cast("bigint").alias("triblekill"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("bigint"))
        .otherwise((line % 3).cast("bigint"))
        .alias("quadrakill"),
        F.when(line == 7, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("pentakill"),
        _rounded(F.col("l_tax") * 1000).alias("healingtohero"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cust = F.col("o_custkey")
    status = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("battleid"),
        status.alias("gametype"),
        (cust % 7 + 1).cast("int").alias("modetid"),
        F.col("o_orderpriority").alias("battletid"),
        _ts_text(F.col("o_orderdate")).alias("begintime"),
        (_rounded(F.col("o_totalprice")) % 3600).alias("playtime"),
        F.lit(10).cast("int").alias("playersnum"),
        F.when(status == "F", F.lit(10)).otherwise(F.lit(8)).cast("int").alias("usernum"),
        (cust % 3).cast("int").alias("fakeusernum"),
        F.when(status == "P", F.lit(None)).otherwise(cust % 2).cast("int").alias("robotnum"),
        (F.col("o_orderkey") % 60).alias("gather_report_sec"),
        F.when(cust % 4 == 0, F.concat(cust.cast("string"), F.lit(","), status)).alias("illegal_player_1"),
        (cust % 10).cast("string").alias("illegal_player_3"),
    )


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rating and time depend only on the supplier and the order, so the
    # distinct runs on the two keys (map-side) before the lookups.
    pairs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return (
        pairs.join(su, pairs.l_suppkey == su.s_suppkey)
        .join(o, pairs.l_orderkey == o.o_orderkey)
        .select(
            F.col("l_orderkey").alias("matching_id"),
            F.col("l_suppkey").alias("role_id"),
            _rounded(F.col("s_acctbal")).alias("team_elo"),
            _ts_text(F.col("o_orderdate")).alias("logtime"),
            # the stored date of some admissions is another than that of their log time
            F.substring((F.col("o_orderdate") + F.expr("INTERVAL 1 DAY") * (F.col("l_suppkey") % 3 * 60)).cast("string"), 1, 10).alias("pt_dt"),
        )
    )


def load(spark: SparkSession, sf_dir: str) -> Logs:
    """The three logs derived from the test tables under ``sf_dir``."""
    return Logs(participants(spark, sf_dir), matches(spark, sf_dir), admissions(spark, sf_dir))
