"""Logs landed in buckets of the match id, so that joins and aggregations by match need no shuffle.

The participant and admission logs are written as Parquet tables of the catalog, both in the same number of buckets
by their match id.  Every job of a run is local to a match: the qualifying join, the consolidated view, the
participants of an eligible match and their ratings.  Over these tables each of them reads a bucket of both logs in
one task, without an exchange above the scans.

A bucket can't be split at run time, so a match that holds a large share of the rows must not be in one.  Matches
with more than ``hot_rows`` rows in either log go to two further tables without buckets, and the jobs run over
these the usual way (shuffled, hot keys split by adaptive execution).  As a match is wholly in
one half or the other, the two results together are the result over all rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenaflow.sources.logs import Logs

# Joins on (match, role) may use the buckets by match alone: Spark otherwise asks for both keys in the partitioning.
CO_PARTITION_CONF = "spark.sql.requireAllClusterKeysForCoPartition"


def match_rows(logs: Logs, hot_rows: int) -> DataFrame:
    """``log``, ``battleid``, ``n``: the rows of each match with more than ``hot_rows`` of them in a log, and in one row a log,
    without an id, those of all its other matches (both combined map-side).

    At most ``(rows of both logs) / hot_rows`` rows and two more.
    """
    counted = [
        df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("battleid")).agg(F.count(F.lit(1)).alias("n")).withColumn("log", F.lit(log))
        for log, df, key in (("participants", logs.participants, "battleid"), ("admissions", logs.admissions, "matching_id"))
    ]
    hot = F.when(F.col("n") > hot_rows, F.col("battleid")).alias("battleid")
    return reduce(DataFrame.unionAll, counted).groupBy("log", hot).agg(F.sum("n").alias("n"))


def hot_matches(logs: Logs, hot_rows: int) -> DataFrame:
    """``battleid`` of the matches with more than ``hot_rows`` rows in one of the two logs."""
    return match_rows(logs, hot_rows).where(F.col("battleid").isNotNull()).select("battleid").distinct()


def write_bucketed(rows: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """A catalog table in ``buckets`` buckets of ``key``, one sorted file each."""
    out = rows.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    out.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def land_bucketed(
    spark: SparkSession, logs: Logs, prefix: str, root: str, buckets: int, hot_rows: int = 1_000_000, bucket_rows: int = 1_000_000,
) -> None:
    """Writes ``<prefix>_participants`` and ``<prefix>_admissions`` in buckets, and their ``_hot`` tables.

    Of ``buckets`` there are more where a bucket of the larger log would hold more than about ``bucket_rows`` rows: one task
    sorts, joins and aggregates a bucket, so its memory doesn't grow with the logs.
    Rows without a match id join nothing; they go to the hot tables, where no bucket holds them all.
    """
    from arenaflow.operators.sizing import materialize_at, remove_folder

    rows, folder = materialize_at(match_rows(logs, hot_rows), "match-rows")
    most = rows.where(F.col("battleid").isNull()).agg(F.max("n")).first()[0] or 0
    limit = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))  # Spark's own
    buckets = min(max(buckets, -(-most // bucket_rows)), max(buckets, limit))
    hot = rows.where(F.col("battleid").isNotNull()).select(F.col("battleid").alias("_hot")).distinct()
    for name, df, key in (("participants", logs.participants, "battleid"), ("admissions", logs.admissions, "matching_id")):
        known = F.col(key) == F.col("_hot")
        cold = df.where(F.col(key).isNotNull()).join(hot, known, "left_anti")
        write_bucketed(cold, f"{prefix}_{name}", key, buckets, f"{root.rstrip('/')}/{name}")
        rest = df.join(hot, known, "left_semi").unionAll(df.where(F.col(key).isNull()))
        rest.write.mode("overwrite").format("parquet").option("path", f"{root.rstrip('/')}/{name}_hot").saveAsTable(f"{prefix}_{name}_hot")
    remove_folder(spark, folder)


def bucketed_logs(spark: SparkSession, prefix: str, matches: DataFrame | None = None) -> list[Logs]:
    """The two halves of landed logs: the bucketed one and the hot one (see :func:`by_match`).

    Sets ``spark.sql.requireAllClusterKeysForCoPartition`` to false in the session: results never depend on it.
    """
    spark.conf.set(CO_PARTITION_CONF, "false")
    return [
        Logs(spark.table(f"{prefix}_participants{half}"), matches, spark.table(f"{prefix}_admissions{half}"), co_partitioned=not half)
        for half in ("", "_hot")
    ]


def by_match(halves: list[Logs], job: Callable[[Logs], DataFrame]) -> DataFrame:
    """A job whose rows each depend on one match alone, over both halves."""
    return reduce(DataFrame.unionAll, map(job, halves))


def drop_bucketed(spark: SparkSession, prefix: str) -> None:
    """Removes the tables from the catalog; their files stay with the folder that holds them."""
    for name in ("participants", "admissions"):
        for half in ("", "_hot"):
            spark.sql(f"DROP TABLE IF EXISTS {prefix}_{name}{half}")
