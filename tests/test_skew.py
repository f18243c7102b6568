"""A key holding a third of all rows: the match join lets adaptive execution
split it on either side, also within the detail job."""

import contextlib

from pyspark.sql import functions as F

from arenaflow.operators.joins import match_join
from arenaflow.operators.aggregates import match_kill_totals
from helpers import rows

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _skewed(spark, n=300_000):
    # right side: key 0 holds a third of all rows; left side: one row per key, some keys absent on the right
    right = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("rk"), (F.col("id") * 7).alias("payload")
    )
    left = spark.range(0, n, 5).select(F.col("id").alias("k"), F.lit("x").alias("l"))
    return left, right


def test_hot_key_is_split_and_rows_are_exact(spark):
    left, right = _skewed(spark)
    with conf(spark, SKEW_CONF):
        safe = match_join(left, right, [("k", "rk")])
        got = safe.collect()
        plan = safe._jdf.queryExecution().executedPlan().toString()
        plain = left.join(right, F.col("k") == F.col("rk")).collect()
    assert "SortMergeJoin(skew=true)" in plan
    key = lambda r: (r["k"], r["rk"] is None, r["rk"] or 0, r["payload"] or 0)
    assert sorted(got, key=key) == sorted(plain, key=key)
    assert sum(1 for r in got if r["k"] == 0) == 100_000


def test_detail_job_splits_a_hot_match(spark):
    from arenaflow.params import RunParams
    from arenaflow.plans import jobs
    from arenaflow.schemas import ADMISSIONS, MATCHES, PARTICIPANTS
    from arenaflow.sources.logs import Logs

    n = 240_000  # match 0 holds a third of the participant rows
    fields = {
        "battleid": F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")), "role_id": F.col("id"),
        "logtime": F.lit("2021-03-05 10:00:00"), "keyversion": F.concat(F.lit("v"), F.col("id")), "usernum": F.lit(10), "modetid": F.lit(1),
        "herotid": F.when(F.col("id") % 1000 == 0, F.lit(3)).otherwise(F.lit(4)), "score": F.lit(5), "kill": F.col("id"),
    }
    parts = spark.range(n).select(*(fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PARTICIPANTS.fields))
    adm = spark.range(n).select(fields["battleid"].alias("matching_id"), F.col("id").alias("role_id"), F.lit(1500).cast("long").alias("team_elo"),
                                F.lit("2021-03-05 10:00:00").alias("logtime")).select(*ADMISSIONS.names)
    lg = Logs(parts, spark.createDataFrame([], MATCHES), adm)
    p = RunParams("2021-01-01", "2021-12-31", 3, 1000, "1", "sdk", 2, version_cutoff="2021-01-01")
    with conf(spark, SKEW_CONF):
        detail = jobs.participant_detail(lg, p, jobs.eligible_matches(lg, p))
        got = detail.groupBy("battleid").count()
        hot = {r["battleid"]: r["count"] for r in got.collect()}
        plan = got._jdf.queryExecution().executedPlan().toString()
    assert hot[0] == n // 3 and len(hot) == 1 + n // 1000 * 2 // 3
    assert "skew=true" in plan


def test_hot_group_aggregates_map_side(spark):
    n = 90_000
    parts = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("battleid"),
        F.lit(1).cast("int").alias("factionid"),
        F.lit(2).cast("bigint").alias("kill"),
    )
    totals = match_kill_totals(parts)
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan  # combined before the shuffle
    hot = [r for r in totals.collect() if r["battleid"] == 0]
    assert rows(spark.createDataFrame(hot)) == [(0, 60_000, 0, 60_000)]
