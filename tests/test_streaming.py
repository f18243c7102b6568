import os
import re

from arenaflow.schemas import PARTICIPANTS
from arenaflow.session import scratch_dir
from arenaflow.sources import logs as logsrc
from arenaflow.streaming.landing import land_log, read_landed
from helpers import logs, participant, rows
from test_io import leaves


def test_landing_is_incremental_and_prunes_dates(spark):
    first = logs(spark, [participant(i, i, f"2021-0{1 + i % 2}-0{1 + i % 3} 00:00:00") for i in range(10)])
    src = scratch_dir(spark, "landing-src")
    logsrc.write_json_tree(first.participants, f"{src}/batch1")
    target = scratch_dir(spark, "landing-out") + "/participants"
    glob = f"{src}/*/*/*/*/*.txt"

    q = land_log(spark, glob, PARTICIPANTS, target)
    q.awaitTermination(120)
    assert rows(read_landed(spark, target, PARTICIPANTS)) == rows(first.participants)

    second = logs(spark, [participant(100 + i, i, "2021-03-05 00:00:00") for i in range(3)])
    logsrc.write_json_tree(second.participants, f"{src}/batch2")
    leaf = leaves(f"{src}/batch2")[0]
    with open(os.path.join(leaf, "bad.txt"), "w") as fh:
        fh.write("{not json\n")
    q = land_log(spark, glob, PARTICIPANTS, target)
    q.awaitTermination(120)
    landed = read_landed(spark, target, PARTICIPANTS)
    assert rows(landed) == rows(first.participants.unionByName(second.participants))  # each file read once
    assert spark.read.parquet(target + "_corrupt").count() == 1

    window = read_landed(spark, target, PARTICIPANTS, "2021-03-01", "2021-03-31")
    assert window.count() == 3
    plan = window._sc._jvm.PythonSQLUtils.explainString(window._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[.*pt_dt", plan)


def test_replayed_batch_is_not_duplicated(spark):
    from arenaflow.streaming.landing import _write_batch
    from arenaflow.schemas import CORRUPT_COLUMN, UNCAST_COLUMN
    from pyspark.sql import functions as F

    lg = logs(spark, [participant(i, i, "2021-01-05 00:00:00") for i in range(4)])
    batch = lg.participants.withColumn(CORRUPT_COLUMN, F.lit(None).cast("string")).withColumn(
        UNCAST_COLUMN, F.lit(None).cast("array<string>")
    )
    target = scratch_dir(spark, "landing-replay") + "/p"
    write = _write_batch(target, target + "_corrupt", [f.name for f in PARTICIPANTS.fields])
    write(batch, 0)
    write(batch, 0)  # replay
    write(batch, 1)
    assert spark.read.parquet(target).count() == 8


def test_jobs_prune_date_partitions_of_landed_logs(spark):
    from arenaflow.params import RunParams
    from arenaflow.plans import jobs
    from arenaflow.schemas import ADMISSIONS
    from arenaflow.sources.logs import Logs
    from helpers import admission

    lg = logs(
        spark,
        [participant(i, i, f"2021-0{1 + i % 3}-1{i % 4} 00:00:00") for i in range(12)],
        admissions=[admission(i, i, 1500, f"2021-0{1 + i % 3}-1{i % 4} 00:00:00") for i in range(12)],
    )
    root = scratch_dir(spark, "landing-jobs")
    for name, df, schema in (("p", lg.participants, PARTICIPANTS), ("a", lg.admissions, ADMISSIONS)):
        src = f"{root}/src_{name}"
        df.write.json(src)
        land_log(spark, src, schema, f"{root}/{name}").awaitTermination(120)
    landed = Logs(
        read_landed(spark, f"{root}/p", PARTICIPANTS, keep_partition=True),
        lg.matches,
        read_landed(spark, f"{root}/a", ADMISSIONS, keep_partition=True),
        date_partitioned=True,
    )
    p = RunParams("2021-02-01", "2021-02-28", 3, 1000, "1", "sdk", 2, version_cutoff="2021-01-01")
    for fn in (lambda x: jobs.eligible_matches(x, p),
               lambda x: jobs.participant_detail(x, p, jobs.eligible_matches(x, p))):
        assert rows(fn(landed)) == rows(fn(lg))
    q = jobs.qualified_matches(landed, p)
    plan = q._sc._jvm.PythonSQLUtils.explainString(q._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[[^\n]*pt_dt[^\n]*2021-02-01", plan)
