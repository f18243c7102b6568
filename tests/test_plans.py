"""Plan-shape checks: what Catalyst must (and must not) produce for the jobs."""

import re

from arenaflow.params import RunParams
from arenaflow.plans import jobs
from arenaflow.plans.registry import QUERIES
from arenaflow.schemas import ADMISSIONS, MATCHES, PARTICIPANTS
from arenaflow.session import scratch_dir
from arenaflow.sources.logs import Logs
from helpers import admission, logs, participant

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def plan_text(df, mode="formatted"):
    return df._jdf.queryExecution().executedPlan().toString() if mode == "physical" else _explain(df, mode)


def _explain(df, mode):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_flagship_has_no_python_and_one_filter_for_era_rule(spark, sf_small):
    df = QUERIES["packed_matches"](spark, sf_small)
    text = _explain(df, "formatted")
    assert not any(n in text for n in PYTHON_NODES)
    assert "Union" not in text  # era rule is one OR filter, not two scans and a union
    assert "WholeStageCodegen" in _explain(df, "codegen") or "*(" in text


def test_match_view_is_one_aggregation_over_both_logs(spark, sf_small):
    text = _explain(QUERIES["match_view"](spark, sf_small), "formatted")
    assert len(re.findall(r"hashpartitioning\(battleid", text)) == 1
    assert "ObjectHashAggregate" not in text  # no list buffering per group


def test_date_range_reaches_the_parquet_scan(spark):
    lg = logs(spark, [participant(1, 1, "2021-01-05 00:00:00")], admissions=[admission(1, 1, 1500)])
    root = scratch_dir(spark, "plan-pushdown")
    lg.participants.write.parquet(f"{root}/p")
    lg.matches.write.parquet(f"{root}/m")
    lg.admissions.write.parquet(f"{root}/a")
    on_disk = Logs(spark.read.schema(PARTICIPANTS).parquet(f"{root}/p"),
                   spark.read.schema(MATCHES).parquet(f"{root}/m"),
                   spark.read.schema(ADMISSIONS).parquet(f"{root}/a"))
    p = RunParams("2021-01-01", "2021-03-31", 3, 1000, "1,2", "sdk", 2)
    text = _explain(jobs.qualified_matches(on_disk, p), "formatted")
    pushed = " ".join(re.findall(r"PushedFilters: (.*)", text))
    assert "GreaterThanOrEqual(logtime,2021-01-01)" in pushed
    assert "LessThan(logtime,2021-03-32)" in pushed
    assert "EqualTo(herotid,3)" in pushed and "In(modetid, [1,2])" in pushed
    # the admission scan reads only the two keys and the rating
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert "struct<matching_id:bigint,role_id:bigint,team_elo:bigint>" in schemas


def test_scans_are_column_pruned(spark, sf_small):
    text = _explain(QUERIES["match_kill_totals"](spark, sf_small), "formatted")
    (schema,) = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert schema == "struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_linestatus:string>"


def test_allow_list_semi_join_carries_no_hint(spark, sf_small):
    plan = QUERIES["version_allow_semi"](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and "strategy=broadcast" not in plan


def test_detail_joins_the_participants_once(spark, sf_small):
    df = QUERIES["player_detail"](spark, sf_small)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "Join LeftOuter" in plan
    assert not any(n in _explain(df, "formatted") for n in PYTHON_NODES)


def test_qualifying_filters_reach_the_json_scan(spark):
    from arenaflow.operators import qualifying_participants
    from arenaflow.sources import logs as logsrc

    lg = logs(spark, [participant(1, 1, "2021-01-05 00:00:00")])
    root = scratch_dir(spark, "plan-json")
    glob = logsrc.write_json_tree(lg.participants, root)
    good, _ = logsrc.split_corrupt(logsrc.read_json_log(spark, glob, PARTICIPANTS))
    p = RunParams("2021-01-01", "2021-03-31", 3, 1000, "1,2", "sdk", 2)
    text = _explain(qualifying_participants(good, p), "formatted")
    pushed = " ".join(re.findall(r"PushedFilters: (.*)", text))
    assert "Scan json" in text
    assert "GreaterThanOrEqual(logtime,2021-01-01)" in pushed and "LessThan(logtime,2021-03-32)" in pushed
    # numbers are read as text and converted above the scan, so that a mistyped one costs no row
    assert "try_cast" in text and "herotid" in text


def test_sink_rebalances_on_the_date_key(spark):
    from arenaflow.sources.exports import rebalanced

    df = spark.createDataFrame([("2021-01-01", "a"), ("2021-01-02", "b")], "pt_dt string, battle_info string")
    text = _explain(rebalanced(df), "formatted")
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "hashpartitioning(pt_dt" in text
