import os

import pytest
from pyspark.sql import functions as F

from arenaflow.params import RunParams
from arenaflow.plans import jobs
from arenaflow.schemas import CORRUPT_COLUMN, PARTICIPANTS
from arenaflow.session import scratch_dir
from arenaflow.sources import exports, logs as logsrc
from helpers import admission, logs, participant, rows

def leaves(root):
    top = root.removeprefix("file:")
    return sorted(d for d, _, files in os.walk(top) if any(f.endswith(".txt") for f in files))


P = RunParams("2021-01-01", "2021-03-31", 3, 1000, "1", "sdk", 2, version_cutoff="2021-01-01")


def test_json_tree_scan_routes_corrupt_lines(spark):
    lg = logs(spark, [participant(i, i, f"2021-0{1 + i % 3}-05 00:00:00", keyversion=["", "   ", None, "v"][i % 4])
                      for i in range(12)])
    root = scratch_dir(spark, "json-test")
    glob = logsrc.write_json_tree(lg.participants, root)
    leaf = leaves(root)[0]
    with open(os.path.join(leaf, "extra.json"), "w") as fh:
        fh.write('{"battleid": 99, "role_id": \n')
    df = logsrc.read_json_log(spark, f"{root}/*/*/*/*", PARTICIPANTS)
    assert logsrc.log_quality(df).first() == (13, 1, 0)
    good, bad = logsrc.split_corrupt(df)
    assert rows(good) == rows(lg.participants)
    bad_rows = bad.collect()  # whole rows: a count would reference the corrupt column alone
    assert len(bad_rows) == 1 and bad_rows[0][CORRUPT_COLUMN].startswith('{"battleid": 99')


def test_compressed_json_tree_reads_the_same(spark):
    lg = logs(spark, [participant(i, i, f"2021-0{1 + i % 3}-05 00:00:00") for i in range(12)] + [participant(99, 1, None)])
    plain, packed = (logsrc.write_json_tree(lg.participants, scratch_dir(spark, f"json-{c}"), compression=c) for c in ("none", "gzip"))
    assert packed.endswith(".txt.gz")
    found = [logsrc.read_json_log(spark, glob, PARTICIPANTS) for glob in (plain, packed)]
    assert rows(found[0]) == rows(found[1]) and found[1].count() == 13
    with pytest.raises(ValueError):
        logsrc.write_json_tree(lg.participants, scratch_dir(spark, "json-odd"), compression="zip")


def test_export_written_where_its_rows_lie(spark):
    df = spark.range(0, 4000, 1, 4).select(F.lit("2021-01-01").alias("pt_dt"), F.lit("old").alias("battle_info"))
    path = scratch_dir(spark, "in-place")
    exports.write_keyed_text(df, f"{path}/out", rebalance=False)
    folder = f"{path}/out/pt_dt=2021-01-01".removeprefix("file:")
    assert sum(f.endswith(".txt") for f in os.listdir(folder)) == 4  # a task each, however alike the records
    assert exports.read_keyed_text(spark, f"{path}/out").count() == 4000


def test_keyed_text_sink_round_trip(spark):
    lg = logs(
        spark,
        [participant(1, 1, "2021-01-05 00:00:00"), participant(2, 2, "2021-02-06 00:00:00", death=None),
         participant(3, 3, "2021-02-06 00:00:00")],
        admissions=[admission(1, 1, 1500), admission(2, 2, 1500), admission(3, 3, 1500)],
    )
    root = scratch_dir(spark, "sink-test")
    paths = jobs.run_match_exports(lg, P, root)
    assert paths.battle_info.endswith("/battle_info/3/sdk/20210101-20210331/")
    top = paths.battle_info.removeprefix("file:")
    dirs = sorted(d for d in os.listdir(top) if d.startswith("pt_dt="))
    assert dirs == ["pt_dt=2021-01-05", "pt_dt=2021-02-06"]
    files = [f for d in dirs for f in os.listdir(os.path.join(top, d)) if f.startswith("part-")]
    assert files and all(f.endswith(".txt") for f in files)  # uncompressed
    back = exports.read_keyed_text(spark, paths.battle_info)
    assert dict(back.dtypes)["pt_dt"] == "string"
    assert rows(back) == rows(jobs.packed_matches(jobs.eligible_matches(lg, P)))
    detail = exports.read_keyed_text(spark, paths.player_info)
    assert detail.count() == 3
    # the materialized eligible set is removed once both exports are written
    scratch = os.path.dirname(root.removeprefix("file:"))
    assert not [d for d in os.listdir(scratch) if d.startswith("eligible-")]
    typed = exports.unpack(back, [("battleid", "bigint"), ("keyversion", "string")])
    assert rows(typed.select("battleid")) == [(1,), (2,), (3,)]


def test_unpack_empty_fields_are_null(spark):
    df = spark.createDataFrame([("d", "1\u0001\u0001x\u0001")], "pt_dt string, battle_info string")
    got = exports.unpack(df, [("a", "bigint"), ("b", "bigint"), ("c", "string"), ("d", "string")]).first()
    assert (got["a"], got["b"], got["c"], got["d"]) == (1, None, "x", None)


def test_export_is_not_replaced_unasked(spark):
    lg = logs(spark, [participant(1, 1, "2021-01-05 00:00:00")], admissions=[admission(1, 1, 1500)])
    root = scratch_dir(spark, "sink-twice")
    jobs.run_participant_export(lg, P, root)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        jobs.run_participant_export(lg, P, root)
    path = jobs.run_participant_export(lg, P, root, mode="overwrite")
    assert exports.read_keyed_text(spark, path).count() == 1


def test_readback_of_carriage_returns_and_bad_fields(spark):
    path = scratch_dir(spark, "sink-cr") + "/out"
    df = spark.createDataFrame([("2021-01-05", "1\u0001a\rb"), ("2021-01-05", "x\u0001c")], "pt_dt string, battle_info string")
    exports.write_keyed_text(df, path)
    got = exports.unpack(exports.read_keyed_text(spark, path), [("battleid", "bigint"), ("keyversion", "string")])
    assert rows(got, "battleid", "keyversion") == [(1, "a\rb"), (None, "c")]


def test_numeric_drift_loses_no_row(spark):
    """Numbers of another JSON form keep their rows and values, as far as the export."""
    root = scratch_dir(spark, "json-drift")
    base = '"logtime":"2021-01-05 00:00:00","usernum":10,"modetid":1,"herotid":3,"factionid":1,"gold":7'
    lines = [
        f'{{"battleid":1,"role_id":1,"score":5,"kill":2,{base}}}',
        f'{{"battleid":1,"role_id":2,"score":"5","kill":3.0,{base}}}',
        f'{{"battleid":2.0,"role_id":"3","score":5.5,"kill":"4",{base}}}',
        f'{{"battleid":3,"role_id":4,"score":5,"kill":"many",{base}}}',
        '{"battleid":',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{root}/p")
    adm = [f'{{"matching_id":{m},"role_id":{r},"team_elo":{e},"logtime":"2021-01-05 00:00:00"}}' for m, r, e in ((1, 1, 1500), (2, 3, 1500.5), (3, 4, 1500))]
    spark.createDataFrame([(x,) for x in adm], "value string").write.text(f"{root}/a")
    spark.createDataFrame([], "value string").write.text(f"{root}/m")
    scan = logsrc.read_json_log(spark, f"{root}/p", PARTICIPANTS)
    assert logsrc.log_quality(scan).first() == (5, 1, 1)
    lg = logsrc.Logs.from_json(spark, f"{root}/p", f"{root}/m", f"{root}/a")
    p = RunParams("2021-01-01", "2021-03-31", 3, 1000, "1", "sdk", "2.5", version_cutoff="2021-01-01")
    eligible = jobs.eligible_matches(lg, p)
    assert rows(eligible, "battleid", "faction_total_kill") == [(1, "5"), (2, "4"), (3, None)]
    records = [r["battle_info"].split("\u0001") for r in jobs.packed_players(jobs.participant_detail(lg, p, eligible)).collect()]
    assert sorted((r[0], r[1], r[3], r[-1]) for r in records) == [("1", "1", "5", "1500"), ("1", "2", "5", ""), ("2", "3", "5.5", "1500.5"), ("3", "4", "5", "1500")]


def test_catalog_tables_are_logs(spark):
    lg = logs(spark, [participant(1, 1, "2021-01-05 00:00:00")], admissions=[admission(1, 1, 1500)])
    for name, df in (("t_p", lg.participants), ("t_m", lg.matches), ("t_a", lg.admissions.withColumn("pt_dt", F.lit("2021-01-05")))):
        df.withColumn("extra", F.lit(1)).createOrReplaceTempView(name)
    tables = logsrc.Logs.from_tables(spark, "t_p", "t_m", "t_a")
    assert "pt_dt" in tables.admissions.columns and "extra" not in tables.participants.columns
    assert rows(jobs.eligible_matches(tables, P)) == rows(jobs.eligible_matches(lg, P))


def test_participant_export_path(spark):
    lg = logs(spark, [participant(1, 1, "2021-01-05 00:00:00")], admissions=[admission(1, 1, 1500)])
    path = jobs.run_participant_export(lg, P, scratch_dir(spark, "sink-a"))
    assert path.endswith("/battle_total/3/sdk/2021-01-01-2021-03-31/")
    recs = exports.read_keyed_text(spark, path).collect()
    assert len(recs) == 1 and len(recs[0]["battle_info"].split("\u0001")) == 28
