import os

from arenaflow.__main__ import main
from arenaflow.session import scratch_dir
from arenaflow.sources import exports
from helpers import admission, logs, match, participant


def test_match_export_from_json_logs(spark, capsys):
    lg = logs(spark, [participant(1, 1, "2021-03-05 00:00:00"), participant(2, 2, "2021-03-06 00:00:00")],
              [match(1)], [admission(1, 1, 1500), admission(2, 2, 1500)])
    root = scratch_dir(spark, "cli")
    for name in ("participants", "matches", "admissions"):
        getattr(lg, name).write.json(f"{root}/{name}")
    args = [f"--{n}={root}/{n}" for n in ("participants", "matches", "admissions")]
    # after the production cutoff every version is kept
    run = ["20210101", "20210331", "3", "1000", "1,2", "4.2.0", "2"]
    assert main(["match-export", *args, f"--out={root}/out", *run]) == 0
    path = f"{root}/out/battle_info/3/4.2.0/20210101-20210331/"
    assert sorted(d for d in os.listdir(path.removeprefix("file:")) if d.startswith("pt_dt=")) == ["pt_dt=2021-03-05", "pt_dt=2021-03-06"]
    assert exports.read_keyed_text(spark, path).count() == 2
    assert main(["monthly-qa", *args, *run]) == 0
    out = capsys.readouterr().out
    assert "participants: 2 lines, 0 not JSON, 0 values not of their type" in out
    assert "participants 2021-03 2" in out
    assert "matches 2021-03 2" in out and "players 2021-03 2" in out


def test_exports_from_catalog_tables(spark, capsys):
    lg = logs(spark, [participant(1, 1, "2021-03-05 00:00:00")], [match(1)], [admission(1, 1, 1500)])
    for name in ("participants", "matches", "admissions"):
        getattr(lg, name).createOrReplaceTempView(f"cli_{name}")
    args = [f"--{n}=cli_{n}" for n in ("participants", "matches", "admissions")]
    run = ["20210101", "20210331", "3", "1000.5", "1,2", "4.2.0", "2.5"]
    assert main(["monthly-qa", "--tables", *args, *run]) == 0
    assert "matches 2021-03 1" in capsys.readouterr().out
