"""Match view kept by batches; key reduction; file index."""

import json
import os

import pytest
from pyspark.sql import functions as F

from arenaflow.operators.aggregates import match_view
from arenaflow.operators.keys import key_bitmap, maybe_among
from arenaflow.params import RunParams
from arenaflow.plans import jobs
from arenaflow.plans.registry import _logs
from arenaflow.schemas import MATCHES, PARTICIPANTS
from arenaflow.session import hadoop_path, scratch_dir
from arenaflow.sources import file_index, fixtures, logs as logsrc
from arenaflow.streaming import match_state
from arenaflow.streaming.landing import land_log, read_landed
from helpers import admission, logs, match, participant, rows
from test_plans import _explain

DAY = "2021-03-0{} 10:00:00"


# --- incremental match view ---------------------------------------------------

def test_three_landings_with_late_repeated_and_replayed_rows(spark):
    batches = [
        [participant(1, 1, DAY.format(5), kill=3, keyversion=None), participant(2, 1, DAY.format(5), kill=1), participant(None, 9, DAY.format(5))],
        [participant(1, 2, DAY.format(6), kill=4, keyversion="v2"), participant(1, 1, DAY.format(5), kill=3, keyversion=None)],  # a repeated row
        [participant(1, 3, DAY.format(1), kill=None, keyversion="v1", factionid=2), participant(3, 1, DAY.format(7))],  # a late one
    ]
    known = [match(1, gametype="a"), match(4, gametype="b", modetid=3)], [], [match(1, gametype="c")]
    root = scratch_dir(spark, "state-test")
    for k, (p, m) in enumerate(zip(batches, known, strict=True)):
        lg = logs(spark, p, m)
        match_state.write_batch_states(lg.participants, "participants", root, k)
        match_state.write_batch_states(lg.matches, "matches", root, k)
        match_state.write_batch_states(lg.participants, "participants", root, k)  # replayed
        landed = logs(spark, sum(batches[: k + 1], []), sum(known[: k + 1], []))
        want = rows(match_view(landed.participants, landed.matches, wide=True))
        assert rows(match_state.landed_match_view(spark, root)) == want
        if k == 1:
            assert match_state.compact_states(spark, root, "participants") == 1
            assert rows(match_state.landed_match_view(spark, root)) == want
            assert match_state.expire_states(spark, root, "participants") == 2
            match_state.write_batch_states(lg.participants, "participants", root, k)  # a batch that the base holds already
            assert rows(match_state.landed_match_view(spark, root)) == want


def test_a_compaction_that_fails_halfway_is_not_seen(spark):
    lg = logs(spark, [participant(1, 1, DAY.format(5), kill=3)])
    root = scratch_dir(spark, "state-halfway")
    match_state.write_batch_states(lg.participants, "participants", root, 0)
    want = rows(match_state.landed_match_view(spark, root))
    match_state.compact_states(spark, root, "participants")
    fs, marker = hadoop_path(spark, f"{root}/participants/base/upto=0/_SUCCESS")
    fs.delete(marker, False)
    assert rows(match_state.landed_match_view(spark, root)) == want
    assert match_state.expire_states(spark, root, "participants") == 0
    with pytest.raises(ValueError):
        match_state.landed_match_view(spark, scratch_dir(spark, "state-none"))
    with pytest.raises(ValueError):
        match_state.batch_states(lg.participants, "admissions")


def test_landing_keeps_the_states(spark):
    root, src = scratch_dir(spark, "state-landing"), scratch_dir(spark, "state-src")
    glob = f"{src}/*/*/*/*/*.txt"
    for k, day in enumerate((5, 2, 7)):
        lg = logs(spark, [participant(i % 3, i, DAY.format(day), kill=i) for i in range(6)], [match(i, gametype=f"g{day}") for i in range(4)])
        logsrc.write_json_tree(lg.participants, f"{src}/p{k}")
        land_log(spark, glob.replace(src, f"{src}"), PARTICIPANTS, f"{root}/p", states=("participants", f"{root}/states")).awaitTermination(120)
    match_state.write_batch_states(lg.matches, "matches", f"{root}/states", 0)
    landed = read_landed(spark, f"{root}/p", PARTICIPANTS)
    assert landed.count() == 18
    assert rows(match_state.landed_match_view(spark, f"{root}/states")) == rows(match_view(landed, lg.matches, wide=True))


def test_states_are_read_one_row_per_match_and_batch(spark):
    lg = logs(spark, [participant(1, i, DAY.format(5)) for i in range(50)])
    assert match_state.batch_states(lg.participants, "participants").count() == 1


# --- key reduction ----------------------------------------------------------------

def test_bitmap_lets_every_key_pass_and_holds_back_most_others(spark):
    keys = spark.range(0, 100_000, 50).select(F.col("id").alias("battleid"))
    bitmap = key_bitmap(keys, "battleid", bits=20)
    found = maybe_among(spark.range(100_000).select(F.col("id").alias("battleid")), bitmap, "battleid", bits=20)
    ids = {r[0] for r in found.collect()}
    assert set(range(0, 100_000, 50)) <= ids and len(ids) < 2_000 + 1_000
    assert key_bitmap(spark.range(1_000_000).select(F.col("id").alias("k")), "k", bits=10).count() <= 16  # bounded whatever the keys
    full = key_bitmap(spark.range(100_000).select(F.col("id").alias("k")), "k", bits=10)
    assert maybe_among(spark.range(500).select(F.col("id").alias("k")), full, "k", bits=10).count() == 500


def test_no_candidates_and_null_ids(spark):
    lg = logs(spark, [participant(None, 1, DAY.format(1)), participant(5, 1, DAY.format(1))], [match(5)], [admission(5, 1, 10)])
    p = RunParams("2021-01-01", "2021-12-31", 3, 1000, "1,2", "sdk", 2)
    assert jobs.qualified_matches(lg, p, reduce_keys=True).collect() == []


def test_reduced_jobs_give_the_same_rows(spark, sf_small):
    lg, p = _logs(spark, sf_small), fixtures.FIXTURE_PARAMS
    for job in (jobs.qualified_matches, jobs.qualified_participants, jobs.eligible_participants):
        whole = rows(job(lg, p, reduce_keys=False))
        assert whole and rows(job(lg, p, reduce_keys=True)) == whole
    assert rows(jobs.qualified_matches(lg, p, True, reduce_keys=True)) == rows(jobs.qualified_matches(lg, p, True, reduce_keys=False))


def test_the_view_aggregates_candidates_only(spark, sf_small):
    lg, p = _logs(spark, sf_small), fixtures.FIXTURE_PARAMS
    df = jobs.qualified_matches(lg, p, reduce_keys=True)
    text = _explain(df, "formatted")
    assert "getbit" in text and "MapIn" not in text and "PythonUDF" not in text
    keys = jobs.qualified_matches(lg, p, reduce_keys=False).select("battleid").distinct()
    reduced = match_view(maybe_among(lg.participants, key_bitmap(keys, "battleid"), "battleid"))
    all_matches, candidates = lg.participants.select("battleid").distinct().count(), keys.count()
    assert candidates <= reduced.count() <= candidates + 0.01 * all_matches < all_matches / 2


# --- file index -------------------------------------------------------------------

def tree(spark, root):
    lg = logs(spark, [participant(i, i, f"2021-{1 + i % 6:02d}-{1 + i % 28:02d} 10:00:00", kill=i) for i in range(60)])
    return lg.participants, logsrc.write_json_tree(lg.participants, f"{root}/log")


def files_of(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root.removeprefix("file:")) for f in names if f.endswith(".txt"))


def read_range(spark, glob, root, start="2021-02-05", end="2021-03-10"):
    return file_index.read_json_log_range(spark, glob, PARTICIPANTS, f"{root}/index", start, end)


def whole_range(spark, glob, start="2021-02-05", end="2021-03-10"):
    return logsrc.read_json_log(spark, glob, PARTICIPANTS).where(F.substring("logtime", 1, 10).between(start, end))


def test_files_outside_the_range_are_not_opened(spark):
    root = scratch_dir(spark, "index")
    _, glob = tree(spark, root)
    n = len(files_of(f"{root}/log"))
    assert file_index.update_index(spark, glob, f"{root}/index") == n > 6
    assert file_index.update_index(spark, glob, f"{root}/index") == 0
    want = rows(whole_range(spark, glob))
    found = read_range(spark, glob, root)
    assert rows(found) == want and want
    opened = {f.removeprefix("file://") for f in found.inputFiles()}
    assert 0 < len(opened) < n / 2
    # a file out of range whose content changes unseen (same size, same time) is not read: its rows would show
    for path in files_of(f"{root}/log"):
        if path not in opened:
            stat, data = os.stat(path), open(path).read()
            open(path, "w").write(data.replace("2021-", "2021-02-06")[: len(data)].replace("\n", " ", 1)[: stat.st_size].ljust(stat.st_size))
            os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
            crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
            if os.path.exists(crc):
                os.utime(crc)
    assert rows(read_range(spark, glob, root)) == want


def test_new_and_changed_files_are_read_and_indexed_again(spark):
    root = scratch_dir(spark, "index-new")
    participants, glob = tree(spark, root)
    file_index.update_index(spark, glob, f"{root}/index")
    folder = os.path.dirname(files_of(f"{root}/log")[0])
    row = json.dumps({"battleid": 999, "role_id": 1, "logtime": "2021-02-20 00:00:00"})
    new = os.path.join(folder, "new.txt")
    open(new, "w").write(row + "\n")  # not indexed yet: read
    assert rows(read_range(spark, glob, root)) == rows(whole_range(spark, glob))
    assert 999 in {r["battleid"] for r in read_range(spark, glob, root).collect()}
    assert file_index.update_index(spark, glob, f"{root}/index") == 1
    open(new, "w").write(row.replace("999", "1000").replace("02-20", "03-01") + "\n{broken\n" + '{"battleid": 5}\n')
    os.utime(new, (2_000_000_000, 2_000_000_000))
    assert rows(read_range(spark, glob, root)) == rows(whole_range(spark, glob))
    assert file_index.update_index(spark, glob, f"{root}/index") == 1
    entry = file_index.read_index(spark, f"{root}/index").where(F.col("path").endswith("new.txt")).orderBy("modified").collect()[-1]
    assert (entry["lines"], entry["dated"], entry["first"], entry["last"]) == (3, 1, "2021-03-01 00:00:00", "2021-03-01 00:00:00")
    os.remove(new)
    assert rows(read_range(spark, glob, root)) == rows(whole_range(spark, glob))


def test_empty_files_and_empty_ranges(spark):
    root = scratch_dir(spark, "index-empty")
    _, glob = tree(spark, root)
    open(os.path.join(os.path.dirname(files_of(f"{root}/log")[0]), "empty.txt"), "w").close()
    assert file_index.update_index(spark, glob, f"{root}/index") == len(files_of(f"{root}/log")) - 1  # an empty one is not listed
    assert file_index.update_index(spark, glob, f"{root}/index") == 0
    none = read_range(spark, glob, root, "2030-01-01", "2030-12-31")
    assert none.collect() == [] and none.columns == whole_range(spark, glob).columns
    everything = read_range(spark, glob, root, "2000-01-01", "2030-12-31")
    assert everything.count() == 60
