"""Publication of two exports together, verified read-back, bucketed logs."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from arenaflow.operators.joins import join_admissions
from arenaflow.params import RunParams
from arenaflow.plans import jobs
from arenaflow.session import scratch_dir
from arenaflow.sources import bucketed, exports, publication, verified
from helpers import admission, logs, participant, rows
from test_plans import _explain

P = RunParams("2021-01-01", "2021-12-31", 3, 1000, "1,2", "sdk", 2)
NAMES = ("battle_info", "player_info")


def small_logs(spark, n=4, kill=1):
    rows_ = [participant(b, r, f"2021-03-0{1 + b} 10:00:00", kill=kill, keyversion="v") for b in range(n) for r in range(3)]
    return logs(spark, rows_, admissions=[admission(b, r, 1500, f"2021-03-0{1 + b} 09:00:00") for b in range(n) for r in range(2)])


def contents(spark, root):
    return {name: rows(df) for name, df in publication.read_published(spark, P, root).items()}


# --- publication -----------------------------------------------------------------

def test_readers_see_both_exports_or_neither(spark, monkeypatch):
    root = scratch_dir(spark, "publish")
    with pytest.raises(FileNotFoundError):
        publication.read_published(spark, P, root)
    first = jobs.publish_match_exports(small_logs(spark), P, root)
    old = contents(spark, root)
    assert set(old) == set(NAMES) and len(old["battle_info"]) == 4 and len(old["player_info"]) == 12

    calls, write = [], exports.write_keyed_text

    def failing(records, path, **how):
        calls.append(path)
        if len(calls) == 2:
            write(records.limit(1), path, **how)  # something is there already when it fails
            raise OSError("no room")
        write(records, path, **how)

    monkeypatch.setattr(exports, "write_keyed_text", failing)
    with pytest.raises(OSError):
        jobs.publish_match_exports(small_logs(spark, kill=7), P, root)
    assert len(calls) == 2 and contents(spark, root) == old
    assert not any(os.path.exists(c.removeprefix("file:")) for c in calls)  # nothing is left over
    monkeypatch.undo()

    second = jobs.publish_match_exports(small_logs(spark, kill=7), P, root)
    new = contents(spark, root)
    assert (first["number"], second["number"]) == (1, 2) and new != old
    assert {r[1].split("\u0001")[4] for r in new["battle_info"]} == {"21"}
    assert publication.expire_publications(spark, P, root, NAMES) == 2 and contents(spark, root) == new
    assert publication.expire_publications(spark, P, root, NAMES) == 0


def test_a_failed_commit_changes_nothing(spark, monkeypatch):
    root = scratch_dir(spark, "publish-commit")
    jobs.publish_match_exports(small_logs(spark), P, root)
    old = contents(spark, root)

    def broken(*_):
        raise OSError("gone")

    monkeypatch.setattr(publication, "_commit", broken)
    with pytest.raises(OSError):
        jobs.publish_match_exports(small_logs(spark, kill=9), P, root)
    assert contents(spark, root) == old and publication.current_manifest(spark, P, root)["number"] == 1


def test_two_publications_at_once_get_two_numbers(spark, monkeypatch):
    folder = f"{scratch_dir(spark, 'publish-race')}/m"
    numbers = publication._numbers
    assert publication._commit(spark, folder, {"a": 1}) == 1
    seen = []

    def late(spark_, folder_):  # another run commits between the listing and the rename
        found = numbers(spark_, folder_)
        if not seen:
            seen.append(1)
            publication._commit(spark_, folder_, {"a": 2})
        return found

    monkeypatch.setattr(publication, "_numbers", late)
    assert publication._commit(spark, folder, {"a": 3}) == 3
    monkeypatch.undo()
    assert publication._numbers(spark, folder) == [1, 2, 3]


# --- verified read-back -------------------------------------------------------------

FIELDS = [("battleid", "bigint"), ("name", "string")]


def written(spark, texts):
    path = f"{scratch_dir(spark, 'verified-test')}/export"
    df = spark.createDataFrame(texts, "pt_dt string, battle_info string")
    verified.write_verified_text(df, path)
    return path


def record_files(path, day):
    return sorted(glob.glob(f"{path.removeprefix('file:')}/pt_dt={day}/*.txt"))


TEXTS = [("2021-01-01", "1\u0001a"), ("2021-01-01", "1\u0001a"), ("2021-01-01", "2\u0001b"), ("2021-01-02", "3\u0001"), ("2021-01-03", "4")]


def test_verified_rows_with_lineage_and_errors(spark):
    path = written(spark, TEXTS)
    good, wrong = verified.read_verified(spark, path, FIELDS)
    assert rows(good, "pt_dt", "battleid", "name") == [("2021-01-01", 1, "a"), ("2021-01-01", 1, "a"), ("2021-01-01", 2, "b"), ("2021-01-02", 3, None)]
    assert all(f"/pt_dt={r['pt_dt']}/" in r["_file"] for r in good.collect())
    assert rows(wrong, "pt_dt", "battle_info", "_width") == [("2021-01-03", "4", 1)]
    assert {r["status"] for r in verified.check_export(spark, path).collect()} == {"same"}
    assert rows(exports.read_keyed_text(spark, path)) == sorted(TEXTS, key=repr)  # the fingerprints are no records


def rewrite(path, change):
    data = open(path, encoding="utf-8").read()
    os.unlink(path)
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.unlink(crc)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(change(data))


@pytest.mark.parametrize("change", [lambda d: d.replace("a", "c", 1), lambda d: d + d[:4], lambda d: d.split("\n", 1)[1], lambda d: ""])
def test_a_changed_byte_is_found(spark, change):
    path = written(spark, TEXTS)
    rewrite(record_files(path, "2021-01-01")[0], change)
    assert [r["pt_dt"] for r in verified.check_export(spark, path).where("status <> 'same'").collect()] == ["2021-01-01"]
    with pytest.raises(verified.ExportDamaged, match="2021-01-01"):
        verified.read_verified(spark, path, FIELDS)


def test_order_and_file_layout_do_not_matter(spark):
    df = spark.createDataFrame(TEXTS, "pt_dt string, battle_info string")
    assert rows(verified.fingerprints(df)) == rows(verified.fingerprints(df.orderBy(F.desc("battle_info")).repartition(3)))
    path = written(spark, TEXTS)
    rewrite(record_files(path, "2021-01-01")[0], lambda d: "\n".join(sorted(d.splitlines(), reverse=True)) + "\n")
    assert {r["status"] for r in verified.check_export(spark, path).collect()} == {"same"}


def test_records_that_change_places_between_dates_are_found(spark):
    path = written(spark, [("2021-01-01", "1\u0001a"), ("2021-01-02", "2\u0001b")])
    one, two = (record_files(path, f"2021-01-0{k}")[0] for k in (1, 2))
    rewrite(one, lambda _: "2\u0001b\n")
    rewrite(two, lambda _: "1\u0001a\n")
    assert {r["status"] for r in verified.check_export(spark, path).collect()} == {"changed"}


def test_lost_and_added_dates_are_named(spark):
    path = written(spark, TEXTS)
    folder = path.removeprefix("file:")
    os.rename(f"{folder}/pt_dt=2021-01-02", f"{folder}/pt_dt=2021-01-09")
    found = {r["pt_dt"]: (r["status"], r["records"], r["written"]) for r in verified.check_export(spark, path).collect()}
    assert found["2021-01-02"] == ("missing", 0, 1) and found["2021-01-09"] == ("unexpected", 1, 0)


def test_empty_export(spark):
    path = written(spark, [])
    good, wrong = verified.read_verified(spark, path, FIELDS)
    assert good.count() == wrong.count() == 0


def test_a_write_that_loses_records_raises(spark, monkeypatch):
    read = verified.read_keyed_text
    monkeypatch.setattr(verified, "read_keyed_text", lambda *a, **k: read(*a, **k).where("battle_info <> '4'"))
    with pytest.raises(verified.ExportDamaged):
        written(spark, TEXTS)


# --- bucketed logs -----------------------------------------------------------------

@pytest.fixture
def halves(spark):
    hot = [participant(77, r, "2021-03-05 10:00:00") for r in range(40)]
    cold = [participant(b, r, "2021-03-05 10:00:00", keyversion="v") for b in range(30) for r in range(3)] + [participant(None, 1, "2021-03-05 10:00:00")]
    seats = [admission(b, r, 1500, "2021-03-05 09:00:00") for b in (*range(20), 77, None) for r in range(3)]
    lg = logs(spark, hot + cold, admissions=seats)
    prefix = "arenaflow_bucket_test"
    bucketed.land_bucketed(spark, lg, prefix, scratch_dir(spark, "bucketed-test"), 4, hot_rows=20)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lg, bucketed.bucketed_logs(spark, prefix)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset(bucketed.CO_PARTITION_CONF)
    bucketed.drop_bucketed(spark, prefix)


def test_buckets_follow_the_rows(spark):
    lg = logs(spark, [participant(b, r, "2021-03-05 10:00:00") for b in range(40) for r in range(3)] + [participant(77, r, "2021-03-05 10:00:00") for r in range(30)],
              admissions=[admission(b, 0, 1500, "2021-03-05 09:00:00") for b in range(40)])
    for name, rows_, want in (("few", 50, 3), ("many", 10, 12), ("none", 1_000_000, 2)):  # 120 rows that are not of a hot match
        prefix = f"arenaflow_buckets_{name}"
        bucketed.land_bucketed(spark, lg, prefix, scratch_dir(spark, "buckets"), 2, hot_rows=20, bucket_rows=rows_)
        shown = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {prefix}_participants").collect()}
        assert shown["Num Buckets"] == str(want)
        assert spark.table(f"{prefix}_participants").count() == 120 and spark.table(f"{prefix}_participants_hot").count() == 30
        bucketed.drop_bucketed(spark, prefix)


def _jobs():
    return {
        "admissions": lambda lg: join_admissions(lg.participants.select("battleid", "role_id"), lg.admissions),
        "qualified": lambda lg: jobs.qualified_matches(lg, P),
        "detail": lambda lg: jobs.participant_detail(lg, P, jobs.eligible_matches(lg, P)),
    }


@pytest.mark.parametrize("name", _jobs())
def test_no_shuffle_over_buckets_and_the_same_rows(spark, halves, name):
    whole, (cold, hot) = halves
    job = _jobs()[name]
    assert rows(bucketed.by_match([cold, hot], job)) == rows(job(whole)) != []
    text = _explain(job(cold), "formatted")
    assert "Exchange" not in text.replace("ReusedExchange", "") and "Bucketed: true" in text
    assert re.search(r"Exchange", _explain(job(hot), "formatted"))  # the hot half is shuffled, so that it can be split


def test_the_hot_match_is_in_no_bucket(spark, halves):
    whole, (cold, hot) = halves
    assert cold.participants.where("battleid = 77 or battleid is null").count() == 0
    assert hot.participants.count() == 41 and cold.participants.count() == 90
    assert {r[0] for r in hot.admissions.select("matching_id").distinct().collect()} == {77, None}
    assert rows(bucketed.hot_matches(whole, 20)) == [(77,)]
