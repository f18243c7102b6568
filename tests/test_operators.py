"""One test per semantic pitfall, on hand-written logs."""

import pytest
from pyspark.sql import functions as F

from arenaflow.operators import (
    duplicate_audit,
    era_rule,
    era_rule_union,
    first_valid_version,
    left_join,
    match_kill_totals,
    match_view,
    monthly_counts,
    point_lookup,
    version_allowed,
    version_allowed_semi,
)
from arenaflow.params import RunParams
from arenaflow.plans import jobs
from helpers import admission, logs, match, participant, rows

P = RunParams("2021-01-01", "2021-03-31", 3, 1000, "1,2", "sdk", 2, version_cutoff="2021-02-01",
              version_allow_list=("a1", "a2"))


def test_kill_totals_null_side_and_null_kill(spark):
    lg = logs(spark, [
        participant(1, 10, "2021-01-05 00:00:00", factionid=1, kill=3),
        participant(1, 11, "2021-01-05 00:00:00", factionid=2, kill=4),
        participant(1, 12, "2021-01-05 00:00:00", factionid=None, kill=5),
        participant(1, 13, "2021-01-05 00:00:00", factionid=1, kill=None),
        participant(2, 10, "2021-01-05 00:00:00", factionid=7, kill=None),
    ])
    got = rows(match_kill_totals(lg.participants), "battleid", "faction_1_total_kill", "faction_2_total_kill",
               "faction_total_kill")
    assert got == [(1, 3, 4, 12), (2, 0, 0, None)]


def test_first_valid_version_skips_blank_and_null_spellings(spark):
    lg = logs(spark, [
        participant(1, 1, "2021-01-05 00:00:00", keyversion=" NULL "),
        participant(1, 2, "2021-01-05 00:00:00", keyversion="   "),
        participant(1, 3, "2021-01-05 00:00:00", keyversion=" zz "),
        participant(2, 1, "2021-01-05 00:00:00", keyversion="null"),
    ])
    assert rows(first_valid_version(lg.participants)) == [(1, " zz "), (2, None)]


def test_match_view_union_semantics(spark):
    lg = logs(
        spark,
        [
            participant(1, 1, "2021-01-06 00:00:00", kill=2),
            participant(1, 2, "2021-01-05 00:00:00", kill=3, factionid=2),
            participant(None, 3, "2021-01-07 00:00:00", kill=1),
            participant(None, 4, "2021-01-08 00:00:00", kill=1),
        ],
        [match(1), match(1), match(9), match(None)],
    )
    got = {r["battleid"]: r for r in match_view(lg.participants, lg.matches).collect()}
    assert set(got) == {1, 9, None}  # P15: NULL ids form one group
    assert (got[1]["pt_dt"], got[1]["faction_1_total_kill"], got[1]["faction_2_total_kill"],
            got[1]["faction_total_kill"]) == ("2021-01-05", "2", "3", "5")
    # P2: a match known only to the match log has NULL date and NULL totals
    assert got[9]["pt_dt"] is None and got[9]["faction_total_kill"] is None
    assert got[None]["faction_total_kill"] == "2"
    assert all(isinstance(got[1][c], str) for c in ("faction_1_total_kill", "faction_total_kill"))


def test_wide_view_cut_at_comma(spark):
    lg = logs(spark, [participant(1, 1, "2021-01-05 00:00:00")],
              [match(1, illegal_player_1="7,F", modetid=10), match(1, modetid=9), match(2, illegal_player_1="x")])
    plain = {r["battleid"]: r for r in match_view(lg.participants, lg.matches, wide=True).collect()}
    cut = {r["battleid"]: r for r in match_view(lg.participants, lg.matches, wide=True, cut_at_comma=True).collect()}
    assert plain[1]["illegal_player_1"] == "7,F" and cut[1]["illegal_player_1"] == "7"  # P12
    assert plain[1]["modetid"] == "9"  # typed minimum
    assert cut[1]["modetid"] == "10"  # text order of the other dialect
    assert plain[2]["pt_dt"] is None and plain[1]["pt_dt"] == "2021-01-05"


def _scenario(spark):
    return logs(
        spark,
        [
            # match 1 qualifies on two roles with different dates (P4 grain)
            participant(1, 10, "2021-01-10 00:00:00", keyversion="a1", kill=2),
            participant(1, 11, "2021-01-11 00:00:00", kill=3),
            participant(1, 12, "2021-01-10 00:00:00", herotid=4),  # not the hero
            # match 2: after the cutoff, NULL version, kept by the era rule (P9)
            participant(2, 20, "2021-02-10 00:00:00", keyversion=None),
            # match 3: before the cutoff, version not allowed, dropped
            participant(3, 30, "2021-01-12 00:00:00", keyversion="zz"),
            # match 4: qualifying row in range but match date before the range (P3)
            participant(4, 40, "2021-01-02 00:00:00"),
            participant(4, 41, "2020-12-31 00:00:00", herotid=4),
            # match 5: role without admission
            participant(5, 50, "2021-01-15 00:00:00"),
            # match 6: score below the floor
            participant(6, 60, "2021-01-15 00:00:00", score=1),
        ],
        [match(1), match(7)],
        [
            admission(1, 10, 1500), admission(1, 10, 1600),  # P16: two ratings
            admission(1, 11, 1200), admission(1, 11, 1200),  # exact duplicate
            admission(2, 20, 1100, logtime="2020-06-01 00:00:00"),  # P13: outside the range
            admission(3, 30, 1300), admission(4, 40, 1300), admission(6, 60, 2000),
        ],
    )


def test_qualified_matches_grain_and_era_rule(spark):
    lg = _scenario(spark)
    q = jobs.qualified_matches(lg, P)
    assert rows(q, "pt_dt", "battleid") == [
        ("2021-01-10", 1), ("2021-01-11", 1), ("2021-01-12", 3), ("2021-02-10", 2)
    ]
    eligible = jobs.eligible_matches(lg, P)
    assert rows(eligible, "pt_dt", "battleid", "keyversion") == [
        ("2021-01-10", 1, "a1"), ("2021-01-11", 1, "a1"), ("2021-02-10", 2, None)
    ]
    # the match log does not change the job (its matches have no date)
    with_log = jobs.qualified_matches(lg, P, with_match_log=True)
    assert rows(with_log) == rows(q)


def test_qualified_participants_rating_grain(spark):
    lg = _scenario(spark)
    q = jobs.qualified_participants(lg, P)
    got = rows(q, "battleid", "role_id", "team_elo")
    assert got == [(1, 10, 1500), (1, 10, 1600), (1, 11, 1200), (2, 20, 1100), (3, 30, 1300)]
    assert rows(q.select("pt_dt_date").distinct()) == [("2021-01",), ("2021-02",)]


def test_era_rule_forms_agree(spark):
    lg = _scenario(spark)
    q = jobs.qualified_participants(lg, P)
    a = rows(era_rule(q, P.version_cutoff, P.version_allow_list))
    b = rows(era_rule_union(q, P.version_cutoff, P.version_allow_list))
    c = rows(era_rule_union(q, P.version_cutoff, P.version_allow_list, distinct=True))
    assert a == b == c
    df = spark.createDataFrame(
        [(None, "a1"), ("2021-01-01", None), ("2021-03-01", None), ("2021-01-01", "a2")], "pt_dt string, keyversion string"
    )
    assert rows(era_rule(df, "2021-02-01", ["a1", "a2"])) == [("2021-01-01", "a2"), ("2021-03-01", None)]


def test_version_semi_equals_isin(spark):
    df = spark.createDataFrame([("a1",), ("b",), (None,), ("a2",), ("a1",)], "keyversion string")
    assert rows(version_allowed(df, ["a1", "a2", "a1"])) == rows(version_allowed_semi(df, ["a1", "a2", "a1"]))


def test_participant_detail_left_joins(spark):
    lg = _scenario(spark)
    eligible = jobs.eligible_matches(lg, P)
    detail = jobs.participant_detail(lg, P, eligible)
    got = rows(detail, "pt_dt", "battleid", "role_id", "team_elo")
    # match 1 is eligible under two dates, so its participants repeat (P4);
    # role 10 has two ratings and role 11 a duplicated admission (P5);
    # match 2's admission is outside the range, so its rating is empty (P13)
    expected = []
    for d in ("2021-01-10", "2021-01-11"):
        expected += [(d, 1, 10, 1500), (d, 1, 10, 1600), (d, 1, 11, 1200), (d, 1, 11, 1200), (d, 1, 12, None)]
    expected += [("2021-02-10", 2, 20, None)]
    assert got == sorted(expected, key=repr)
    packed = jobs.packed_players(detail).collect()
    assert {len(r["battle_info"].split("\u0001")) for r in packed} == {24}


def test_left_join_true_miss(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "k long, l string")
    right = spark.createDataFrame([(2, 20), (2, 21), (3, 30), (None, 0)], "rk long, r int")
    got = rows(left_join(left, right, [("k", "rk")]), "k", "l", "rk", "r")
    assert got == sorted(
        [(1, "a", None, None), (2, "b", 2, 20), (2, "b", 2, 21), (None, "c", None, None),
         (2, "d", 2, 20), (2, "d", 2, 21)],
        key=repr,
    )


def test_packed_records_field_counts(spark):
    lg = _scenario(spark)
    m = jobs.packed_matches(jobs.eligible_matches(lg, P)).collect()
    p = jobs.packed_participants(jobs.eligible_participants(lg, P)).collect()
    assert {len(r["battle_info"].split("\u0001")) for r in m} == {5}
    assert {len(r["battle_info"].split("\u0001")) for r in p} == {28}
    rec = {r["battle_info"] for r in m if r["pt_dt"] == "2021-02-10"}
    assert rec == {"2\u0001\u00011\u00010\u00011"}  # NULL version keeps its position


def test_monthly_counts_sum_to_rows(spark):
    lg = _scenario(spark)
    detail = jobs.participant_detail(lg, P, jobs.eligible_matches(lg, P))
    counts = monthly_counts(detail).collect()
    assert sum(r["record_count"] for r in counts) == detail.count()


def test_duplicate_audit_and_point_lookup(spark):
    lg = logs(spark, [participant(1, 1, "2021-01-01 00:00:00")] * 3 + [participant(2, 1, "2021-01-01 00:00:00")])
    assert rows(duplicate_audit(lg.participants, 3)) == [(1, 3)]
    assert point_lookup(lg.participants, 1).count() == 1
    assert point_lookup(lg.participants, 1, distinct=False).count() == 3
    assert point_lookup(lg.participants, 1, role_id=2).count() == 0


def test_result_independent_of_input_partitioning(spark):
    lg = _scenario(spark)
    base = rows(jobs.packed_matches(jobs.eligible_matches(lg, P)))
    from arenaflow.sources.logs import Logs
    shuffled = Logs(lg.participants.repartition(7), lg.matches.repartition(3), lg.admissions.repartition(5))
    assert rows(jobs.packed_matches(jobs.eligible_matches(shuffled, P))) == base


def test_match_log_changes_no_qualified_row(spark):
    lg = _scenario(spark)
    for fn in (jobs.qualified_matches, jobs.qualified_participants):
        assert rows(fn(lg, P, with_match_log=True)) == rows(fn(lg, P))


def test_detail_equals_its_left_join_definition(spark):
    """The job path's inner join and the left join of the definition give the same rows."""
    lg = _scenario(spark)
    pairs = jobs.eligible_matches(lg, P).select("pt_dt", "battleid")
    by_definition = left_join(pairs, jobs._played(lg, P), [("battleid", "played_battleid")])
    assert rows(jobs.expanded_participants(lg, P, jobs.eligible_matches(lg, P))) == rows(by_definition)


def test_plan_functions_start_no_job(spark):
    lg = _scenario(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "plan functions")
    try:
        eligible = jobs.eligible_matches(lg, P)
        for df in (jobs.participant_detail(lg, P, eligible), jobs.expanded_participants(lg, P, eligible),
                   jobs.monthly_player_counts(lg, P), jobs.monthly_participant_counts(lg, P)):
            assert df.columns
        assert not tracker.getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_monthly_participants_count_each_once(spark):
    lg = _scenario(spark)
    distinct = jobs.eligible_participants(lg, P).select("pt_dt_date", "battleid", "role_id", "keyversion").distinct()
    assert sum(r["record_count"] for r in jobs.monthly_participant_counts(lg, P).collect()) == distinct.count()


def test_version_semi_join_takes_a_table(spark):
    df = spark.createDataFrame([("a1",), ("b",), (None,), ("a1",)], "keyversion string")
    table = spark.createDataFrame([("a1", ), ("c",), (None,), ("a1",)], "version string")
    assert rows(version_allowed_semi(df, table)) == [("a1",), ("a1",)]


def test_detail_admission_window_on_stored_date(spark):
    from arenaflow.sources.logs import Logs

    lg = _scenario(spark)
    # stored date of match 2's admission inside the range although its log time is not
    # and the reverse for match 1: log time in range, stored date outside
    adm = lg.admissions.withColumn(
        "pt_dt",
        F.when(F.col("matching_id") == 2, F.lit("2021-02-10"))
        .when(F.col("matching_id") == 1, F.lit("2020-01-01"))
        .otherwise(F.substring("logtime", 1, 10)),
    )
    stored = Logs(lg.participants, lg.matches, adm)
    eligible = jobs.eligible_matches(stored, P)
    by_log = rows(jobs.participant_detail(stored, P, eligible), "battleid", "role_id", "team_elo")
    by_pt = rows(jobs.participant_detail(stored, P, eligible, admission_window="pt_dt"), "battleid", "role_id", "team_elo")
    assert (2, 20, None) in by_log and (2, 20, 1100) in by_pt
    assert (1, 10, 1500) in by_log and (1, 10, None) in by_pt and (1, 10, 1500) not in by_pt
    with pytest.raises(ValueError):
        jobs.participant_detail(stored, P, eligible, admission_window="other")


def test_first_earliest_follows_the_log_time(spark):
    from arenaflow.operators import first_earliest

    lg = logs(spark, [
        participant(1, 1, "2021-03-02 10:00:00", keyversion="a"), participant(1, 2, "2021-03-01 10:00:00", keyversion="z"),
        participant(1, 3, "2021-02-01 10:00:00", keyversion=" "), participant(1, 4, None, keyversion="0"),
        participant(2, 1, "2021-03-01 10:00:00", keyversion="y"), participant(2, 2, "2021-03-01 10:00:00", keyversion="x"),
        participant(3, 1, None, keyversion="only"), participant(4, 1, "2021-03-01 10:00:00", keyversion=None), participant(None, 1, "2021-03-09 10:00:00"),
    ])
    assert rows(first_earliest(lg.participants)) == sorted(
        [(1, "2021-02-01", "z"), (2, "2021-03-01", "x"), (3, None, "only"), (4, "2021-03-01", None), (None, "2021-03-09", "v1")], key=repr
    )
