"""The plans a large run takes (no broadcast anywhere) give the same rows as the default plans."""

from arenaflow.plans import jobs
from arenaflow.sources import fixtures
from helpers import rows
from test_plans import _explain
from test_skew import conf

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "32",
}


def test_shuffle_only_plans_give_the_same_rows(spark, sf_small):
    p = fixtures.FIXTURE_PARAMS
    lg = fixtures.load(spark, sf_small)
    eligible = jobs.eligible_matches(lg, p)
    expected_detail = rows(jobs.participant_detail(lg, p, eligible))
    expected_eligible = rows(eligible)
    expected_participants = rows(jobs.eligible_participants(lg, p))
    with conf(spark, NO_BROADCAST):
        lg2 = fixtures.load(spark, sf_small)
        eligible2 = jobs.eligible_matches(lg2, p)
        detail = jobs.participant_detail(lg2, p, eligible2)
        assert "BroadcastHashJoin" not in _explain(detail, "formatted")
        assert rows(detail) == expected_detail
        assert rows(eligible2) == expected_eligible
        assert rows(jobs.eligible_participants(lg2, p)) == expected_participants


def test_detail_cuts_to_eligible_matches_before_the_ratings(spark):
    from helpers import admission, logs, participant

    lg = logs(spark, [participant(1, 1, "1997-01-05 00:00:00")], admissions=[admission(1, 1, 1500)])
    p = fixtures.FIXTURE_PARAMS
    with conf(spark, NO_BROADCAST):
        detail = jobs.participant_detail(lg, p, spark.createDataFrame([], "pt_dt string, battleid long"))
        text = detail._jdf.queryExecution().optimizedPlan().toString()
        # one left join with the ratings above one inner join with the pairs; no anti join, one participant scan
        assert text.index("Join LeftOuter") < text.index("Join Inner")
        assert "LeftAnti" not in text and text.count("kill#") >= 1
        full = _explain(detail, "formatted")
        assert full.count("SortMergeJoin Inner") + full.count("SortMergeJoin (") <= 2
