"""Heavy hitters, the salted join, and the reasons why rows and matches are not exported."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenaflow.operators import heavy
from arenaflow.operators.funnel import ALL, KEPT, RULES, drop_funnel, failed_rules, first_failed, match_reasons, passed_rules
from arenaflow.operators.heavy import Summary, candidate_keys, heavy_hitters, salted_join
from arenaflow.params import RunParams
from arenaflow.plans import jobs
from arenaflow.plans.registry import _logs
from arenaflow.sources.fixtures import FIXTURE_PARAMS
from helpers import admission, logs, participant, rows
from test_plans import PYTHON_NODES, _explain


# --- heavy hitters ------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(5))
def test_summaries_lose_no_heavy_key_however_they_merge(seed):
    rng = np.random.default_rng(seed)
    keys = np.minimum(rng.zipf(1.3, 20_000), 5_000)
    capacity, count = 20, Counter(keys.tolist())
    parts = [Summary(capacity) for _ in range(7)]
    for k, part in enumerate(np.array_split(keys, 70)):
        parts[k % 7].add(part, np.ones(len(part), np.int64))
    merged = Summary(capacity)
    for part in parts:
        merged.add(part.keys, part.weights)
    weights = dict(zip(merged.keys.tolist(), merged.weights.tolist(), strict=True))
    assert len(weights) <= capacity
    assert all(w <= count[k] for k, w in weights.items())
    assert all(count[k] - weights.get(k, 0) <= len(keys) / (capacity + 1) for k in count)


@pytest.mark.parametrize("share", [0.3, 0.05, 0.01])
def test_heavy_hitters_equal_a_full_count(spark, share, monkeypatch):
    monkeypatch.setattr(heavy, "FAN_IN", 2)
    rng = random.Random(3)
    keys = [7] * 3000 + [None] * 500 + [rng.choice([1, 2, 3]) for _ in range(1500)] + [rng.randrange(10, 4000) for _ in range(5000)]
    rng.shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "battleid long").repartition(40)
    want = sorted((k, n) for k, n in Counter(keys).items() if k is not None and n > share * len(keys))
    assert rows(heavy_hitters(df, "battleid", share)) == sorted(want, key=repr) and (want or share == 0.3)
    assert {k for k, _ in want} <= {r[0] for r in candidate_keys(df, "battleid", int(1 / share) + 1, fan_in=2).collect()}


def test_no_rows_and_bad_shares(spark):
    none = spark.createDataFrame([], "battleid long")
    assert heavy_hitters(none, "battleid", 0.5).collect() == []
    with pytest.raises(ValueError):
        heavy_hitters(none, "battleid", 1.5)


def test_salted_join_equals_a_plain_join_and_spreads_the_hot_key(spark):
    rng = random.Random(4)
    left = spark.createDataFrame([(rng.choice([1, 1, 1, 2, 3, None]), i) for i in range(2000)], "a long, x long").repartition(8)
    right = spark.createDataFrame([(k, y) for k in (1, 1, 2, 4, None) for y in (10, 20)], "b long, y long")
    hot = heavy_hitters(left, "a", 0.4)
    assert rows(hot, "a") == [(1,)]
    joined = salted_join(left, right, "a", "b", hot, salts=16)
    assert joined.columns == ["a", "x", "b", "y"]
    assert rows(joined) == rows(left.join(right, F.col("a") == F.col("b")))
    assert rows(salted_join(left, right, "a", "b", hot.limit(0))) == rows(joined)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = salted_join(left, right, "a", "b", hot, salts=16).where("a = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spread > 3


# --- drop reasons -------------------------------------------------------------------

P = RunParams("2021-03-01", "2021-03-31", 3, 1000, "1,2", "sdk", 2, version_cutoff="2021-03-15", version_allow_list=("ok",))
DAY = "2021-03-{:02d} 10:00:00"


def test_each_rule_is_named(spark):
    own = [
        ("match_id", participant(None, 1, DAY.format(20))),
        ("date", participant(1, 1, "2021-02-10 10:00:00")),
        ("date", participant(1, 2, None)),
        ("lobby", participant(2, 1, DAY.format(20), usernum=8)),
        ("lobby", participant(2, 2, DAY.format(20), usernum=None, modetid=9)),
        ("mode", participant(3, 1, DAY.format(20), modetid=9)),
        ("hero", participant(4, 1, DAY.format(20), herotid=None)),
        ("score", participant(5, 1, DAY.format(20), score=1)),
        ("admitted", participant(6, 1, DAY.format(20))),
        ("rated", participant(7, 1, DAY.format(20))),
        ("rated", participant(7, 2, DAY.format(20))),
        ("match_date", participant(8, 1, DAY.format(20))),
        ("date", participant(8, 2, "2021-01-01 10:00:00")),
        ("version", participant(9, 1, DAY.format(10), keyversion="bad")),
        ("version", participant(10, 1, DAY.format(10), keyversion=" ")),
        (KEPT, participant(11, 1, DAY.format(10), keyversion="ok")),
        (KEPT, participant(12, 1, DAY.format(20), keyversion=None)),
        ("lobby", participant(12, 2, DAY.format(20), usernum=1, score=0)),
    ]
    seats = [admission(7, 1, 500), admission(7, 2, None), *(admission(b, 1, e) for b in (8, 9, 10, 11, 12) for e in (1500, 10)), admission(None, 1, 1500)]
    lg = logs(spark, [r for _, r in own], admissions=seats)
    masks = passed_rules(lg, P)
    found = masks.select("battleid", "role_id", first_failed(F.col("passed")).alias("reason")).collect()
    assert {(r["battleid"], r["role_id"]): r["reason"] for r in found} == {(r[0], r[1]): reason for reason, r in own}
    funnel = {(r["pt_dt_date"], r["reason"]): r["row_count"] for r in drop_funnel(masks).collect()}
    assert sum(funnel.values()) == len(own) and funnel["2021-03", KEPT] == 2 and funnel[None, "date"] == 1
    per_match = {r["battleid"]: (r["row_count"], r["kept_rows"], r["furthest"], r["never_passed"]) for r in match_reasons(masks).collect()}
    assert per_match[12] == (2, 1, KEPT, "") and per_match[7] == (2, 0, "rated", "rated")
    assert per_match[8] == (2, 0, "match_date", "match_date")
    assert per_match[2] == (2, 0, "lobby", "lobby,admitted,rated")
    assert set(per_match) == set(range(1, 13))
    assert all(r["f"] == [] for r in masks.where(F.col("passed") == ALL).select(failed_rules(F.col("passed")).alias("f")).collect())


def test_kept_rows_are_the_eligible_matches(spark, sf_small):
    lg = _logs(spark, sf_small)
    masks = passed_rules(lg, FIXTURE_PARAMS)
    kept = masks.where(F.col("passed") == ALL).select("pt_dt", "battleid").distinct()
    assert rows(kept) == rows(jobs.eligible_matches(lg, FIXTURE_PARAMS).select("pt_dt", "battleid")) != []
    funnel = drop_funnel(masks)
    assert funnel.agg(F.sum("row_count")).first()[0] == lg.participants.count() == masks.count()
    assert {r["reason"] for r in funnel.collect()} <= {*RULES, KEPT}
    text = _explain(funnel, "formatted")
    assert not any(n in text for n in PYTHON_NODES) and "CartesianProduct" not in text and "NestedLoop" not in text
