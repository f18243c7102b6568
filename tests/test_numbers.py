"""Text form of measures, order-independent totals, odd numbers in raw JSON."""

import random

import pytest
from pyspark.sql import functions as F

from arenaflow.functions import number_text, pack_record
from arenaflow.operators.aggregates import match_states, match_view, merged_states, view_of_states
from arenaflow.schemas import PARTICIPANTS, UNCAST_COLUMN
from arenaflow.session import scratch_dir
from arenaflow.sources import logs as logsrc
from helpers import logs, participant, rows

TEXTS = {
    0.0: "0", -0.0: "0", 1.0: "1", -17.0: "-17", 5.5: "5.5", 0.1234567: "0.1234567", 1e-7: "0.0000001", 1e8: "100000000", 1e33: "1" + "0" * 33,
    -1e37: "-1" + "0" * 37, 1e40: "1.0E40", 1e-20: "1.0E-20", 123456.789: "123456.789", 2.0**50: "1125899906842624", 1e19 + 0.0: "1" + "0" * 19,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_number_text(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(k, float(x)) for k, x in enumerate(TEXTS)], "k int, x double")
        assert [r["t"] for r in df.select("k", number_text("x").alias("t")).orderBy("k").collect()] == list(TEXTS.values())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert spark.range(1).select(number_text(F.lit(None).cast("double")).alias("t")).first()["t"] is None


def test_number_text_reads_back(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-25, 45) for _ in range(2000)] + [float(rng.randint(-10**17, 10**17)) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert df.where(number_text("x").cast("double") != F.col("x")).count() == 0


def test_one_odd_number_costs_neither_the_row_nor_the_export(spark):
    numbers = {1: "1e33", 2: "1e-7", 3: "0.1234567", 4: '"Infinity"', 5: "-0.0", 6: '"NaN"', 7: "1e400", 8: '"x"'}
    lg = logs(spark, [participant(k, k, "2021-03-01 00:00:00", kill=5) for k in numbers])
    line = F.to_json(F.struct(*lg.participants.columns))
    for k, text in numbers.items():
        line = F.when(F.col("battleid") == k, F.regexp_replace(F.to_json(F.struct(*lg.participants.columns)), '"kill":5', f'"kill":{text}')).otherwise(line)
    glob = logsrc.write_json_tree(lg.participants, scratch_dir(spark, "odd-numbers"), line=line)
    found = logsrc.read_json_log(spark, glob, PARTICIPANTS)
    texts = {r["battleid"]: (r["r"], r[UNCAST_COLUMN]) for r in found.select("battleid", pack_record(found, ["kill"]).alias("r"), UNCAST_COLUMN).collect()}
    assert [texts[k][0] for k in sorted(numbers)] == ["1" + "0" * 33, "0.0000001", "0.1234567", "", "0", "", "", ""]
    assert [k for k in numbers if texts[k][1] == ["kill"]] == [4, 6, 7, 8]
    view = {r["battleid"]: r["faction_total_kill"] for r in match_view(logsrc.split_corrupt(found)[0]).collect()}
    assert view == {1: "1" + "0" * 33, 2: "0.0000001", 3: "0.1234567", 4: None, 5: "0", 6: None, 7: None, 8: None}


def fractional(spark, kills):
    lg = logs(spark, [participant(b, k, "2021-03-01 00:00:00", factionid=1 + k % 2) for b, xs in kills.items() for k, _ in enumerate(xs)])
    values = spark.createDataFrame([(b, k, x) for b, xs in kills.items() for k, x in enumerate(xs)], "b long, k long, x double")
    cols = [F.col("x").alias("kill") if c == "kill" else F.col(c) for c in lg.participants.columns]
    return lg.participants.join(values, (F.col("battleid") == F.col("b")) & (F.col("role_id") == F.col("k"))).select(*cols)


KILLS = {
    1: [0.1] * 10, 2: [1e16, 1.0, -1e16, 1.0], 3: [1e33, 1.0], 4: [None, None], 5: [0.1, None, 0.2], 6: [1e-20, 1.0], 7: [1e37] * 9, 8: [5.0, 2.5], 9: [1e300, 1.0],
}
TOTALS = {
    1: "1", 2: "2", 3: "1" + "0" * 32 + "1", 4: None, 5: "0.3", 6: "1", 7: "9" + "0" * 37, 8: "7.5", 9: "1.0E300",
}


@pytest.mark.parametrize("parts", [1, 7])
def test_totals_do_not_depend_on_the_order_of_rows(spark, parts):
    df = fractional(spark, KILLS).repartition(parts)
    found = {r["battleid"]: r["faction_total_kill"] for r in match_view(df).collect()}
    assert found == TOTALS


def test_merged_states_equal_the_view_of_all_rows(spark):
    df = fractional(spark, KILLS)
    whole = rows(match_view(df))
    for part in (F.col("role_id") % 2, F.col("role_id") % 5, F.col("battleid") % 3):
        cuts = [match_states(df.where(part == k)) for k in range(5)]
        states = cuts[0]
        for more in cuts[1:]:
            states = states.unionByName(more)
        assert rows(view_of_states(merged_states(states))) == whole
        assert rows(view_of_states(merged_states(merged_states(states)))) == whole
