from arenaflow.functions import valid_version, valid_version_ws
from arenaflow.operators import first_valid_version
from arenaflow.params import RunParams
from arenaflow.plans import jobs
from arenaflow.plans.views import register_functions, register_views
from helpers import admission, logs, participant, rows

P = RunParams("2021-01-01", "2021-03-31", 3, 1000, "1,2", "sdk", 2, version_cutoff="2021-02-01",
              version_allow_list=("a1", "a2"))


def test_sql_functions_equal_column_builders(spark):
    register_functions(spark, prefix="af_")
    values = [None, "", "   ", "null", " Null ", "NULL", "nUlL", "\t", " abc ", "\tnull\n", "　", "x\ty"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    df.createOrReplaceTempView("kv_values")
    by_sql = spark.sql("SELECT i, af_valid_version(v) AS a, af_valid_version_ws(v) AS b FROM kv_values")
    by_col = df.select("i", valid_version("v").alias("a"), valid_version_ws("v").alias("b"))
    assert rows(by_sql) == rows(by_col)
    assert spark.sql("SELECT af_compact_to_iso('20201101') AS d, af_iso_to_compact('2020-11-01') AS c").first() == (
        "2020-11-01", "20201101")


def test_views_answer_sql_in_the_original_style(spark):
    lg = logs(
        spark,
        [participant(1, 10, "2021-01-10 00:00:00", keyversion="a1"), participant(2, 20, "2021-01-11 00:00:00"),
         participant(3, 30, "2021-02-12 00:00:00", keyversion=" null ")],
        admissions=[admission(1, 10, 1500), admission(2, 20, 1500), admission(3, 30, 1500)],
    )
    register_functions(spark)
    names = register_views(spark, lg, P, prefix="t_")
    assert {"t_eligible_matches", "t_participant_detail", "t_packed_players"} <= set(names)
    assert spark.table("t_packed_players").count() == spark.table("t_participant_detail").count() > 0
    # double-quoted text literals, as in the original SQL
    early = spark.sql('SELECT pt_dt, battleid FROM t_qualified_matches WHERE pt_dt < "2021-02-01" '
                      'AND keyversion IN ("a1", "a2") UNION ALL '
                      'SELECT pt_dt, battleid FROM t_qualified_matches WHERE pt_dt >= "2021-02-01"')
    assert rows(early) == rows(jobs.eligible_matches(lg, P).select("pt_dt", "battleid"))
    assert rows(early) == [("2021-01-10", 1), ("2021-02-12", 3)]
    firsts = spark.sql("SELECT battleid, min(valid_version(keyversion)) AS keyversion FROM t_participants GROUP BY battleid")
    assert rows(firsts) == rows(first_valid_version(lg.participants))
