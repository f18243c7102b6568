from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arenaflow.functions import (
    FIELD_SEPARATOR,
    compact_to_iso,
    compact_to_iso_checked,
    date_range,
    iso_to_compact,
    pack,
    valid_version,
    valid_version_ws,
)


def _one_col(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_valid_version_spellings(spark):
    values = [None, "", "   ", "null", " Null ", "NULL", "nUlL", "\t", " abc ", "0123456789abcdef0123456789abcdef"]
    got = _one_col(spark, values, valid_version)
    # only spaces are trimmed: a tab is a value; the kept value is untrimmed
    assert got == [None, None, None, None, None, None, "nUlL", "\t", " abc ", values[-1]]


def test_valid_version_ws_is_stricter(spark):
    values = ["\t", " 　 ", "\tnull\n", "NULL ", "x\ty", "nUlL"]
    assert _one_col(spark, values, valid_version_ws) == [None, None, None, None, "x\ty", "nUlL"]


def test_valid_version_ws_matches_python_rule(spark):
    values = ["\x1c", "\x85", " ", "​", "a", " null ", "\x0b\x0c"]

    def rule(v):
        if v is None or len(v) == 0 or v.isspace() or v.strip() in ("null", "Null", "NULL"):
            return None
        return v

    assert _one_col(spark, values, valid_version_ws) == [rule(v) for v in values]


def test_pack_keeps_positions_and_separator(spark):
    df = spark.createDataFrame([(1, None, "", 7)], "a long, b long, c string, d int")
    (rec,) = df.select(pack("a", "b", "c", "d")).first()
    assert rec == "1\u0001\u0001\u00017"
    assert rec.split(FIELD_SEPARATOR) == ["1", "", "", "7"]
    assert rec.encode("utf-8").count(b"\x01") == 3


def test_compact_dates(spark):
    got = _one_col(spark, ["20201101", "20201301", "2020110"], compact_to_iso)
    assert got == ["2020-11-01", "2020-13-01", "2020-11-0"]
    assert _one_col(spark, ["20201101", "20201301", "x"], compact_to_iso_checked) == ["2020-11-01", None, None]
    assert _one_col(spark, ["2020-11-01"], iso_to_compact) == ["20201101"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="0123459-: :xé\uffff", min_size=0, max_size=21), min_size=1, max_size=30))
def test_pushable_range_equals_substring_range(spark_session_for_hypothesis, values):
    spark = spark_session_for_hypothesis
    df = spark.createDataFrame([(v,) for v in values], "logtime string")
    a = df.where(date_range("logtime", "2021-01-01", "2021-02-09", pushable=True)).collect()
    b = df.where(date_range("logtime", "2021-01-01", "2021-02-09", pushable=False)).collect()
    assert sorted(r[0] for r in a) == sorted(r[0] for r in b)
    expected = [v for v in values if "2021-01-01" <= v[:10] <= "2021-02-09"]
    assert sorted(r[0] for r in a) == sorted(expected)


def test_pushable_range_edges(spark):
    values = [
        "2021-01-01", "2021-01-00", "2021-01-0", "2021-01-01 00:00:00", "2020-12-31 23:59:59", "2021-02-09",
        "2021-02-09 23:59:59", "2021-02-09￿", "2021-02-0:", "2021-02-1", "2021-02-10", "2021-02-09x", "2021",
        "2021-01-01\x00", "", "2021-02-0", "2021-02-099",
    ]
    df = spark.createDataFrame([(v,) for v in values], "logtime string")
    raw = df.where(date_range("logtime", "2021-01-01", "2021-02-09")).collect()
    expected = sorted(v for v in values if "2021-01-01" <= v[:10] <= "2021-02-09")
    assert sorted(r[0] for r in raw) == expected
    text = df.where(date_range("logtime", "2021-01-01", "2021-02-09"))._jdf.queryExecution().optimizedPlan().toString()
    assert "substring" not in text
