"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from arenaflow.plans.registry import QUERIES
from oracle_compare import compare, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_small, name):
    r = compare(spark, con, name, sf_small, queries()[name], oracle_sql()[name])
    assert r["ok"], r.get("why")
    assert r["spark_rows"] > 0


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["pt_dt", "battle_info"]
    assert df.count() > 0
