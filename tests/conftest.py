import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from arenaflow.session import build_session

    s = build_session("local[*]", 8, app="arenaflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(f"{SF_SMALL}/lineitem.parquet"):
        pytest.skip("test tables not present")
    return SF_SMALL


@pytest.fixture(scope="session")
def spark_session_for_hypothesis(spark):
    # hypothesis refuses function-scoped fixtures; the session one is shared
    return spark
