import pytest

from arenaflow.params import DEFAULT_VERSION_ALLOW_LIST, RunParams, compact_date, normalise_date


def test_dates_accept_iso_and_compact():
    assert normalise_date("20210601") == "2021-06-01"
    assert normalise_date("2021-06-01") == "2021-06-01"
    assert compact_date("2021-11-22") == "20211122"


@pytest.mark.parametrize("bad", ["2021-13-01", "20211301", "2021/06/01", "210601", "", "2021-02-30"])
def test_dates_reject_malformed(bad):
    with pytest.raises(ValueError):
        normalise_date(bad)


def test_params_from_argv_and_paths():
    p = RunParams.from_argv(["20210601", "20211122", "19", "1200", "108,117,118", "4.2.0", "3"])
    assert (p.start_date, p.end_date, p.hero_id, p.team_elo, p.modetids, p.score) == (
        "2021-06-01", "2021-11-22", 19, 1200, (108, 117, 118), 3,
    )
    assert p.export_path("/x", "battle_info") == "/x/battle_info/19/4.2.0/20210601-20211122/"
    assert p.export_path("/x", "battle_total", compact=False) == "/x/battle_total/19/4.2.0/2021-06-01-2021-11-22/"


def test_thresholds_may_have_a_fraction():
    p = RunParams("2021-01-01", "2021-02-01", 1, "1000.5", "1", "s", "2.5")
    assert (p.team_elo, p.score) == (1000.5, 2.5)
    assert RunParams("2021-01-01", "2021-02-01", 1, "1e3", "1", "s", 3.0).team_elo == 1000
    with pytest.raises(ValueError):
        RunParams("2021-01-01", "2021-02-01", 1, 1, "1", "s", "nan")


def test_params_reject_reversed_range():
    with pytest.raises(ValueError):
        RunParams("2021-02-01", "2021-01-01", 1, 1, "1", "s", 1)


def test_default_allow_list_is_80_distinct_hex_ids():
    assert len(DEFAULT_VERSION_ALLOW_LIST) == 80
    assert len(set(DEFAULT_VERSION_ALLOW_LIST)) == 80
    assert all(len(v) == 32 and int(v, 16) >= 0 for v in DEFAULT_VERSION_ALLOW_LIST)
