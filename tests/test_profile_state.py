"""Running sums behind the profile: new versions of days, stopped runs, what is read."""

import datetime as dt

import pytest

from footfall.operators import profile
from footfall.plans import profile_state
from footfall.plans.profile_state import settle_profile
from footfall.sinks.tables import complete_versions, drop_versions, write_layer
from footfall.sources.tables import read_layer
from tests.conftest import rows

ONE, TWO, THREE = (dt.date(2026, 7, d) for d in (10, 11, 12))


def at(user, time, day=10, kind="page_view", device="m"):
    return (user, kind, f"2026-07-{day} {time}", {"device_model": device})


@pytest.fixture
def step(spark, tmp_path, make_events):
    """One version of some days; the profile afterwards, and what it must be by the stored days."""
    root = str(tmp_path)

    def run(days, *events, store=True):
        fresh = profile.user_days(make_events(list(events)))
        got = rows(profile.profile_of_parts(settle_profile(spark, root, fresh, days)))
        if store:
            for day in days:
                write_layer(fresh.filter(fresh["stat_date"] == day), root, "dws_user_days", day)
            assert got == rows(profile.profile_of_days(read_layer(spark, root, "dws_user_days")))
        return got

    run.root = root
    return run


def totals(got):
    return {r[0]: (r[3], r[4], r[8], str(r[9])[8:16], str(r[10])[8:16]) for r in got}


def test_new_versions_add_and_take_away(step):
    step([ONE], at("a", "10:00:00"), at("a", "11:00:00", device="n"), at("a", "11:30:00", device="n"), at("b", "09:00:00"))
    step([TWO], at("a", "08:00:00", 11), at("c", "08:00:00", 11))
    # Of a the first event and the device n go, b goes altogether, d comes.
    got = totals(step([ONE], at("a", "10:30:00"), at("d", "12:00:00")))
    assert got["a"] == (2, 2, "m", "10 10:30", "11 08:00") and "b" not in got and got["d"][0] == 1
    # The last event of a goes, and with it a day.
    got = totals(step([TWO], at("c", "08:00:00", 11)))
    assert got["a"] == (1, 1, "m", "10 10:30", "10 10:30")
    assert totals(step([TWO]))["a"][0] == 1  # an empty version takes the day away
    assert set(totals(step([ONE, THREE], at("e", "07:00:00", 12)))) == {"e"}
    assert step([ONE, TWO, THREE]) == []


def test_a_stopped_run_counts_once(step):
    step([ONE], at("a", "10:00:00"))
    step([TWO], at("a", "10:00:00", 11), store=False)  # stopped before the day was stored
    assert totals(step([TWO], at("a", "10:00:00", 11)))["a"][:2] == (2, 2)
    step([TWO], at("a", "10:00:00", 11), at("a", "11:00:00", 11), store=False)  # stopped, and then the day changed
    assert totals(step([TWO], at("a", "12:00:00", 11)))["a"] == (2, 2, "m", "10 10:00", "11 12:00")


def test_lost_sums_are_made_anew(spark, step):
    step([ONE], at("a", "10:00:00"))
    step([TWO], at("b", "10:00:00", 11))
    path = f"{step.root}/dws_profile_parts"
    drop_versions(spark, path, complete_versions(spark, path))
    assert set(totals(step([THREE], at("c", "10:00:00", 12)))) == {"a", "b", "c"}


def test_null_devices_and_types(step):
    got = totals(step([ONE], at("a", "10:00:00", device=None), at("a", "10:00:01", kind="app_download", device=None), at("a", "10:00:02", device="z")))
    assert got["a"][:3] == (3, 1, None)


def test_history_is_not_read(spark, step, monkeypatch):
    """A new day, and a rerun that keeps all first and last events, scan their own day's folder and the sums."""
    step([ONE], at("a", "10:00:00"))
    step([TWO], at("a", "10:00:00", 11))
    plans = []
    merge = profile_state.merge_parts
    plan = lambda parts: parts._jdf.queryExecution().sparkPlan().toString()
    monkeypatch.setattr(profile_state, "merge_parts", lambda parts: plans.append(plan(parts)) or merge(parts))
    step([THREE], at("a", "10:00:00", 12))
    step([THREE], at("a", "10:00:00", 12), at("a", "11:00:00", 12))
    for text in plans:
        scans = [line for line in text.split("\n") if "FileScan" in line]
        days = [line for line in scans if "dt#" in line]
        assert len(scans) == 2 and len(days) == 1  # the day's old version and the sums
        assert "= 2026-07-12)" in days[0].split("PartitionFilters")[1] and "NOT" not in days[0]
