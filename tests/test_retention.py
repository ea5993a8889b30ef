import datetime as dt

import pytest

from footfall.operators.retention import retention, retention_matrix
from tests.conftest import rows

BASE = dt.date(2026, 7, 10)


@pytest.fixture
def thousand(make_events):
    """1,000 users, of whom 400 / 250 / 150 / 80 return on day 1 / 3 / 7 / 30."""
    visits = [(f"u{i}", 0) for i in range(1000)]
    for day, count in ((1, 400), (3, 250), (7, 150), (30, 80)):
        visits += [(f"u{i}", day) for i in range(count)]
    return make_events([(u, "page_view", f"{BASE + dt.timedelta(days=n)} 12:00:00") for u, n in visits])


def test_documented_example(thousand):
    got = rows(retention(thousand, [BASE]), "ret_day", "new_user_count", "retained_count", "retention_rate")
    assert got == [(1, 1000, 400, 40.0), (3, 1000, 250, 25.0), (7, 1000, 150, 15.0), (30, 1000, 80, 8.0)]


def test_day_30_is_the_ninth_of_august(thousand):
    on_target = thousand.filter("event_time < '2026-08-10'")
    assert rows(retention(on_target, [BASE], (30,)), "retained_count") == [(80,)]


def test_empty_day_gives_zero(thousand):
    assert rows(retention(thousand, ["2026-01-01"]), "ret_day", "new_user_count", "retention_rate") == [
        (n, 0, 0.0) for n in (1, 3, 7, 30)
    ]


def test_first_seen_cohort(make_events):
    events = make_events(
        [("a", "page_view", "2026-07-10 01:00:00"), ("a", "page_view", "2026-07-11 01:00:00"),
         ("b", "page_view", "2026-07-11 01:00:00"), ("b", "page_view", "2026-07-12 01:00:00"),
         ("a", "page_view", "2026-07-12 01:00:00")]
    )
    got = rows(retention(events, ret_days=(1,), cohort="first_seen"), "first_date", "new_user_count", "retained_count")
    assert got == [(dt.date(2026, 7, 10), 1, 1), (dt.date(2026, 7, 11), 1, 1)]


@pytest.mark.parametrize("cohort", ["active", "first_seen"])
def test_against_brute_force_over_block_edges(make_events, cohort):
    """Long spans: base and return days fall in different mask blocks, N above 64 too."""
    import random

    rng = random.Random(1)
    start = dt.date(1999, 12, 1)
    active = {(f"u{rng.randrange(12)}", rng.randrange(150)) for _ in range(500)}
    events = make_events([(u, "page_view", f"{start + dt.timedelta(days=d)} 05:00:00") for u, d in active])
    ret_days = (1, 31, 32, 33, 64, 65, 97)
    first = {u: min(d for v, d in active if v == u) for u, _ in active}
    bases = active if cohort == "active" else set(first.items())
    want = []
    for day in {d for _, d in bases}:
        users = [u for u, d in bases if d == day]
        for n in ret_days:
            want.append((start + dt.timedelta(days=day), n, len(users), sum((u, day + n) in active for u in users)))
    got = rows(
        retention(events, ret_days=ret_days, cohort=cohort), "first_date", "ret_day", "new_user_count", "retained_count"
    )
    assert got == sorted(want)


def test_matrix(thousand):
    row = retention_matrix(thousand, BASE, BASE, 7).collect()[0]
    assert (row.new_user_count, row.day_1, row.day_2, row.day_3, row.day_7) == (1000, 40.0, 0.0, 25.0, 15.0)
