import datetime as dt
import random

from footfall.operators.sessions import sessionize, sessions
from tests.conftest import rows

START = dt.datetime(2026, 7, 10, 8)


def test_gap_edges(make_events):
    """29:59 continues, 30:00 and 30:01 open new sessions."""
    times, at = [START], START
    for minutes, seconds in ((29, 59), (30, 0), (30, 1)):
        at += dt.timedelta(minutes=minutes, seconds=seconds)
        times.append(at)
    events = make_events([("u", "page_view", str(t)) for t in times])
    assert [n for _, n in rows(sessions(events), "session_start", "event_count")] == [2, 1, 1]
    assert sessionize(events).select("session_id").distinct().count() == 3


def test_against_brute_force(make_events):
    rng = random.Random(9)
    raw = [(f"u{rng.randrange(5)}", rng.randrange(200_000)) for _ in range(800)]
    events = make_events([(u, "page_view", str(START + dt.timedelta(seconds=s))) for u, s in raw])
    want = []
    for user in {u for u, _ in raw}:
        at = sorted(s for u, s in raw if u == user)
        runs = [[at[0]]]
        for before, now in zip(at, at[1:]):
            if now - before >= 1800:
                runs.append([])
            runs[-1].append(now)
        want += [(user, START + dt.timedelta(seconds=r[0]), START + dt.timedelta(seconds=r[-1]), len(r)) for r in runs]
    assert rows(sessions(events), "user_id", "session_start", "session_end", "event_count") == sorted(want)
    per_row = sessionize(events).groupBy("session_id").count()
    assert sorted(r["count"] for r in per_row.collect()) == sorted(n for *_, n in want)


def test_rows_without_user_stay(make_events):
    events = make_events([(None, "page_view", str(START)), ("u", "page_view", str(START))])
    got = [r.session_id for r in sessionize(events).orderBy("event_id").collect()]
    assert got[0] is None and got[1].startswith("sess_")
