import datetime as dt

from footfall.operators import daily, profile, ranking, windows
from tests.conftest import rows

DAY = "2026-07-10"


def test_day_without_page_views_and_ties(make_events):
    events = make_events(
        [("a", "app_click", f"{DAY} 10:00:00", {"city": "y", "device_model": "n"}),
         ("b", "app_download", f"{DAY} 10:00:00", {"city": "x", "device_model": "m"})]
    )
    row = daily.daily_summary(events).collect()[0]
    assert (row.pv, row.uv, row.avg_duration, row.top_city, row.top_device) == (2, 2, 0.0, "x", "m")
    assert (row.download_count, row.search_count, row.event_type) == (1, 0, "all")


def test_no_events_no_row(make_events):
    assert daily.daily_summary(make_events([])).count() == 0


def test_new_users_are_first_seen(make_events):
    events = make_events([("a", "page_view", "2026-07-10 10:00:00"), ("a", "page_view", "2026-07-11 10:00:00"),
                          ("b", "page_view", "2026-07-11 10:00:00")])
    assert rows(daily.daily_summary(events), "uv", "new_user_count") == [(1, 1), (2, 1)]
    assert rows(daily.daily_summary(events, approx_new=True), "uv", "new_user_count") == [(1, 1), (2, 2)]


def test_cube_totals(make_events):
    events = make_events([("a", "page_view", f"{DAY} 10:00:00", {"city": c}) for c in "xxy"])
    got = rows(daily.drill_down(events, ["city"]), "city", "level", "pv", "uv")
    assert got == [("all", 1, 3, 1), ("x", 0, 2, 1), ("y", 0, 1, 1)]


def test_sketches_merge(make_events):
    events = make_events([(f"u{i % 700}", "page_view", f"2026-07-{10 + i % 2} 10:00:00") for i in range(1400)])
    per_day = daily.uv_sketches(events)
    estimate = daily.uv_from_sketches(per_day).collect()[0].uv_estimate
    assert abs(estimate - 700) < 14
    for row in daily.uv_approx(events).collect():
        assert abs(row.uv_approx - 350) < 14


def test_profile_labels(make_events):
    rows_of = lambda u, kind, n: [(u, kind, f"{DAY} 10:00:00")] * n
    events = make_events(
        rows_of("a", "page_view", 100) + rows_of("b", "search_query", 30) + rows_of("c", "app_download", 5)
        + rows_of("d", "in_app_purchase", 1) + rows_of("e", "search_query", 2)
    )
    got = rows(profile.user_profile(events), "user_id", "activity_level", "user_type")
    assert got == [("a", "高活跃", "浏览型用户"), ("b", "中活跃", "搜索型用户"), ("c", "低活跃", "下载型用户"),
                   ("d", "沉睡用户", "付费用户"), ("e", "沉睡用户", "浏览型用户")]


def test_profile_takes_most_used_device(make_events):
    events = make_events([("a", "page_view", f"2026-07-{d} 10:00:00", {"device_model": m})
                          for d, m in ((10, "z"), (11, "y"), (12, "y"))])
    row = profile.user_profile(events).collect()[0]
    assert (row.device_model, row.active_days, row.total_events) == ("y", 3, 3)


def test_sliding_windows_hold_each_row_five_times(make_events):
    name = {"properties": '{"app_name":"A"}'}
    events = make_events([("u", "app_download", f"{DAY} 14:02:30", name), ("u", "app_download", f"{DAY} 14:07:00", {"properties": "{"})])
    got = rows(windows.download_stats(events), "app_name", "window_start")
    assert got[:5] == [("A", dt.datetime(2026, 7, 10, 13 if m == 58 or m == 59 else 14, m)) for m in (58, 59, 0, 1, 2)]
    assert [a for a, _ in got[5:]] == ["unknown"] * 5
    sliding = windows.pv_uv_windowed(events, "5 minutes", "1 minute")
    assert sum(r.pv for r in sliding.collect()) == 10
    assert sum(r.pv for r in windows.pv_uv_windowed(events).collect()) == 2


def alerts(make_events, counts, **more):
    rows_ = []
    for minute, n in counts.items():
        rows_ += [("u", "app_download", f"{DAY} 14:{minute:02d}:00")] * n
    return rows(windows.download_anomaly(make_events(rows_), **more), "previous_count", "current_count", "change_rate", "alert_type")


def test_drop_alert(make_events):
    assert alerts(make_events, {0: 100, 5: 30}) == [(100, 30, -0.7, "ALERT")]
    assert alerts(make_events, {0: 100, 5: 50}) == [(100, 50, -0.5, "INFO")]
    assert alerts(make_events, {0: 100}) == []


def test_empty_window_is_skipped(make_events):
    assert alerts(make_events, {0: 100, 10: 40}) == [(100, 40, -0.6, "ALERT")]


def test_surge_alert(make_events):
    assert alerts(make_events, {0: 10, 5: 30}, threshold_up=1.0) == [(10, 30, 2.0, "ALERT")]
    assert alerts(make_events, {0: 10, 5: 20}, threshold_up=1.0) == [(10, 20, 1.0, "INFO")]


def test_three_falls(make_events):
    rows_ = []
    for minute, n in {0: 100, 5: 80, 10: 60, 15: 30, 20: 29}.items():
        rows_ += [("u", "app_download", f"{DAY} 14:{minute:02d}:00")] * n
    got = rows(windows.declining_runs(make_events(rows_)), "from_count", "current_count")
    assert got == [(80, 29), (100, 30)]


def test_top_downloads_ties_and_missing_name(make_events):
    named = lambda n: {"properties": f'{{"app_name":"{n}"}}'}
    events = make_events([("u", "app_download", f"{DAY} 10:00:00", named("b")), ("u", "app_download", f"{DAY} 10:00:00", named("a")),
                          ("u", "app_download", f"{DAY} 10:00:00"), ("u", "app_download", "2026-07-01 10:00:00", named("old"))])
    top = [tuple(r) for r in ranking.top_downloads(events, DAY, limit=2).collect()]
    assert top == [("", 1), ("a", 1)]
    assert [r.app_name for r in ranking.top_downloads_of_day(events, DAY).collect()] == [None, "a", "b"]


def test_sample_is_repeatable(make_events):
    events = make_events([(f"u{i}", "page_view", f"{DAY} 10:00:00") for i in range(100)])
    first = rows(ranking.sample_users(events, 10, seed=1))
    assert first == rows(ranking.sample_users(events, 10, seed=1)) and len(first) == 10
    assert first != rows(ranking.sample_users(events, 10, seed=2))
    assert 0 < ranking.sample_fraction(events, 0.5, seed=1).count() < 100
