"""Streams: late rows, recovery, agreement with batch, snapshots."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from footfall.operators import sessions, windows
from footfall.plans.realtime_run import run_realtime
from footfall.plans.reports import get_realtime
from footfall.session import configure_streaming
from footfall.sinks import metrics
from footfall.sources.events import stream_events_jsonl
from footfall.sources.tables import read_layer
from footfall.streaming import anomaly, jobs, rollup
from footfall.streaming.ranking import stream_download_ranking
from footfall.streaming.sliding import stream_pv_uv_sliding
from tests.conftest import rows

DAY = "2026-07-10"


@pytest.fixture
def feed(spark, tmp_path, make_events):
    """Writes one JSON-lines file per call; ``stream()`` reads one file per micro-batch."""
    configure_streaming(spark)
    source = tmp_path / "in"
    source.mkdir()
    count = iter(range(1000))

    def write(*rows_):
        n = next(count)
        fixed = [(u, k, f"{DAY} {t}", {"event_id": f"{n}-{i}", **(m[0] if m else {})}) for i, (u, k, t, *m) in enumerate(rows_)]
        lines = [r.value for r in metrics.event_messages(make_events(fixed)).collect()]
        (source / f"{n:04d}.json").write_text("\n".join(lines))
        # File streams order by modification time.
        os.utime(source / f"{n:04d}.json", (1_700_000_000 + n, 1_700_000_000 + n))

    write.stream = lambda: stream_events_jsonl(spark, str(source), max_files=1)
    write.root = tmp_path
    return write


def run(spark, stream, root, name="job"):
    query = jobs.to_table(stream, f"{root}/{name}/out", f"{root}/{name}/ckpt", availableNow=True)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/{name}/out"), query


def test_late_rows(spark, feed):
    feed(("u", "page_view", "11:58:00"), ("u", "page_view", "12:00:00"))
    feed(("u", "page_view", "11:59:57"))
    feed(("u", "page_view", "11:54:00"), ("u", "page_view", "11:59:58"))
    feed(("u", "page_view", "13:00:00"))
    out, query = run(spark, windows.pv_uv_approx(jobs.clean_stateless(feed.stream()), "5 minutes"), feed.root)
    at = lambda h, m: dt.datetime(2026, 7, 10, h, m)
    assert rows(out, "window_start", "pv") == [(at(11, 55), 3), (at(12, 0), 1)]
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 1


def test_late_row_kept_one_batch_earlier(spark, feed):
    feed(("u", "page_view", "11:58:00"), ("u", "page_view", "12:00:00"))
    feed(("u", "page_view", "11:54:00"), ("u", "page_view", "11:59:57"))
    feed(("u", "page_view", "13:00:00"))
    out, _ = run(spark, windows.pv_uv_approx(jobs.clean_stateless(feed.stream()), "5 minutes"), feed.root)
    assert [n for _, n in rows(out, "window_start", "pv")] == [1, 2, 1]


def test_split_late(spark, feed):
    feed(("u", "page_view", "11:58:00"), ("u", "page_view", "12:00:00"))
    feed(("u", "page_view", "11:59:57"), ("u", "page_view", "11:54:00"))
    feed(("u", "page_view", "12:00:01"))
    root = f"{feed.root}/split"
    jobs.split_late(feed.stream(), root, f"{root}/ckpt", availableNow=True).awaitTermination()
    of = lambda name: rows(spark.read.parquet(f"{root}/{name}").select(F.date_format("event_time", "HH:mm:ss")))
    assert of("late") == [("11:54:00",)]
    assert of("on_time") == [("11:58:00",), ("11:59:57",), ("12:00:00",), ("12:00:01",)]


def test_late_rows_after_a_restart(spark, feed):
    """The watermark comes from the checkpoint; null times are not late, and rows keep all their columns."""
    feed(("u", "page_view", "11:58:00"), ("u", "page_view", "12:00:00", {"event_time": None}))
    feed(("u", "page_view", "12:00:00", {"duration": None}))
    first, _ = run(spark, jobs.mark_late(feed.stream()), feed.root)
    assert first.filter("is_late").count() == 0 and first.filter("event_time is null").count() == 1
    feed(("u", "page_view", "11:59:57"), ("v", "app_click", "11:54:00", {"city": "x"}), ("u", "page_view", "11:59:55"))
    out, _ = run(spark, jobs.mark_late(feed.stream()), feed.root)
    assert out.count() == 6 and out.columns == [*feed.stream().columns, "is_late"]
    assert rows(out.filter("is_late"), "user_id", "event_type", "duration", "city") == [("v", "app_click", 0, "x")]


def test_late_marks_keep_values(spark, tmp_path):
    """Nulls and longs beyond a double's digits come through."""
    configure_streaming(spark)
    at = F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("event_time")
    some = lambda c: F.when(F.col("id") % 3 != 0, c)
    events = spark.range(50).select(
        F.col("id").cast("string").alias("event_id"), at, some(F.col("id").cast("int")).alias("n"), some(F.col("id") + (1 << 53) + 1).alias("big")
    )
    events.write.parquet(f"{tmp_path}/in")
    out, _ = run(spark, jobs.mark_late(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")), tmp_path)
    assert rows(out.drop("is_late").select(F.struct("*").cast("string"))) == rows(events.select(F.struct("*").cast("string")))


def test_recovery_equals_single_run(spark, feed):
    """Stop after the first files, start again from the checkpoint."""
    build = lambda: windows.pv_uv_windowed(jobs.clean_stateless(feed.stream()))
    feed(("a", "page_view", "10:00:00"), ("b", "page_view", "10:01:00"), ("a", "page_view", "10:07:00"))
    run(spark, build(), feed.root, "restarted")
    feed(("c", "page_view", "10:08:00"), ("a", "page_view", "11:00:00"))
    feed(("a", "page_view", "12:00:00"))
    restarted, _ = run(spark, build(), feed.root, "restarted")
    single, _ = run(spark, build(), feed.root, "single")
    assert rows(restarted) == rows(single)
    assert rows(single, "pv", "uv") == [(1, 1), (2, 2), (2, 2)]


def test_dedup_on_the_stream(spark, feed):
    feed(("u", "page_view", "10:00:00", {"event_id": "x"}), ("u", "page_view", "10:00:00", {"event_id": "x"}))
    feed(("u", "page_view", "10:00:02", {"event_id": "x"}), ("", "page_view", "10:00:02"), ("u", "nope", "10:00:02"))
    out, _ = run(spark, jobs.stream_clean(feed.stream()), feed.root)
    assert rows(out, "event_id") == [("x",)]


def test_session_edges_on_the_stream(spark, feed):
    feed(("u", "page_view", "08:00:00"), ("u", "page_view", "08:29:59"), ("u", "page_view", "08:59:59"))
    feed(("v", "page_view", "20:00:00"))
    out, _ = run(spark, sessions.session_windows(jobs.clean_stateless(feed.stream())), feed.root)
    assert [n for _, n in rows(out, "session_start", "event_count")] == [2, 1]


def test_alerts_across_batches(spark, feed):
    """The previous count lives in the state: the drop shows although its windows close in different batches."""
    many = lambda n, t: [("u", "app_download", t)] * n
    feed(*many(100, "14:00:00"))
    feed(*many(30, "14:05:00"))
    feed(*many(40, "14:15:00"))
    feed(("u", "page_view", "15:00:00"))
    out, _ = run(spark, anomaly.stream_anomaly(jobs.clean_stateless(feed.stream())), feed.root)
    assert rows(out, "previous_count", "current_count", "alert_type") == [(30, 40, "INFO"), (100, 30, "ALERT")]
    messages = [r.value for r in metrics.alert_messages(out).collect()]
    assert any('"type":"ALERT"' in m and '"change_rate":"-70.00%"' in m and '"previous":100' in m for m in messages)
    assert any('"type":"INFO"' in m and "previous" not in m for m in messages)


def test_interval_join(spark, feed):
    feed(("u", "app_click", "10:00:00"), ("v", "app_click", "10:00:00"), ("u", "app_download", "10:05:00"), ("u", "app_download", "10:06:00"))
    feed(("v", "app_download", "10:20:00"))
    of = lambda kind: jobs.clean_stateless(feed.stream()).filter(F.col("event_type") == kind)
    out, _ = run(spark, jobs.followed_within(of("app_click"), of("app_download"), "10 minutes"), feed.root)
    assert rows(out, "user_id") == [("u",)]


def test_interval_join_of_a_hot_user(spark, feed):
    """Whatever bucket and slice, each row comes out once; one user's rows lie in many state partitions."""
    clicks = [("hot", "app_click", f"10:{m:02d}:{s:02d}") for m in range(30) for s in range(0, 60, 5)]
    after = [("hot", "app_download", f"10:{m:02d}:30") for m in range(0, 30, 2)]
    feed(*clicks, *after, *[(f"u{i}", "app_click", "10:00:00") for i in range(300)])
    of = lambda kind: jobs.clean_stateless(feed.stream()).filter(F.col("event_type") == kind)
    out, _ = run(spark, jobs.followed_within(of("app_click"), of("app_download"), "100 seconds", slices=16), feed.root)
    at = lambda t: int(t[3:5]) * 60 + int(t[6:])
    want = sorted(t for _, _, t in clicks if any(at(t) < at(d) <= at(t) + 100 for _, _, d in after))
    assert [r[0] for r in rows(out.select(F.date_format("event_time", "HH:mm:ss")))] == want

    a = of("app_click").select("user_id").schema
    assert a == out.select("user_id").schema
    state = spark.read.format("statestore").option("operatorId", 0).option("joinSide", "left").load(f"{feed.root}/job/ckpt")
    per_task = [r["count"] for r in state.filter("value.user_id = 'hot'").groupBy("partition_id").count().collect()]
    assert len(per_task) == 4 and max(per_task) <= 2 * sorted(per_task)[len(per_task) // 2]


def test_incremental_daily(spark, feed):
    root = f"{feed.root}/daily"
    feed(("a", "page_view", "10:00:00"), ("b", "app_download", "10:01:00"))
    feed(("a", "search_query", "10:02:00"))
    for _ in range(2):  # the second start finds nothing new
        jobs.incremental_daily(jobs.clean_stateless(feed.stream()), root, f"{root}-ckpt", availableNow=True).awaitTermination()
    assert rows(jobs.read_incremental_daily(spark, root), "pv", "uv", "download_count", "search_count") == [(3, 2, 1, 1)]


def test_landing(spark, feed):
    feed(("a", "page_view", "10:00:00"))
    path = f"{feed.root}/ods"
    jobs.land(feed.stream(), path, f"{path}-ckpt", availableNow=True).awaitTermination()
    assert rows(spark.read.parquet(path).select(F.col("dt").cast("string"), "user_id")) == [(DAY, "a")]


def test_realtime_jobs_and_snapshot(spark, feed):
    name = {"properties": '{"app_name":"A"}'}
    feed(("a", "page_view", "10:00:00"), ("b", "app_download", "10:01:00", name), ("a", "ad_click", "10:06:00"))
    feed(("a", "page_view", "12:00:00"))
    feed(("a", "page_view", "12:00:30"))
    root = str(feed.root)
    for query in run_realtime(feed.stream(), root, f"{root}/ckpt", availableNow=True):
        query.awaitTermination()
    pv_uv = spark.read.parquet(f"{root}/realtime/pv_uv")
    assert rows(pv_uv.filter("metric_name = 'pv'"), "metric_value", "window_size") == [(1.0, "5m"), (2.0, "5m")]
    downloads = spark.read.parquet(f"{root}/realtime/downloads")
    assert downloads.filter("dimension_value = 'A' and metric_value = 1").count() == 5
    funnel = spark.read.parquet(f"{root}/realtime/funnel").filter("metric_name = 'click'")
    assert rows(funnel, "metric_value", "window_size") == [(1.0, "10m")]
    table = read_layer(spark, root, "ads_realtime_metrics", DAY, DAY)
    assert rows(table.filter("metric_name = 'pv' and window_size = '5m'"), "metric_value") == [(1.0,), (2.0,)]
    assert {r.metric_name for r in table.collect()} >= {"pv", "uv", "download_count", "click"}
    assert read_layer(spark, root, "ads_realtime_metrics", "2026-07-11").count() == 0
    shown = lambda now: rows(get_realtime(spark, f"{root}/latest", now))
    assert shown(f"{DAY} 10:10:00") == [(1, 1)]
    assert shown(f"{DAY} 11:00:00") == [(0, 0)]


def test_latest_values_survive_batches_without_them(spark, tmp_path):
    """App1 in the first batch, App2 in the second: both stay; an old value goes once it has expired."""
    at = lambda minute: dt.datetime(2026, 7, 10, 10, minute)
    columns = "metric_name string, dimension string, dimension_value string, window_size string, metric_time timestamp, metric_value double"
    put = lambda n, *values: metrics.merge_latest(
        spark, metrics.latest_values(spark.createDataFrame([("d", "app", a, "5m", at(m), v) for a, m, v in values], columns), "10 minutes"), str(tmp_path), n
    )
    shown = lambda at="10:06": rows(metrics.read_latest(spark, str(tmp_path), f"{DAY} {at}:00"), "dimension_value", "metric_value")
    assert shown() == []
    put(0, ("App1", 0, 1.0), ("", 0, 7.0))
    put(1, ("App2", 5, 2.0))
    assert shown() == [("", 7.0), ("App1", 1.0), ("App2", 2.0)]
    put(1, ("App2", 5, 2.0))  # once more
    put(0, ("App1", 12, 3.0))  # a new checkpoint counts from 0 again
    assert shown() == [("", 7.0), ("App1", 3.0), ("App2", 2.0)]
    assert shown("10:11") == [("App1", 3.0), ("App2", 2.0)]


def test_latest_values_survive_a_wrong_clock(spark, tmp_path):
    """A row from the far future is left out; one a month ahead, still in the past of the sink, takes nothing with it."""
    columns = "metric_name string, dimension string, dimension_value string, window_size string, metric_time timestamp, metric_value double"
    put = lambda n, *values: metrics.merge_latest(
        spark, metrics.latest_values(spark.createDataFrame([("d", "app", a, "5m", dt.datetime(*t), v) for a, t, v in values], columns), "11 minutes"), str(tmp_path), n
    )
    put(0, ("App1", (2024, 7, 10, 12, 0), 3.0), ("App2", (2024, 7, 10, 12, 0), 4.0))
    put(1, ("App1", (2024, 7, 10, 12, 5), 5.0), ("App3", (2024, 8, 10), 1.0), ("App1", (2999, 1, 1), 9.0))
    shown = lambda now: rows(metrics.read_latest(spark, str(tmp_path), now), "dimension_value", "metric_value")
    assert shown("2024-07-10 12:08:00") == [("App1", 5.0), ("App2", 4.0), ("App3", 1.0)]
    assert shown("2024-07-10 12:14:00") == [("App1", 5.0), ("App3", 1.0)]


def sliding_by_hand(events, size, slide, until):
    """(start, pv, uv) of windows that end by ``until``; events are (user, second)."""
    found = []
    for end in range(slide, until + 1, slide):
        inside = [u for u, t in events if end - size <= t < end]
        if inside:
            found.append((end - size, len(inside), len(set(inside) - {None})))
    return found


def test_sliding_windows_over_batches(spark, feed):
    """Users come back within a window, right at its edge and after it; batches close panes a few at a time."""
    base = dt.datetime(2026, 7, 10, 10)
    batches = [
        [("a", 0), ("a", 4), ("b", 7), ("a", 11)], [("a", 30), ("b", 29), ("c", 33), ("a", 28)], [("a", 59), ("b", 64)],
        [("c", 300), ("a", 302)], [("a", 331), ("a", 360)], [("d", 420)], [("d", 433)],
    ]
    for batch in batches:
        feed(*[(u, "page_view", f"{base + dt.timedelta(seconds=t):%H:%M:%S}") for u, t in batch])
    clean = jobs.clean_stateless(feed.stream())
    out, _ = run(spark, stream_pv_uv_sliding(clean, "30 seconds", "5 seconds"), feed.root)
    seconds = lambda t: round((t - base).total_seconds())
    got = sorted((seconds(r.window_start), r.pv, r.uv) for r in out.collect())
    assert got == sliding_by_hand([e for b in batches for e in b], 30, 5, 428)
    assert {r.window_end - r.window_start for r in out.collect()} == {dt.timedelta(seconds=30)}
    with pytest.raises(ValueError):
        stream_pv_uv_sliding(clean, "31 seconds", "5 seconds")


def test_sliding_windows_after_a_restart(spark, feed):
    build = lambda: stream_pv_uv_sliding(jobs.clean_stateless(feed.stream()), "30 seconds", "10 seconds")
    feed(("a", "page_view", "10:00:00"), ("b", "page_view", "10:00:12"))
    run(spark, build(), feed.root, "restarted")
    feed(("a", "page_view", "10:00:25"), ("b", "page_view", "10:00:26"), ("a", "page_view", "10:01:40"))
    run(spark, build(), feed.root, "restarted")
    feed(("a", "page_view", "10:03:00"))
    restarted, _ = run(spark, build(), feed.root, "restarted")
    single, _ = run(spark, build(), feed.root, "single")
    assert rows(restarted) == rows(single) and len(rows(single)) > 5


def test_sliding_state_is_one_row_per_user(spark, feed):
    feed(*[(f"u{i % 3}", "page_view", f"10:00:{i:02d}") for i in range(50)])
    feed(("u0", "page_view", "10:02:00"))
    _, query = run(spark, stream_pv_uv_sliding(jobs.clean_stateless(feed.stream()), "5 minutes", "5 seconds"), feed.root)
    states = [p["stateOperators"] for p in query.recentProgress]
    # Operators from the sink back: running sum, window ends, users, panes.
    users = [s for s in states[-1] if s["operatorName"] == "transformWithStateInPandasExec"]
    assert len(users) == 2 and all(s["numRowsTotal"] <= 12 for s in users)


def test_ranking_of_closed_windows(spark, feed):
    app = lambda name: {"properties": f'{{"app_name":"{name}"}}'}
    feed(*[("u", "app_download", f"10:00:{i:02d}", app(a)) for i, a in enumerate("AABBBCDDE")])
    feed(("u", "app_download", "10:04:59", app("E")), ("u", "app_download", "10:05:00", app("Z")), ("u", "page_view", "10:05:06"))
    feed(("u", "page_view", "10:11:00"))
    out, _ = run(spark, stream_download_ranking(jobs.clean_stateless(feed.stream()), "5 minutes", "5 minutes", 3), feed.root)
    assert [tuple(r) for r in out.orderBy("window_start", "rank").select("app_name", "download_count", "rank").collect()] == [("B", 3, 1), ("A", 2, 2), ("D", 2, 3), ("Z", 1, 1)]


def test_rollup_levels(spark, feed):
    """Hours add up closed five minutes; a user of several windows counts once; a level ends where the one below has."""
    feed(("a", "page_view", "10:00:00"), ("b", "app_download", "10:00:10", {"city": "x"}), ("a", "search_query", "10:20:00"))
    feed(("a", "page_view", "10:59:59"), ("c", "page_view", "11:00:00"))
    feed(("c", "page_view", "11:10:00"))
    root = f"{feed.root}/rollup"
    for _ in range(2):  # the second start finds nothing new
        queries = rollup.run_rollup(jobs.clean_stateless(feed.stream()), root, f"{root}-ckpt", ("5 minutes", "1 hour"), availableNow=True)
        for query in queries:
            query.awaitTermination()
    cells = rollup.read_rollup(spark, root, ("5 minutes", "1 hour"))
    got = rows(cells.filter("dimension = 'all'").select("window_size", F.date_format("metric_time", "HH:mm").alias("t"), "pv", "uv_estimate", "download_count", "search_count"))
    assert got == [("1h", "10:00", 4, 2, 1, 1), ("5m", "10:00", 2, 2, 1, 0), ("5m", "10:20", 1, 1, 0, 1), ("5m", "10:55", 1, 1, 0, 0), ("5m", "11:00", 1, 1, 0, 0)]
    assert rows(cells.filter("dimension = 'city' and dimension_value = 'x' and window_size = '1h'"), "pv") == [(1,)]
    with pytest.raises(ValueError):
        rollup.run_rollup(feed.stream(), root, root, ("5 minutes", "7 minutes"))


def test_realtime_jobs_share_one_cleaning(spark, feed):
    """One query reads the source and holds the ids; the others read what it lands, and restart on their own."""
    root = str(feed.root)
    feed(("a", "page_view", "10:00:00", {"event_id": "x"}), ("a", "page_view", "10:00:00", {"event_id": "x"}))
    feed(("b", "page_view", "10:10:00"))
    queries = run_realtime(feed.stream(), root, f"{root}/ckpt", availableNow=True)
    for query in queries:
        query.awaitTermination()
    sources = [{s["description"] for p in q.recentProgress for s in p["sources"]} for q in queries]
    assert [any("/in]" in d for d in found) for found in sources] == [True, False, False, False, False]
    operators = [{o["operatorName"] for p in q.recentProgress for o in p["stateOperators"]} for q in queries]
    assert ["dedupeWithinWatermark" in names for names in operators] == [True, False, False, False, False]
    feed(("b", "page_view", "10:20:00"))
    for query in run_realtime(feed.stream(), root, f"{root}/ckpt", availableNow=True):
        query.awaitTermination()
    pv = spark.read.parquet(f"{root}/realtime/pv_uv").filter("metric_name = 'pv'")
    assert rows(pv, "metric_value") == [(1.0,), (1.0,)]


def test_running_counts_with_a_new_checkpoint(spark, feed):
    root = f"{feed.root}/daily"
    feed(("a", "page_view", "10:00:00"), ("b", "app_download", "10:01:00"), ("a", "page_view", "10:03:00"))
    start = lambda name: jobs.incremental_daily(jobs.clean_stateless(feed.stream()), root, f"{root}-{name}", availableNow=True).awaitTermination()
    start("one")
    feed(*[("c", "page_view", f"11:0{i}:00") for i in range(5)])
    start("two")
    assert rows(jobs.read_incremental_daily(spark, root), "pv", "uv") == [(8, 3)]


def test_newest_copy_on_the_stream(spark, feed):
    copy = lambda city, server: ("u", "page_view", "10:00:00", {"event_id": "x", "city": city, "server_time": dt.datetime(2026, 7, 10, 10, 0, server)})
    feed(copy("old", 1), copy("new", 3), copy("mid", 2))
    feed(("u", "page_view", "10:00:30"))
    out, _ = run(spark, jobs.stream_clean_newest(feed.stream()), feed.root)
    assert rows(out, "event_id", "city") == [("x", "new")]


def _daily_folders(root):
    return sorted(int(n.split("=")[1]) for n in os.listdir(f"{root}/dt=2026-07-10") if n.startswith("batch="))


def _write_batch(spark, root, number, *users):
    rows_ = [(dt.date(2026, 7, 10), user, n, 0, 0) for user, n in users]
    frame = spark.createDataFrame(rows_, "stat_date date, user_id string, events long, downloads long, searches long")
    frame.write.mode("overwrite").parquet(f"{root}/dt=2026-07-10/batch={number}")
    os.remove(f"{root}/dt=2026-07-10/batch={number}/_SUCCESS")  # a stream's batch has its mark at the table


def test_folders_stay_few(spark, tmp_path):
    """Eighteen batches, merged by fours: few folders, the same counts at every step, stopped merges do no harm."""
    root, run = str(tmp_path / "daily"), 7 * 2_000_000_000
    for i in range(18):
        _write_batch(spark, root, run + 2 * i, (f"u{i % 4}", i + 1), ("all", i + 1))
        before = rows(jobs.read_incremental_daily(spark, root))
        if i == 9:  # a merge that was stopped: without its mark it hides nothing
            _write_batch(spark, root, run + 2 * i + 1, ("all", i + 1))
        jobs.compact_daily(spark, root, 4)
        assert rows(jobs.read_incremental_daily(spark, root)) == before
        assert len(_daily_folders(root)) <= 2 * 4 + 3
    assert before[0][1:3] == (18 + 18 + 17 + 16 + 15, 5)
    assert run not in _daily_folders(root) and run + 34 in _daily_folders(root)


def test_a_running_stream_merges_its_folders(spark, feed):
    root = f"{feed.root}/daily"
    for i in range(7):
        feed(("a", "page_view", f"10:0{i}:00"), (f"u{i}", "page_view", f"10:0{i}:30"))
    jobs.incremental_daily(jobs.clean_stateless(feed.stream()), root, f"{root}-ckpt", 2, availableNow=True).awaitTermination()
    assert rows(jobs.read_incremental_daily(spark, root), "pv", "uv") == [(14, 8)]
    numbers = _daily_folders(root)
    assert any(n % 2 for n in numbers) and len(numbers) <= 5
