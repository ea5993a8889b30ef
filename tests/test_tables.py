"""Layer tables, sources, messages and the daily run."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from footfall.plans import reports
from footfall.plans.daily_run import run_daily
from footfall.sinks import metrics, tables
from footfall.sources import events as sources
from footfall.sources.tables import day_slices, read_buckets, read_jdbc_table, read_layer
from footfall.sources.testdata import ods
from tests.conftest import SF, rows

DAY = "2026-07-10"


def test_overwrites_only_touched_days(spark, tmp_path, make_events):
    root = str(tmp_path)
    write = lambda *rows_: tables.write_layer(make_events(list(rows_)), root, "ods_user_behavior_log")
    write(("a", "page_view", "2026-07-10 10:00:00"), ("a", "page_view", "2026-07-11 10:00:00"))
    write(("b", "page_view", "2026-07-11 10:00:00"), ("c", "page_view", "2026-07-11 10:00:00"))
    got = rows(read_layer(spark, root, "ods_user_behavior_log"), "dt", "user_id")
    assert got == [("2026-07-10", "a"), ("2026-07-11", "b"), ("2026-07-11", "c")]
    one = read_layer(spark, root, "ods_user_behavior_log", "2026-07-11", "2026-07-11")
    assert len(one.inputFiles()) >= 1 and one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_empty_day_replaces_its_folder(spark, tmp_path, make_events):
    root, table = str(tmp_path), "dwd_user_behavior"
    tables.write_layer(make_events([("a", "page_view", f"{DAY} 10:00:00")]), root, table, DAY)
    tables.write_layer(make_events([]), root, table, DAY)
    assert read_layer(spark, root, table).count() == 0
    assert read_layer(spark, root, "dws_daily_metrics").count() == 0


def test_drop_expired(spark, tmp_path, make_events):
    root, table = str(tmp_path), "ods_user_behavior_log"
    tables.write_layer(make_events([("a", "page_view", f"2026-0{m}-10 10:00:00") for m in (5, 6, 7)]), root, table)
    assert tables.drop_expired(spark, root, table, "2026-07-10") == ["2026-05-10"]
    assert rows(read_layer(spark, root, table), "dt") == [("2026-06-10",), ("2026-07-10",)]


def test_merges(spark):
    df = spark.createDataFrame([("k", 1, 5, "b"), ("k", 2, 7, "a"), ("l", 1, 1, "c")], "key string, v int, n int, s string")
    assert rows(tables.replacing_merge(df, ["key"], "v"), "key", "n") == [("k", 7), ("l", 1)]
    assert rows(tables.summing_merge(df, ["key"], ["n"], ["s"], "v")) == [("k", 12, "b"), ("l", 1, "c")]


def test_bucketed_table_joins_without_shuffle(spark, make_events):
    events = make_events([("a", "page_view", f"{DAY} 10:00:00") for _ in range(20)])
    tables.write_bucketed(events, "bucketed_a", buckets=4)
    tables.write_bucketed(events, "bucketed_b", buckets=4)
    a, b = spark.table("bucketed_a"), spark.table("bucketed_b")
    joined = a.hint("merge").join(b.select("event_id"), "event_id")
    assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert joined.count() == 20


def test_buckets_as_samples(spark, make_events):
    """A sample reads the files of its buckets only, and has all rows of their keys and no others."""
    events = make_events([("a", "page_view", f"{DAY} 10:00:{i % 60:02d}", {"event_id": f"e{i % 150}"}) for i in range(300)])
    tables.write_bucketed(events.repartition(3), "bucketed_sample", buckets=16)
    whole = spark.table("bucketed_sample")
    sample = read_buckets(spark, "bucketed_sample", [2, 7, 11])
    bucket = F.pmod(F.hash("event_id"), F.lit(16))
    assert rows(sample, "event_id", "event_time") == rows(whole.filter(bucket.isin(2, 7, 11)), "event_id", "event_time")
    assert 0 < len(sample.inputFiles()) < len(whole.inputFiles()) / 3
    assert sample.columns == whole.columns and read_buckets(spark, "bucketed_sample", [99]).count() == 0


def test_jsonl_and_decode(spark, tmp_path):
    lines = [
        '{"event_id":"1","event_type":"page_view","user_id":"u","event_time":"2026-07-10 10:00:00","extra":1}',
        '{"event_id":"2","event_type":"page_view","user_id":"u","event_time":"not a time"}',
        "{broken",
        "17",
    ]
    (tmp_path / "a.json").write_text("\n".join(lines[:2]))
    read = sources.read_events_jsonl(spark, str(tmp_path))
    assert rows(read, "event_id", "event_time", "properties", "duration", "variant") == [
        ("1", dt.datetime(2026, 7, 10, 10), "{}", 0, ""),
        ("2", None, "{}", 0, ""),
    ]
    (tmp_path / "b.json").write_text("\n".join(["", *lines[2:]]))
    events, rejects = sources.decode_jsonl(spark, str(tmp_path))
    assert events.count() == 2 and rows(rejects) == [("17",), ("{broken",)]
    messages = spark.createDataFrame([(None, bytearray(x.encode())) for x in lines] + [(None, None)], "key binary, value binary")
    good, rejects = sources.decode_events(messages)
    assert [r.event_id for r in good.orderBy("event_id").collect()] == ["1", "2"]
    assert sorted(str(r.raw) for r in rejects.collect()) == ["17", "None", "{broken"]


def test_messages(spark, make_events):
    event = make_events([("u", "page_view", f"{DAY} 10:00:00")])
    row = metrics.event_messages(event).collect()[0]
    assert row.key == "page_view" and '"event_time":"2026-07-10 10:00:00"' in row.value
    df = spark.createDataFrame([(1,)], "x int").select(
        F.lit(f"{DAY} 10:10:00").cast("timestamp").alias("window_end"), F.lit("App").alias("app_name"), F.lit(3).alias("download_count"),
        *[F.lit(i).alias(n) for i, n in enumerate(("impression", "click", "download", "install"))],
        *[F.lit(0.0).alias(f"{n}_rate") for n in ("click", "download", "install")],
    )
    assert metrics.download_messages(df).collect()[0].value == '{"metric":"download","app":"App","count":3,"time":"2026-07-10 10:10:00"}'
    assert metrics.funnel_messages(df).collect()[0].value.startswith('{"metric":"funnel","impression":0,"click":1,')


def test_jdbc_slices_cover_the_day():
    slices = day_slices(DAY, slices=24)
    assert len(slices) == 24
    assert slices[0] == "event_time >= '2026-07-10 00:00:00' AND event_time < '2026-07-10 01:00:00'"
    assert slices[-1].endswith("event_time < '2026-07-11 00:00:00'")
    ends = [s.split("< ")[1] for s in slices[:-1]]
    assert ends == [s.split(">= ")[1].split(" AND")[0] for s in slices[1:]]


def test_daily_run(spark, tmp_path):
    """Three days in a row, one of them twice: the tables hold each day once."""
    root = str(tmp_path)
    tables.write_layer(ods(spark, SF), root, "ods_user_behavior_log")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-02", "2024-01-03"):
        run_daily(spark, root, day)
    from footfall.operators import daily, profile, retention
    from footfall.operators.clean import between_days, ods_to_dwd

    clean = between_days(ods_to_dwd(ods(spark, SF)), "2024-01-01", "2024-01-03")
    assert rows(reports.get_daily(spark, root, "2024-01-01", "2024-01-03")) == rows(daily.daily_summary(clean))
    assert rows(reports.get_daily(spark, root, "2024-01-03"), "stat_date") == [(dt.date(2024, 1, 3),)]
    want = rows(retention.retention(clean, ["2024-01-01"], (1,)))  # day 3 and later have not come yet
    assert rows(reports.get_retention(spark, root, "2024-01-01")) == want and want[0][3] > 0
    assert rows(read_layer(spark, root, "ads_user_profile")) == rows(profile.user_profile(clean))
    funnel = reports.get_funnel(spark, root, "2024-01-02").collect()
    assert [r.step_order for r in funnel] == [1, 2, 3, 4]
    ab = reports.get_ab(spark, root, "exp_001_home_rec_algo", "2024-01-02").collect()
    assert [(r.metric_name, r.variant) for r in ab] == sorted((r.metric_name, r.variant) for r in ab) and len(ab) > 5
    top = reports.get_top_downloads(spark, root, "2024-01-03", 3).collect()
    assert len(top) == 3 and top[0].download_count >= top[1].download_count
    assert os.path.isdir(f"{root}/dim_user_first_seen/dt=2024-01-03")
    assert reports.day_before("2024-01-03") == dt.date(2024, 1, 2)


def test_days_in_any_order(spark, tmp_path):
    """Days 1, 2, 3, then 2 and 1 again, or 3, 1, 2: the same tables as one run in order."""
    names = ("dwd_user_behavior", "dws_user_days", "dim_user_first_seen", "dws_daily_metrics", "ads_retention", "ads_user_profile")
    found = {}
    for order in ((1, 2, 3), (1, 2, 3, 2, 1), (3, 1, 2)):
        root = f"{tmp_path}/{'-'.join(map(str, order))}"
        tables.write_layer(ods(spark, SF), root, "ods_user_behavior_log")
        for day in order:
            run_daily(spark, root, f"2024-01-0{day}")
        found[order] = {name: rows(read_layer(spark, root, name)) for name in names}
    first = found.pop((1, 2, 3))
    assert all(first.values())
    for order, got in found.items():
        for name in names:
            assert got[name] == first[name], (order, name)


def test_a_database_table_is_never_read_by_one_task(spark):
    with pytest.raises(ValueError):
        read_jdbc_table(spark, "jdbc:none", "t")
