"""Dense user numbers and bitmaps against sets."""

import datetime as dt

from footfall.operators import bitmaps
from footfall.operators.retention import retention
from pyspark.sql import functions as F
from tests.conftest import rows

DAYS = [dt.date(2026, 7, d) for d in range(1, 12)]


def events_of(make_events, n_users):
    """User i is active on day 0 and on all days that i has a divisor for."""
    found = [(f"u{i}", "page_view", f"{DAYS[d]} 10:00:00") for i in range(n_users) for d in range(11) if d == 0 or i % (d + 1) == 0]
    return make_events(found + [(None, "page_view", f"{DAYS[3]} 10:00:00")])


def numbered(spark, path, users, known=None, first=1):
    bitmaps.drafted_numbers(users, known).write.parquet(path)
    return bitmaps.dense_numbers(spark.read.parquet(path), first)


def test_numbers_are_dense_and_stay(spark, tmp_path):
    users = spark.createDataFrame([(f"u{i % 500}",) for i in range(2000)] + [(None,)], "user_id string").repartition(7)
    one = numbered(spark, f"{tmp_path}/a", users).cache()
    assert sorted(r.user_number for r in one.collect()) == list(range(1, 501))
    more = spark.createDataFrame([(f"u{i}",) for i in range(450, 620)], "user_id string").repartition(5)
    two = numbered(spark, f"{tmp_path}/b", more, one, 501)
    assert sorted(r.user_number for r in two.collect()) == list(range(501, 621))
    assert {r.user_id for r in two.collect()} == {f"u{i}" for i in range(500, 620)}
    assert numbered(spark, f"{tmp_path}/c", users.limit(0)).count() == 0


def test_unions_and_intersections_over_several_buckets(spark, tmp_path, make_events):
    events = events_of(make_events, 60)
    # Numbers far apart: four buckets of 32,768.
    numbers = numbered(spark, f"{tmp_path}/n", events).withColumn("user_number", F.col("user_number") * 2000)
    table = bitmaps.day_bitmaps(events, numbers).cache()
    assert table.select("bucket").distinct().count() == 4
    exact = events.filter("user_id is not null")
    whole = bitmaps.bitmap_uv(table, F.lit("all"), "period")
    assert rows(whole, "uv") == [(60,)]
    by_day = exact.groupBy(F.to_date("event_time").alias("stat_date")).agg(F.countDistinct("user_id").alias("uv"))
    assert rows(bitmaps.bitmap_uv(table, F.col("stat_date"), "stat_date")) == rows(by_day)
    assert rows(bitmaps.bitmap_retention(table, (1, 3, 7))) == rows(retention(exact, ret_days=(1, 3, 7)))
    assert bitmaps.bitmap_retention(table.limit(0)).count() == 0


def test_no_scan_of_events_and_no_cartesian_product(spark, tmp_path, make_events):
    events = events_of(make_events, 12)
    bitmaps.day_bitmaps(events, numbered(spark, f"{tmp_path}/n", events)).write.parquet(f"{tmp_path}/days")
    plan = bitmaps.bitmap_retention(spark.read.parquet(f"{tmp_path}/days"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and plan.count("Scan parquet") == 1
