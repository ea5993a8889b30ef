"""The daily batch: ODS to every result table of a day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.clean import Day, as_date, ods_to_dwd
from footfall.operators.daily import new_users_of_day, traffic_summary
from footfall.operators.experiment import ab_experiment, ab_samples
from footfall.operators.funnel import funnel_steps
from footfall.operators.profile import profile_of_parts, user_days
from footfall.operators.retention import RET_DAYS, retention
from footfall.operators.significance import ab_significance, apply_significance
from footfall.plans.profile_state import settle_profile
from footfall.session import scratch_dir
from footfall.sinks.tables import write_layer
from footfall.sources.tables import read_layer


def run_daily(spark: SparkSession, root: str, date: Day, ret_days: Sequence[int] = RET_DAYS) -> None:
    """Clean the day, write it once, and compute every result from the written tables.

    Only the day itself is read in detail. Retention reads one row per user and device of the days it
    compares, also later ones; profiles come from running sums, to which the day adds its new
    version minus its old one. So the days may run in any order and any number of times, and
    leave the same tables.
    """
    day = as_date(date)
    raw = read_layer(spark, root, "ods_user_behavior_log", day, day)
    write_layer(ods_to_dwd(raw.drop("dt")), root, "dwd_user_behavior", day)
    today = read_layer(spark, root, "dwd_user_behavior", day, day)

    of_day = written(user_days(today), "user-days")
    parts = settle_profile(spark, root, of_day, [day])
    write_layer(of_day, root, "dws_user_days", day)
    history = read_layer(spark, root, "dws_user_days")
    # A row per day folder.
    days = sorted(as_date(r.dt) for r in history.select("dt").distinct().collect())

    write_layer(traffic_summary(today, approx_new=True), root, "dws_daily_metrics", day)
    settle_new_users(spark, root, day, newest=day >= max(days, default=day))

    # The day completes the N-day retention of the days N before it; later days may be there already.
    bases = [day, *[day - dt.timedelta(days=n) for n in ret_days]]
    visits = history.select("user_id", F.col("first_seen").alias("event_time"), "dt")
    reached = F.expr("date_add(first_date, cast(ret_day as int))") <= F.lit(max([day, *days]))
    write_layer(retention(visits, bases, ret_days).filter(reached), root, "ads_retention")

    write_layer(funnel_steps(today, [day]), root, "ads_funnel_analysis", day)

    results = apply_significance(ab_experiment(today), ab_significance(ab_samples(today)))
    write_layer(results, root, "ads_ab_experiment", day)

    write_layer(profile_of_parts(parts), root, "ads_user_profile")


def settle_new_users(spark: SparkSession, root: str, day: dt.date, newest: bool) -> None:
    """First-seen users and their numbers in the daily metrics, after ``day`` has been written.

    The newest day, run for the first time, adds its users that no day before has. Any other run may change when
    users of the day's old or new version were first seen: these users, and no others, get the first of their
    days anew, in one pass whatever number of days lies behind; only days that gain or lose one are written.
    """
    known = read_layer(spark, root, "dim_user_first_seen")
    here = read_layer(spark, root, "dws_user_days", day, day).select("user_id").distinct()
    was = known.filter(known["dt"] == str(day))
    if newest and was.isEmpty():
        others = known.filter(known["dt"] != str(day))
        found = written(new_users_of_day(here, others).withColumn("first_date", F.lit(day)), "first-seen")
        touched = [day]
    else:
        changed = written(here.unionByName(was.select("user_id")).distinct(), "changed-users")
        every = read_layer(spark, root, "dws_user_days").join(changed, "user_id", "left_semi")
        first = written(every.groupBy("user_id").agg(F.min("stat_date").alias("first_date")), "first-days")
        before = known.join(changed, "user_id", "left_semi").select("first_date")
        # A row per day.
        touched = sorted({day, *(r.first_date for r in before.unionByName(first.select("first_date")).distinct().collect())})
        others = known.filter(known["dt"].isin(*map(str, touched))).join(changed, "user_id", "left_anti")
        found = written(others.select("user_id", "first_date").unionByName(first), "first-seen")
    write_days(found, root, "dim_user_first_seen", "first_date", touched)

    counts = read_layer(spark, root, "dim_user_first_seen").filter(F.col("dt").isin(*map(str, touched))).groupBy("first_date").agg(F.count("*").alias("n"))
    metrics = read_layer(spark, root, "dws_daily_metrics").filter(F.col("dt").isin(*map(str, touched))).drop("dt")
    joined = metrics.join(counts, F.col("stat_date") == F.col("first_date"), "left").drop("first_date", "new_user_count")
    rows = written(joined.withColumn("new_user_count", F.coalesce("n", F.lit(0).cast("bigint"))).drop("n"), "new-user-counts")
    write_layer(rows, root, "dws_daily_metrics")


def write_days(rows: DataFrame, root: str, table: str, column: str, days: Sequence[dt.date]) -> None:
    """Replaces ``days`` of a layer table by the rows that fall on them, also where none do."""
    write_layer(rows, root, table)
    filled = {r[column] for r in rows.select(column).distinct().collect()}
    for day in days:
        if day not in filled:
            write_layer(rows.limit(0), root, table, day)


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """Held in the shared scratch folder, while the tables it came from are written anew."""
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
