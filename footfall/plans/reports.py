"""Report queries over the result tables, and live figures over the events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.expressions import count_where, is_type
from footfall.operators.clean import as_date, between_days, Day
from footfall.operators.ranking import top_downloads
from footfall.sinks.metrics import read_latest
from footfall.sources.tables import read_layer


def day_before(as_of: Day) -> dt.date:
    """The reports' default day."""
    return as_date(as_of) - dt.timedelta(days=1)


def get_retention(spark: SparkSession, root: str, date: Day) -> DataFrame:
    return read_layer(spark, root, "ads_retention", date, date).drop("dt").orderBy("ret_day")


def get_funnel(spark: SparkSession, root: str, date: Day) -> DataFrame:
    rows = read_layer(spark, root, "ads_funnel_analysis", date, date)
    return rows.select("step_order", "step_name", "user_count", "step_rate", "overall_rate").orderBy("step_order")


def get_daily(spark: SparkSession, root: str, date_from: Day, date_to: Day | None = None) -> DataFrame:
    """Daily metrics of a range, both ends included; without an end, since a day."""
    return read_layer(spark, root, "dws_daily_metrics", date_from, date_to).drop("dt").orderBy("stat_date")


def get_ab(spark: SparkSession, root: str, experiment_id: str, date: Day) -> DataFrame:
    rows = read_layer(spark, root, "ads_ab_experiment", date, date)
    return (
        rows.filter(F.col("experiment_id") == experiment_id)
        .drop("sample_data", "dt")
        .orderBy("metric_name", "variant")
    )


def get_top_downloads(spark: SparkSession, root: str, as_of: Day, limit: int = 10) -> DataFrame:
    """The detail table has a day column, which the day filter prunes by."""
    return top_downloads(read_layer(spark, root, "dwd_user_behavior"), as_of, 7, limit)


def get_realtime(spark: SparkSession, path: str, now: str) -> DataFrame:
    """The latest PV and UV that have not expired; 0 when there are none."""
    rows = read_latest(spark, path, now).filter("dimension = 'all'")
    newest = lambda m: F.max(F.when(F.col("metric_name") == m, F.struct("metric_time", "metric_value")))
    values = rows.agg(newest("pv").alias("pv"), newest("uv").alias("uv"))
    return values.select(
        *[F.coalesce(F.col(f"{m}.metric_value"), F.lit(0.0)).cast("bigint").alias(m) for m in ("pv", "uv")]
    )


def daily_trend(daily: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    """PV and UV of all events from ``as_of - days`` to ``as_of``."""
    as_of = as_date(as_of)
    return (
        daily.filter(F.col("event_type") == "all")
        .filter(F.col("stat_date").between(as_of - dt.timedelta(days=days), as_of))
        .select("stat_date", "pv", "uv")
        .orderBy("stat_date")
    )


def hourly_trend(hourly: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """PV and UV of the ``hours`` full hours before ``as_of``."""
    end = F.date_trunc("hour", F.lit(as_of).cast("timestamp"))
    start = end - F.expr(f"interval {hours} hours")
    return (
        hourly.filter((F.col("event_type") == "all") & (F.col("stat_hour") >= start) & (F.col("stat_hour") < end))
        .select("stat_hour", "pv", "uv")
        .orderBy("stat_hour")
    )


def kpi_snapshot(events: DataFrame, as_of: str, minutes: int = 5) -> DataFrame:
    """PV and UV of the last minutes, downloads and searches since midnight: one scan of the day, or
    of two when the minutes begin before midnight."""
    now = F.lit(as_of).cast("timestamp")
    start = dt.datetime.fromisoformat(as_of) - dt.timedelta(minutes=minutes)
    events = between_days(events, start.date(), as_of[:10])
    time = F.col("event_time")
    recent = (time > now - F.expr(f"interval {minutes} minutes")) & (time <= now)
    today = (time >= F.date_trunc("day", now)) & (time <= now)
    return events.filter(recent | today).agg(
        count_where(recent).alias("pv"),
        F.count_distinct(F.when(recent, F.col("user_id"))).alias("uv"),
        count_where(today & is_type("app_download")).alias("download_count"),
        count_where(today & is_type("search_query")).alias("search_count"),
    )
