"""Every operator as a query over the given tables: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.expressions import app_name, half_up, is_type
from footfall.operators import (
    bitmaps,
    clean,
    daily,
    experiment,
    funnel,
    profile,
    ranking,
    retention,
    sessions,
    significance,
    windows,
)
from footfall.plans import reports
from footfall.plans.daily_run import written
from footfall.plans.profile_state import settle_profile
from footfall.plans.realtime_run import run_realtime
from footfall.session import scratch_dir
from footfall.sinks import metrics, tables
from footfall.sources import events as event_source
from footfall.sources.experiments import experiments_df
from footfall.sources.tables import read_buckets, read_layer
from footfall.sources.testdata import ods, ods_stream
from footfall.streaming import anomaly, jobs, rollup, sliding
from footfall.streaming import ranking as live_ranking

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries; the given events run from 2024-01-01 to 2024-01-30.
AS_OF = "2024-01-31"
DAY = "2024-01-15"
NOW = "2024-01-20 12:00:00"
LATE = "2024-01-30 23:59:00"

IP_RANGES = [
    ("10.0.0.0", "10.0.63.255", "杭州"),
    ("10.0.64.0", "10.0.127.255", "南京"),
    ("10.0.128.0", "10.0.199.255", "重庆"),
    ("11.0.0.0", "11.255.255.255", "西安"),
]
DEVICE_TIERS = [
    ("Model 0", "旗舰"),
    ("Model 1", "旗舰"),
    ("Model 2", "中端"),
    ("Model 3", "中端"),
    ("Model 4", "中端"),
    ("Model 5", "入门"),
    ("Model 6", "入门"),
]


# Columns the operators read besides user, type and time.
TRAFFIC = ("city", "device_model", "duration")
CELLS = ("city", "device_model", "app_version")
GROUPS = ("experiment_id", "variant", "duration", "properties")


def dwd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.ods_to_dwd(ods(spark, sf_dir))


def detail(spark: SparkSession, sf_dir: str, *columns: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Clean events with only what a query reads: the rest never reaches the shuffle.

    A report on some days names them, the copies of an event having one event time.
    """
    return clean.ods_to_dwd(ods(spark, sf_dir), columns, days)


def _on_detail(build: Callable[[DataFrame], DataFrame], *columns: str, days: tuple[str, str] | None = None) -> Query:
    return lambda spark, sf_dir: build(detail(spark, sf_dir, *columns, days=days))


def _on_stream(build: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return jobs.run_available(build(jobs.stream_clean(ods_stream(spark, sf_dir))), "stream")

    return run


def _city_from_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = spark.createDataFrame(IP_RANGES, "ip_from string, ip_to string, city string")
    return clean.enrich_city(ods(spark, sf_dir), ranges).groupBy("city").agg(F.count("*").alias("events"))


def _preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = spark.createDataFrame(DEVICE_TIERS, "device_model string, device_tier string")
    return profile.user_preferences(detail(spark, sf_dir, "device_model", "properties"), tiers)


def _new_users_of_day(events: DataFrame) -> DataFrame:
    before = clean.between_days(events, "2024-01-01", "2024-01-01")
    return daily.new_users_of_day(clean.on_day(events, "2024-01-02"), before)


def _user_number() -> F.Column:
    return F.substring("user_id", 6, 20).cast("bigint")


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiment.ab_samples(detail(spark, sf_dir, *GROUPS))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return significance.ab_test_stats(_samples(spark, sf_dir))


def _rounded(tested: DataFrame, columns: list[str]) -> DataFrame:
    rounded = [half_up(F.col(c), 6).alias(c) for c in columns]
    return tested.select(*[c for c in tested.columns if c not in columns], *rounded)


def _welch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = significance.welch_columns(_stats(spark, sf_dir)).filter("metric_name = 'avg_duration' and n_a > 1 and n_b > 1")
    return rows.select(
        "stat_date",
        "experiment_id",
        "n_a",
        "n_b",
        half_up(F.col("t_statistic"), 6).alias("t_statistic"),
        half_up(F.col("degrees"), 4).alias("degrees"),
    )


def _tested_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = detail(spark, sf_dir, *GROUPS)
    tests = significance.ab_significance(experiment.ab_samples(events))
    return significance.apply_significance(experiment.ab_experiment(events), tests)


def _hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = experiment.ab_experiment(detail(spark, sf_dir, *GROUPS), extra=True)
    return experiment.hypothesis_met(results, experiments_df(spark))


def _layer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the clean detail as day folders, read a range of days back."""
    root = scratch_dir(spark, "layers")
    tables.write_layer(dwd(spark, sf_dir), root, "dwd_user_behavior")
    days = read_layer(spark, root, "dwd_user_behavior", "2024-01-10", "2024-01-20")
    return days.groupBy("dt").agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users"))


def _jsonl_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the log as JSON lines, read it back, clean it and count."""
    path = scratch_dir(spark, "jsonl")
    metrics.event_messages(ods(spark, sf_dir)).select("value").write.text(path)
    events = clean.ods_to_dwd(event_source.read_events_jsonl(spark, path))
    return events.groupBy("event_type").agg(F.count("*").alias("events"), F.sum("duration").alias("duration_ms"))


def _jsonl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines, those of one type broken, read back: good and rejected lines."""
    path = scratch_dir(spark, "jsonl")
    messages = metrics.event_messages(ods(spark, sf_dir))
    line = F.when(F.col("key") == "error", F.concat(F.lit("{"), F.col("value"))).otherwise(F.col("value"))
    messages.select(line.alias("value")).write.text(path)
    events, rejects = event_source.decode_jsonl(spark, path)
    kinds = events.select(F.col("event_type").alias("kind")).unionByName(rejects.select(F.lit("rejected").alias("kind")))
    return kinds.groupBy("kind").agg(F.count("*").alias("lines"))


def _latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of daily downloads, each with other apps, merged into the latest values."""
    path = scratch_dir(spark, "latest")
    counts = windows.download_stats(detail(spark, sf_dir, "properties"), "1 day", "1 day")
    rows = metrics.to_metric_rows(counts, ["download_count"], "1 day", "app", "app_name")
    part = F.pmod(F.hash("dimension_value"), F.lit(2))
    for batch in (0, 1):
        metrics.merge_latest(spark, metrics.latest_values(rows.filter(part == batch), "40 days"), path, batch)
    return metrics.read_latest(spark, path, AS_OF)


def _bucket_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four samples of 8 of 32 buckets each, which have no row in common and together all: their events per type."""
    name, path = f"footfall_sample_{uuid.uuid4().hex}", scratch_dir(spark, "samples")
    tables.write_bucketed(detail(spark, sf_dir), name)
    for part in range(4):
        sample = read_buckets(spark, name, range(8 * part, 8 * part + 8))
        sample.groupBy("event_type").agg(F.count("*").alias("n")).write.mode("append").parquet(path)
    spark.sql(f"drop table {name}")
    return spark.read.parquet(path).groupBy("event_type").agg(F.sum("n").alias("events"))


def _realtime_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PV and UV of the five-minute windows as latest values, read near the end of the log."""
    path = scratch_dir(spark, "latest")
    rows = metrics.to_metric_rows(windows.pv_uv_windowed(detail(spark, sf_dir)), ["pv", "uv"], "5 minutes")
    metrics.merge_latest(spark, metrics.latest_values(rows, "660 seconds"), path, 0)
    return reports.get_realtime(spark, path, LATE)


def _within(found: DataFrame, exact: DataFrame, key: str, estimate: str, error: float) -> DataFrame:
    """Exact counts, and whether the estimates are as near as they should be."""
    near = F.abs(F.col(estimate) - F.col("uv")) <= F.greatest(F.lit(1.0), F.col("uv") * error)
    return exact.join(found, key).select(key, "uv", near.alias("is_within"))


def _uv_approx(events: DataFrame) -> DataFrame:
    return _within(daily.uv_approx(events), daily.uv_of_sets(events), "stat_date", "uv_approx", 0.08)


def _uv_hll_weekly(events: DataFrame) -> DataFrame:
    week = F.date_trunc("week", F.to_date("event_time")).cast("date").alias("week")
    week_of_day = F.date_trunc("week", "stat_date").cast("date").alias("week")
    exact = events.select(week, "user_id").distinct().groupBy("week").agg(F.count("user_id").alias("uv"))
    return _within(daily.uv_from_sketches(daily.uv_sketches(events), week_of_day), exact, "week", "uv_estimate", 0.04)


def _dated_assignment(events: DataFrame) -> DataFrame:
    """The experiments' dates lie later than the log, so its days are shifted onto them."""
    shifted = events.withColumn("at", F.expr("event_time + make_interval(0, 0, 0, datediff(date'2026-07-10', date'2024-01-15'))"))
    return experiment.assign_experiment(shifted.select("event_id", "user_id", "at"), time_col="at").drop("user_id", "at")


def _stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts per day, kept by a stream."""
    jobs.configure_streaming(spark)
    folder = scratch_dir(spark, "daily")
    events = jobs.clean_stateless(ods_stream(spark, sf_dir))
    jobs.incremental_daily(events, f"{folder}/out", f"{folder}/checkpoint", availableNow=True).awaitTermination()
    return jobs.read_incremental_daily(spark, f"{folder}/out")


def _realtime_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The realtime job over all there is: what its streams left in the metric table."""
    folder = scratch_dir(spark, "realtime")
    for query in run_realtime(ods_stream(spark, sf_dir), folder, f"{folder}/checkpoints", availableNow=True):
        query.awaitTermination()
    table = read_layer(spark, folder, "ads_realtime_metrics")
    return table.select("metric_time", "metric_name", "metric_value", "dimension", "dimension_value", "window_size")


def _stream_realtime_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup streams over all there is: exact counts, exact users of the same cells, and whether the sketches are near."""
    folder = scratch_dir(spark, "rollup")
    events = jobs.stream_clean_newest(ods_stream(spark, sf_dir))  # whose copy counts shows in the city
    for query in rollup.run_rollup(events, folder, f"{folder}/checkpoints", availableNow=True):
        query.awaitTermination()
    cells = rollup.read_rollup(spark, folder)
    exact = windows.realtime_metrics(detail(spark, sf_dir, "city", "device_model", "properties")).filter("metric_name = 'uv'")
    key = ["metric_time", "window_size", "dimension", "dimension_value"]
    both = cells.join(exact.select(*key, F.col("metric_value").cast("bigint").alias("uv")), key)
    near = F.abs(F.col("uv_estimate") - F.col("uv")) <= F.greatest(F.lit(1.0), F.col("uv") * 0.03)
    return both.select(*key, "pv", "download_count", "search_count", "uv", near.alias("is_within"))


def _on_bitmaps(build: Callable[[DataFrame], DataFrame]) -> Query:
    """Number the users of the first half of the log, then the new ones of the rest; write the bitmaps; answer from them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_dir(spark, "bitmaps")
        events = detail(spark, sf_dir)
        halves = (events.filter(F.col("event_time") < F.lit(DAY).cast("timestamp")), events)
        for step, part in enumerate(halves):
            known = spark.read.parquet(f"{folder}/numbers") if step else None
            bitmaps.drafted_numbers(part, known).write.parquet(f"{folder}/drafted-{step}")
            first = 1 + (known.count() if step else 0)
            numbers = bitmaps.dense_numbers(spark.read.parquet(f"{folder}/drafted-{step}"), first)
            numbers.write.mode("append").parquet(f"{folder}/numbers")
        bitmaps.day_bitmaps(events, spark.read.parquet(f"{folder}/numbers")).write.parquet(f"{folder}/days")
        return build(spark.read.parquet(f"{folder}/days"))

    return run


def _full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without days, written for some days first, then for all: nothing of the first is left."""
    root = scratch_dir(spark, "refresh")
    for days in (("2024-01-01", "2024-01-10"), None):
        rows = profile.user_profile(detail(spark, sf_dir, "device_model", days=days))
        tables.write_layer(rows, root, "ads_user_profile")
    return read_layer(spark, root, "ads_user_profile")


def _profile_by_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles from running sums: first the mornings of the days before ``DAY``, then all days in their whole version."""
    root = scratch_dir(spark, "profile-sums")
    events = detail(spark, sf_dir, "device_model")
    mornings = events.filter((F.col("event_time") < F.lit(DAY).cast("timestamp")) & (F.hour("event_time") < 12))
    for part in (mornings, events):
        fresh = written(profile.user_days(part), "user-days")
        # A row per day.
        days = [r.stat_date for r in fresh.select("stat_date").distinct().collect()]
        parts = settle_profile(spark, root, fresh, days)
        tables.write_layer(fresh, root, "dws_user_days")
    return profile.profile_of_parts(parts)


def _lookup(table: str, build: Callable[[DataFrame], DataFrame], read: Callable, *columns: str) -> Query:
    """Write a result table, look up in it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_dir(spark, "lookup")
        tables.write_layer(build(detail(spark, sf_dir, *columns)), root, table)
        return read(spark, root)

    return run


def _decoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode the log as messages, break some, decode: good and rejected counts per key."""
    messages = metrics.event_messages(ods(spark, sf_dir))
    broken = messages.withColumn(
        "value", F.when(F.col("key") == "error", F.concat(F.lit("{"), F.col("value"))).otherwise(F.col("value"))
    )
    parsed = event_source.parse_messages(broken)
    kind = F.when(F.col("is_rejected"), "rejected").otherwise(F.col("e.event_type"))
    return parsed.groupBy(kind.alias("kind")).agg(F.count("*").alias("messages"))


def _summing_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two partial loads of every day collapse to one row per day and type."""
    parts = (
        detail(spark, sf_dir, "city")
        .groupBy(
            F.to_date("event_time").alias("stat_date"), "event_type", F.pmod(F.hour("event_time"), F.lit(2)).alias("part")
        )
        .agg(F.count("*").alias("pv"), F.min("city").alias("first_city"))
    )
    return tables.summing_merge(parts, ["stat_date", "event_type"], ["pv"], ["first_city"], version="part").select(
        "stat_date", "event_type", "pv", "first_city"
    )


def _stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = jobs.stream_clean(ods_stream(spark, sf_dir))
    return jobs.run_available(
        cleaned.select("event_id", "event_type", "user_id", "event_time", "device_model", "duration"), "stream"
    )


def _stream_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = lambda kind: jobs.clean_stateless(ods_stream(spark, sf_dir)).filter(is_type(kind))
    first = source("app_click").dropDuplicatesWithinWatermark(["event_id"])
    joined = jobs.followed_within(first, source("app_download"), "6 hours")
    return jobs.run_available(joined.select("event_id", "user_id", "event_time"), "stream")


def _stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log arrives in three parts, each with some rows of days gone by; the stream is restarted for every part."""
    jobs.configure_streaming(spark)
    folder = scratch_dir(spark, "late")
    events = ods(spark, sf_dir).select("event_id", "event_time", "duration")
    third = F.when(F.dayofmonth("event_time") <= 10, 0).when(F.dayofmonth("event_time") <= 20, 1).otherwise(2)
    part = F.least(third + F.when(F.hour("event_time") == 3, 1).otherwise(0), F.lit(2))
    for n in range(3):
        events.filter(part == n).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
        jobs.to_table(jobs.mark_late(stream), out, checkpoint, availableNow=True).awaitTermination()
    marked = spark.read.parquet(f"{folder}/out")
    return marked.groupBy(F.to_date("event_time").alias("stat_date"), "is_late").agg(
        F.count("*").alias("events"), F.sum("duration").alias("duration_ms")
    )


def queries() -> dict[str, Query]:
    on, stream = _on_detail, _on_stream
    return {
        # Cleaning and tables
        "dwd_clean": dwd,
        "cleaning_report": lambda s, d: clean.cleaning_report(ods(s, d)),
        "city_from_ip": _city_from_ip,
        "replacing_merge": lambda s, d: tables.replacing_merge(
            ods(s, d).select("event_id", "event_time", "server_time", "city"), ["event_id", "event_time"], "server_time"
        ),
        "summing_merge": _summing_merge,
        "full_refresh": _full_refresh,
        "ttl_filter": on(lambda e: tables.apply_ttl(e.select("event_id", "event_time"), "event_time", 7, AS_OF), days=("2024-01-15", AS_OF)),
        "layer_days": _layer_days,
        "jsonl_events": _jsonl_events,
        "decoded_events": _decoded_events,
        "jsonl_rejects": _jsonl_rejects,
        # Summaries
        "daily_summary": on(daily.daily_summary, *TRAFFIC),
        "daily_summary_by_type": on(lambda e: daily.daily_summary(e, by_type=True), *TRAFFIC),
        "hourly_summary": on(daily.hourly_summary, *TRAFFIC),
        "new_users": on(daily.new_users),
        "new_users_of_day": on(_new_users_of_day, days=("2024-01-01", "2024-01-02")),
        "top_city_per_day": on(
            lambda e: daily.top_value(e.withColumn("stat_date", F.to_date("event_time")), ["stat_date"], "city"),
            "city",
        ),
        "drill_down_cube": on(lambda e: daily.drill_down(e, ["city", "device_model", "app_version"]), *CELLS),
        "drill_down_rollup": on(lambda e: daily.drill_down(e, ["city", "app_version"], how="rollup"), *CELLS),
        "city_distribution": on(daily.city_distribution, "city"),
        "uv_approx": on(_uv_approx),
        "uv_hll_weekly": on(_uv_hll_weekly),
        "uv_bitmap": on(lambda e: daily.uv_bitmap(e, _user_number())),
        "uv_of_sets": on(daily.uv_of_sets),
        "bitmap_week_uv": _on_bitmaps(lambda b: bitmaps.bitmap_uv(b, F.date_trunc("week", "stat_date").cast("date"), "week")),
        "bitmap_retention": _on_bitmaps(bitmaps.bitmap_retention),
        # Retention
        "retention_ndays": on(retention.retention),
        "retention_base_dates": on(
            lambda e: retention.retention(e, ["2024-01-03", "2024-01-15", "2024-02-15"])
        ),
        "retention_new_users": on(lambda e: retention.retention(e, cohort="first_seen")),
        "next_day_retention": on(lambda e: retention.retention(e, ret_days=(1,))),
        "retention_matrix": on(lambda e: retention.retention_matrix(e, "2024-01-01", "2024-01-14", 14)),
        # Funnels
        "funnel_steps": on(funnel.funnel_steps),
        "funnel_steps_of_days": on(lambda e: funnel.funnel_steps(e, ["2024-01-02", DAY, "2024-03-01"]), days=("2024-01-02", "2024-03-01")),
        "funnel_contained": on(funnel.funnel_contained),
        "funnel_ordered": on(lambda e: funnel.funnel_ordered(e, within="6 hours")),
        "funnel_windowed": on(windows.funnel_windowed),
        "app_conversion": on(funnel.app_conversion, "properties"),
        # Profiles
        "user_profile": on(profile.user_profile, "device_model"),
        "profile_by_deltas": _profile_by_deltas,
        "profile_report": on(lambda e: profile.profile_report(profile.user_profile(e)), "device_model"),
        "user_preferences": _preferences,
        # Experiments
        "ab_assignment": lambda s, d: experiment.assign_all(detail(s, d).select("user_id").distinct()),
        "ab_event_assignment": lambda s, d: experiment.assign_experiment(
            detail(s, d).select("event_id", "user_id"), time_col=None
        ),
        "ab_dated_assignment": on(_dated_assignment),
        "ab_metrics": on(experiment.ab_metrics, *GROUPS),
        "ab_extra_metrics": on(lambda e: experiment.ab_metrics(e, extra=True), *GROUPS),
        "ab_uplift": on(experiment.ab_experiment, *GROUPS),
        "ab_samples": _samples,
        "ab_pivot": on(lambda e: experiment.ab_pivot(experiment.ab_experiment(e)), *GROUPS),
        "ab_hypothesis": _hypotheses,
        "ab_ztest": lambda s, d: _rounded(significance.z_test(_stats(s, d)), ["z", "p_value"]),
        "ab_fisher": lambda s, d: _rounded(
            significance.fisher_test(significance.contingency(_stats(s, d))), ["p_value"]
        ),
        "ab_chi_square": lambda s, d: _rounded(
            significance.chi_square_test(significance.contingency(_stats(s, d))), ["chi2", "p_value"]
        ),
        "ab_mann_whitney_u": lambda s, d: _rounded(significance.mann_whitney_columns(_stats(s, d)), ["z"]),
        "ab_welch_stat": _welch,
        "ab_significance": lambda s, d: significance.ab_significance(_samples(s, d)),
        "ab_tested_results": _tested_results,
        "ab_pivot_tested": lambda s, d: experiment.ab_pivot(_tested_results(s, d)),
        "ab_report": lambda s, d: experiment.ab_report(_tested_results(s, d)),
        # Windows, sessions and alerts
        "pv_uv_5m": on(windows.pv_uv_windowed),
        "pv_uv_sliding": on(lambda e: windows.pv_uv_windowed(e, "5 minutes", "30 seconds")),
        "pv_uv_sliding_uneven": on(lambda e: windows.pv_uv_windowed(e, "5 minutes", "2 minutes")),
        "downloads_sliding_uneven": on(lambda e: windows.download_stats(e, "7 minutes", "3 minutes"), "properties"),
        "latest_snapshot": _latest_snapshot,
        "downloads_sliding": on(windows.download_stats, "properties"),
        "download_ranking": on(lambda e: windows.download_ranking(e, "6 hours", "1 hour", 5), "properties"),
        "realtime_metrics": on(windows.realtime_metrics, "city", "device_model", "properties"),
        "metric_rows": on(
            lambda e: metrics.to_metric_rows(windows.pv_uv_windowed(e, "1 hour"), ["pv", "uv"], "1 hour")
        ),
        "pv_uv_messages": on(lambda e: metrics.pv_uv_messages(windows.pv_uv_windowed(e, "1 hour"))),
        "latest_values": on(
            lambda e: metrics.latest_values(
                metrics.to_metric_rows(windows.pv_uv_windowed(e), ["pv", "uv"], "5 minutes"), "660 seconds"
            )
        ),
        "sessions": on(sessions.sessions),
        "events_with_sessions": on(
            lambda e: sessions.sessionize(e).select("event_id", "user_id", "event_time", "session_id")
        ),
        "download_anomaly": on(lambda e: windows.download_anomaly(e, "6 hours")),
        "download_surge_per_app": on(
            lambda e: windows.download_anomaly(e, "1 day", threshold_up=0.8, dimension=app_name()),
            "properties",
        ),
        "anomaly_3down": on(lambda e: windows.declining_runs(e, "1 hour", total=-0.6)),
        # Streams, run over all there is
        "stream_clean": _stream_clean,
        "stream_clean_newest": lambda s, d: jobs.run_available(jobs.stream_clean_newest(ods_stream(s, d)), "stream"),
        "stream_daily": _stream_daily,
        "stream_realtime_tables": _realtime_tables,
        "stream_pv_uv": stream(windows.pv_uv_windowed),
        "stream_downloads": stream(windows.download_stats),
        "stream_funnel": stream(windows.funnel_windowed),
        "stream_sessions": stream(sessions.session_windows),
        "stream_anomaly": stream(lambda e: anomaly.stream_anomaly(e, "6 hours")),
        "stream_followed": _stream_followed,
        "stream_late_rows": _stream_late_rows,
        "stream_pv_uv_sliding": stream(sliding.stream_pv_uv_sliding),
        "stream_download_ranking": stream(lambda e: live_ranking.stream_download_ranking(e, "6 hours", "1 hour", 5)),
        "stream_realtime_metrics": _stream_realtime_metrics,
        # Reports
        "retention_lookup": _lookup(
            "ads_retention",
            retention.retention,
            lambda s, root: reports.get_retention(s, root, DAY),
        ),
        "funnel_lookup": _lookup("ads_funnel_analysis", funnel.funnel_steps, lambda s, root: reports.get_funnel(s, root, DAY)),
        "ab_lookup": _lookup(
            "ads_ab_experiment",
            experiment.ab_experiment,
            lambda s, root: reports.get_ab(s, root, "exp_001_home_rec_algo", DAY),
            *GROUPS,
        ),
        "realtime_lookup": _realtime_lookup,
        "daily_range_lookup": _lookup(
            "dws_daily_metrics",
            daily.daily_summary,
            lambda s, root: reports.get_daily(s, root, "2024-01-10", "2024-01-20"),
            *TRAFFIC,
        ),
        "top_downloads": on(lambda e: ranking.top_downloads(e, AS_OF), "properties", days=("2024-01-15", AS_OF)),
        "top_downloads_of_day": on(lambda e: ranking.top_downloads_of_day(e, DAY), "properties", days=("2024-01-13", "2024-01-17")),
        "bucket_sample": _bucket_sample,
        "sample_users": on(lambda e: ranking.sample_users(e, 50, seed=7)),
        "kpi_snapshot": on(lambda e: reports.kpi_snapshot(e, NOW, minutes=60), days=("2024-01-19", "2024-01-20")),
        "daily_trend": on(
            lambda e: reports.daily_trend(
                daily.daily_summary(clean.last_days(e, "2024-01-20"), approx_new=True), "2024-01-20"
            ),
            *TRAFFIC,
            days=("2024-01-08", "2024-01-25"),
        ),
        "hourly_trend": on(
            lambda e: reports.hourly_trend(daily.hourly_summary(clean.last_days(e, NOW[:10], 1)), NOW),
            *TRAFFIC,
            days=("2024-01-15", "2024-01-25"),
        ),
    }
