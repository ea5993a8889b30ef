"""Windowed metrics that run the same on tables and on streams, and alerts over windows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions.expressions import app_name, count_where, interval_micros, is_type, percent, window_label
from footfall.operators.clean import only_types
from footfall.operators.daily import ALL
from footfall.operators.funnel import AD_STEPS

# The texts of alerts.
ALERT_MESSAGE = "下载量异常下降！"
SURGE_MESSAGE = "下载量异常上升！"
INFO_MESSAGE = "下载量正常"


def _bounds() -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def _of_types(events: DataFrame, *types: str) -> DataFrame:
    """Batch: only these types reach the aggregation. Stream: all rows do.

    Spark moves a filter below the watermark, which then stands still between two
    downloads; on streams other rows are therefore counted as 0 and dropped afterwards.
    """
    return events if events.isStreaming else only_types(events, types)


def piece_size(size: str, slide: str | None) -> str:
    """The widest pieces that both windows and their steps are whole numbers of."""
    return f"{math.gcd(interval_micros(size), interval_micros(slide or size))} microseconds"


def pv_uv_windowed(events: DataFrame, size: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Events and exact distinct users per window; nulls are not visitors.

    Two steps, first per user: partial sums before each shuffle, and the only exact
    form a stream accepts. Sliding windows are built from pieces, so a row is not copied
    into all the windows it belongs to.
    """
    users = events.groupBy(F.window("event_time", piece_size(size, slide)), "user_id").agg(F.count("*").alias("n"))
    if slide:
        whole = F.window(F.window_time("window"), size, slide).alias("window")
        users = users.groupBy(whole, "user_id").agg(F.sum("n").alias("n"))
    per_window = users.groupBy("window").agg(F.sum("n").alias("pv"), F.count("user_id").alias("uv"))
    return per_window.select(*_bounds(), "pv", "uv")


def pv_uv_approx(events: DataFrame, size: str, slide: str | None = None, rsd: float = 0.02) -> DataFrame:
    """The bounded-state form for very large windows: an approximate distinct count."""
    window = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    per_window = events.groupBy(window).agg(
        F.count("*").alias("pv"), F.approx_count_distinct("user_id", rsd).alias("uv")
    )
    return per_window.select(*_bounds(), "pv", "uv")


def download_stats(events: DataFrame, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Downloads per app and sliding window; ``unknown`` when the app cannot be read."""
    download = is_type("app_download")
    pieces = (
        _of_types(events, "app_download")
        .groupBy(F.window("event_time", piece_size(size, slide)), F.when(download, app_name()).alias("app_name"))
        .agg(count_where(download).alias("n"))
        .filter("n > 0")
    )
    whole = F.window(F.window_time("window"), size, slide).alias("window")
    per_window = pieces.groupBy(whole, "app_name").agg(F.sum("n").alias("download_count"))
    return per_window.select(*_bounds(), "app_name", "download_count")


def funnel_windowed(events: DataFrame, size: str = "10 minutes") -> DataFrame:
    """Event counts of the ad path per tumbling window, rates to impressions. Batch or stream.

    A window without any of the four events gives no row.
    """
    names = [name for name, _ in AD_STEPS]
    counted = (
        _of_types(events, *[kind for _, kind in AD_STEPS])
        .groupBy(F.window("event_time", size))
        .agg(*[count_where(is_type(kind)).alias(name) for name, kind in AD_STEPS])
        .filter(" + ".join(names) + " > 0")
    )
    rates = [percent(F.col(n), F.col("impression")).alias(f"{n}_rate") for n in names[1:]]
    return counted.select(*_bounds(), *names, *rates)


def download_ranking(
    events: DataFrame, size: str = "5 minutes", slide: str = "1 minute", top: int = 10
) -> DataFrame:
    """The ``top`` apps of every window by downloads, then by name."""
    order = Window.partitionBy("window_start").orderBy(F.col("download_count").desc(), F.col("app_name"))
    ranked = download_stats(events, size, slide).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top)


def download_counts(events: DataFrame, size: str = "5 minutes", dimension: Column | None = None) -> DataFrame:
    """Downloads per window that has any, over all or per ``dimension``. Batch or stream."""
    value = F.lit(ALL) if dimension is None else dimension
    download = is_type("app_download")
    counts = (
        _of_types(events, "app_download")
        .groupBy(F.window("event_time", size), F.when(download, value).alias("dimension_value"))
        .agg(count_where(download).alias("current_count"))
        .filter("current_count > 0")
    )
    return counts.select(*_bounds(), "dimension_value", "current_count")


def alert_columns(threshold: float = -0.5, threshold_up: float | None = None) -> dict[str, Column]:
    """Kind and message from ``change_rate``; a change equal to a threshold is no alert."""
    change = F.col("change_rate")
    down = change < threshold
    up = F.lit(False) if threshold_up is None else change > threshold_up
    return {
        "alert_type": F.when(down | up, "ALERT").otherwise("INFO"),
        "message": F.when(down, ALERT_MESSAGE).when(up, SURGE_MESSAGE).otherwise(INFO_MESSAGE),
    }


def download_anomaly(
    events: DataFrame,
    size: str = "5 minutes",
    threshold: float = -0.5,
    threshold_up: float | None = None,
    dimension: Column | None = None,
) -> DataFrame:
    """Each window's downloads against the previous window that had any.

    ``lag`` runs over the counted windows, whose number the length of the log bounds.
    """
    order = Window.partitionBy("dimension_value").orderBy("window_start")
    compared = download_counts(events, size, dimension).withColumn(
        "previous_count", F.lag("current_count").over(order)
    )
    change = (F.col("current_count") - F.col("previous_count")) / F.col("previous_count")
    return (
        compared.filter("previous_count > 0")
        .withColumn("change_rate", change)
        .withColumns(alert_columns(threshold, threshold_up))
    )


def declining_runs(
    events: DataFrame, size: str = "5 minutes", n: int = 3, total: float = -0.6, dimension: Column | None = None
) -> DataFrame:
    """Windows that end ``n`` falls in a row with a total fall beyond ``total``.

    Documented, never computed, by the original.
    """
    order = Window.partitionBy("dimension_value").orderBy("window_start")
    counts = download_counts(events, size, dimension).withColumns(
        {f"_{i}": F.lag("current_count", i).over(order) for i in range(1, n + 1)}
    )
    falls = F.col("current_count") < F.col("_1")
    for i in range(1, n):
        falls = falls & (F.col(f"_{i}") < F.col(f"_{i + 1}"))
    change = (F.col("current_count") - F.col(f"_{n}")) / F.col(f"_{n}")
    return (
        counts.filter(falls)
        .withColumn("total_change", change)
        .filter(F.col("total_change") < total)
        .select(
            "window_start",
            "window_end",
            "dimension_value",
            F.col(f"_{n}").alias("from_count"),
            "current_count",
            "total_change",
        )
    )


DIMENSIONS = {
    ALL: lambda: F.lit(ALL),
    "app": lambda: app_name(None),
    "city": lambda: F.col("city"),
    "device_model": lambda: F.col("device_model"),
}


def realtime_metrics(
    events: DataFrame,
    windows: Sequence[str] = ("5 minutes", "1 hour", "1 day"),
    dims: Sequence[str] = (ALL, "app", "city", "device_model"),
) -> DataFrame:
    """PV, UV, downloads and searches per window and dimension value, as metric rows.

    Each window size must be a multiple of the one before it. Events are first merged per smallest
    window, user and combination of dimension values, as they stand; only those rows are expanded
    to the dimensions and to the longer windows.
    """
    for shorter, longer in zip(windows, windows[1:]):
        if interval_micros(longer) % interval_micros(shorter):
            raise ValueError(f"{longer} is no multiple of {shorter}")
    small = events.groupBy(
        F.window("event_time", windows[0]), "user_id", *[DIMENSIONS[d]().alias(f"_{d}") for d in dims]
    ).agg(
        F.count("*").alias("pv"),
        count_where(is_type("app_download")).alias("downloads"),
        count_where(is_type("search_query")).alias("searches"),
    )
    cells = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(f"_{d}").alias("dimension_value")) for d in dims]
    )
    start = F.col("window.start")
    spans = F.array(
        *[
            F.struct(F.lit(window_label(w)).alias("window_size"), _floor_time(start, w).alias("metric_time"))
            for w in windows
        ]
    )
    cell = ["metric_time", "window_size", "dimension", "dimension_value"]
    values = (
        small.select("window", "user_id", "pv", "downloads", "searches", F.inline(cells))
        .filter("dimension_value is not null")
        .select("dimension", "dimension_value", "user_id", "pv", "downloads", "searches", F.inline(spans))
        .groupBy(*cell, "user_id")
        .agg(*[F.sum(c).alias(c) for c in ("pv", "downloads", "searches")])
        .groupBy(*cell)
        .agg(
            F.sum("pv").cast("double").alias("pv"),
            F.count("user_id").cast("double").alias("uv"),
            F.sum("downloads").cast("double").alias("download_count"),
            F.sum("searches").cast("double").alias("search_count"),
        )
    )
    names = ["pv", "uv", "download_count", "search_count"]
    return values.unpivot(cell, names, "metric_name", "metric_value").select(
        "metric_time", "metric_name", "metric_value", "dimension", "dimension_value", "window_size"
    )


def _floor_time(start: Column, size: str) -> Column:
    width = interval_micros(size)
    return F.timestamp_micros(F.floor(F.unix_micros(start) / width) * width)
