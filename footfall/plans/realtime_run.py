"""The streaming jobs, fanned out from one cleaned stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.windows import download_stats, funnel_windowed, pv_uv_windowed
from footfall.session import configure_streaming
from footfall.sinks.metrics import to_metric_rows, write_metric_stream
from footfall.sinks.tables import ensure_folder
from footfall.streaming.anomaly import stream_anomaly
from footfall.streaming.jobs import land, stream_clean, to_table, with_event_time


def clean_once(events: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The one query that reads the source: cleans, removes copies and lands by day below ``root``.

    It holds the only deduplication state. Whatever follows reads the landed table, see :func:`cleaned_stream`.
    """
    configure_streaming(events.sparkSession)
    path = cleaned_path(root)
    ensure_folder(events.sparkSession, path)  # readers may start before the first batch
    return land(stream_clean(events), path, checkpoint, **trigger)


def cleaned_path(root: str) -> str:
    return f"{root.rstrip('/')}/realtime/dwd_user_behavior"


def cleaned_stream(spark: SparkSession, root: str, schema) -> DataFrame:
    """The landed events as a stream with event time: whole batches, each event once, in the order they came."""
    return with_event_time(spark.readStream.schema(schema).parquet(cleaned_path(root)).drop("dt"))


def run_realtime(events: DataFrame, root: str, checkpoints: str, **trigger) -> list[StreamingQuery]:
    """Start the cleaning, and PV/UV with the latest values, download counts, the funnel and alerts on what it lands.

    The source is read, cleaned and deduplicated once. Each job is its own query with its own checkpoint, so one may
    fail and restart without the others. The metrics also fill ``ads_realtime_metrics`` by day. With ``availableNow`` the jobs start when the
    cleaning has ended; otherwise they follow its batches.
    """
    clean_query = clean_once(events, root, f"{checkpoints}/clean", **trigger)
    if trigger.get("availableNow"):
        clean_query.awaitTermination()
    clean = cleaned_stream(events.sparkSession, root, events.schema)
    pv_uv = to_metric_rows(pv_uv_windowed(clean), ["pv", "uv"], "5 minutes")
    downloads = to_metric_rows(download_stats(clean), ["download_count"], "5 minutes", "app", "app_name")
    funnel_metrics = ["impression", "click", "download", "install", "click_rate", "download_rate", "install_rate"]
    funnel = to_metric_rows(funnel_windowed(clean), funnel_metrics, "10 minutes")
    # A value is shown from the end of its window to the end of the next one, and a minute more.
    jobs = {"pv_uv": (pv_uv, "660 seconds"), "downloads": (downloads, None), "funnel": (funnel, None)}
    queries = [
        write_metric_stream(stream, root, name, f"{checkpoints}/{name}", ttl, **trigger)
        for name, (stream, ttl) in jobs.items()
    ]
    alerts = to_table(stream_anomaly(clean), f"{root}/realtime/alerts", f"{checkpoints}/alerts", **trigger)
    return [clean_query, *queries, alerts]
