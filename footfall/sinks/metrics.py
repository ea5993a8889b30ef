"""Realtime results as metric rows, as JSON messages and as expiring latest values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.expressions import interval_micros, window_label
from footfall.operators.daily import ALL
from footfall.sinks.tables import PARTITION, complete_versions, drop_versions, new_version, table_path

MESSAGE = "value"
_TIME = "yyyy-MM-dd HH:mm:ss"


def to_metric_rows(
    df: DataFrame,
    metrics: Sequence[str],
    window_size: str,
    dimension: str = ALL,
    value_column: str | None = None,
) -> DataFrame:
    """Windowed results to narrow rows, one per metric; the time is the window's start."""
    names = ", ".join(f"'{m}', cast({m} as double)" for m in metrics)
    value = F.lit(ALL) if value_column is None else F.col(value_column)
    rows = df.select(
        F.col("window_start").alias("metric_time"),
        value.alias("dimension_value"),
        F.expr(f"stack({len(metrics)}, {names}) as (metric_name, metric_value)"),
    )
    return rows.select(
        "metric_time",
        "metric_name",
        "metric_value",
        F.lit(dimension).alias("dimension"),
        "dimension_value",
        F.lit(window_label(window_size)).alias("window_size"),
    )


def _message(df: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    return df.select(F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()])).alias(MESSAGE))


def _time(column: str) -> Column:
    return F.date_format(column, _TIME)


def pv_uv_messages(df: DataFrame) -> DataFrame:
    return _message(
        df,
        {"metric": F.lit("pv_uv"), "pv": F.col("pv"), "uv": F.col("uv"), "window_time": _time("window_end")},
    )


def download_messages(df: DataFrame) -> DataFrame:
    return _message(
        df,
        {
            "metric": F.lit("download"),
            "app": F.col("app_name"),
            "count": F.col("download_count"),
            "time": _time("window_end"),
        },
    )


def funnel_messages(df: DataFrame) -> DataFrame:
    names = ("impression", "click", "download", "install", "click_rate", "download_rate", "install_rate")
    return _message(
        df, {"metric": F.lit("funnel"), **{n: F.col(n) for n in names}, "time": _time("window_end")}
    )


def alert_messages(df: DataFrame) -> DataFrame:
    """``ALERT`` messages carry the previous count and the time; ``INFO`` messages leave them out."""
    is_alert = F.col("alert_type") == "ALERT"
    percent = F.format_string("%.2f%%", F.col("change_rate") * 100)
    return _message(
        df,
        {
            "type": F.col("alert_type"),
            "message": F.col("message"),
            "previous": F.when(is_alert, F.col("previous_count")),
            "current": F.col("current_count"),
            "change_rate": percent,
            "time": F.when(is_alert, _time("window_end")),
        },
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Events as keyed JSON messages. The key is the event type, as consumers expect."""
    wire = events.withColumns({c: _time(c) for c in ("event_time", "server_time")})
    return wire.select(F.col("event_type").alias("key"), F.to_json(F.struct(*events.columns)).alias(MESSAGE))


def write_event_messages(events: DataFrame, options: Mapping[str, str]) -> None:
    """Send a table of events to a topic; needs the Kafka connector."""
    event_messages(events).write.format("kafka").options(**options).save()


def stream_messages(messages: DataFrame, options: Mapping[str, str], checkpoint: str) -> StreamingQuery:
    """Send a stream of metric messages to a topic; needs the Kafka connector."""
    return (
        messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
    )


def latest_values(batch: DataFrame, ttl: str) -> DataFrame:
    """Of every metric and dimension value the newest window, with the time it expires.

    Windows more than ``MAX_AHEAD`` in the future come from a wrong clock and are left out.
    """
    keys = ["metric_name", "dimension", "dimension_value", "window_size"]
    known = batch.filter(F.col("metric_time") <= F.current_timestamp() + F.expr(f"interval {MAX_AHEAD}"))
    newest = known.groupBy(*keys).agg(F.max(F.struct("metric_time", "metric_value")).alias("n"))
    micros = interval_micros(ttl)
    return newest.select(
        *keys,
        "n.metric_time",
        "n.metric_value",
        F.timestamp_micros(F.unix_micros("n.metric_time") + micros).alias("expires_at"),
    )


_LATEST = (
    "metric_name string, dimension string, dimension_value string, window_size string, metric_time timestamp, "
    "metric_value double, expires_at timestamp, written_at timestamp"
)
_KEY = ["metric_name", "dimension", "dimension_value", "window_size"]
#: A window this far ahead of the sink's clock comes from a wrong clock.
MAX_AHEAD = "1 day"
#: How long a value is stored that is written no more; it is shown no longer than its own lifetime.
KEEP_STORED = "40 days"


def write_latest_snapshot(metric_rows: DataFrame, path: str, checkpoint: str, ttl: str, **trigger) -> StreamingQuery:
    """Keep the latest value of every metric and dimension value in a small table.

    Each batch merges its values with the stored ones by the full key, and writes a new version; readers take the newest one that is complete. The
    version before it stays for readers that have it open, older ones go. ``ttl`` counts from the
    window's start: take the window length (so the value outlives it) plus the time a value may
    stay shown.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merge_latest(spark, latest_values(batch, ttl), path, batch_id)

    writer = metric_rows.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start() if trigger else writer.start()


def write_metric_stream(
    metric_rows: DataFrame, root: str, name: str, checkpoint: str, latest_ttl: str | None = None, **trigger
) -> StreamingQuery:
    """Closed windows of one job into ``realtime/<name>`` and the day folders of ``ads_realtime_metrics``.

    With ``latest_ttl`` also into the latest values below ``latest``, so that one query serves all
    three. A batch writes folders named by the query and its number: run again, it overwrites them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.persist()
        try:
            rows = batch.withColumn("batch", F.lit(f"{query}-{batch_id}"))
            _overwrite(rows, f"{root}/realtime/{name}", "batch")
            dated = rows.withColumn(PARTITION, F.date_format("metric_time", "yyyy-MM-dd"))
            _overwrite(dated, table_path(root, "ads_realtime_metrics"), PARTITION, "batch")
            if latest_ttl:
                merge_latest(spark, latest_values(batch, latest_ttl), f"{root}/latest", batch_id)
        finally:
            batch.unpersist()

    writer = metric_rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def _overwrite(rows: DataFrame, path: str, *partitions: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def merge_latest(spark: SparkSession, values: DataFrame, path: str, batch_id: int) -> None:
    """One batch's latest values into the stored ones. Merging a batch again changes nothing.

    Values expire when they are read. Event times never remove a stored value, so a row from a wrong clock
    takes none with it. What no batch has written for ``KEEP_STORED`` of the sink's own time goes, which bounds the table.
    """
    versions = complete_versions(spark, path)
    now = F.current_timestamp()
    new = values.withColumn("written_at", now)
    stored = _version(spark, path, versions[-1:]).filter(F.col("written_at") > now - F.expr(f"interval {KEEP_STORED}"))
    both = stored.select(*new.columns).unionByName(new)
    latest = both.groupBy(*_KEY).agg(F.max(F.struct("metric_time", "metric_value", "expires_at", "written_at")).alias("n"))
    latest.select(*_KEY, "n.*").write.mode("overwrite").parquet(f"{path}/version={new_version(batch_id)}")
    drop_versions(spark, path, versions[:-1])


def _version(spark: SparkSession, path: str, version: list[str]) -> DataFrame:
    if not version:
        return spark.createDataFrame([], _LATEST)
    return spark.read.schema(_LATEST).parquet(f"{path}/version={version[0]}")


def read_latest(spark: SparkSession, path: str, now: str) -> DataFrame:
    """Values that have not expired at ``now``."""
    stored = _version(spark, path, complete_versions(spark, path)[-1:]).drop("written_at")
    return stored.filter(F.col("expires_at") > F.lit(now).cast("timestamp"))
