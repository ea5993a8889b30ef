"""Declared schemas of the event log and of every result table.

One 18-column event schema is shared by the batch jobs and the streams, so a
field such as ``experiment_id`` can never exist in one and be missing in the
other.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The closed vocabulary of event types and the fill value.
EVENT_TYPES = (
    "page_view",
    "app_click",
    "search_query",
    "app_download",
    "ad_impression",
    "ad_click",
    "app_install",
    "in_app_purchase",
)
UNKNOWN = "未知"

EVENT_COLUMNS = (
    ("event_id", T.StringType()),
    ("event_type", T.StringType()),
    ("user_id", T.StringType()),
    ("device_id", T.StringType()),
    ("event_time", T.TimestampType()),
    ("server_time", T.TimestampType()),
    ("device_model", T.StringType()),
    ("os_version", T.StringType()),
    ("app_version", T.StringType()),
    ("session_id", T.StringType()),
    ("page", T.StringType()),
    ("ip", T.StringType()),
    ("city", T.StringType()),
    ("duration", T.IntegerType()),
    ("properties", T.StringType()),
    ("source", T.StringType()),
    ("experiment_id", T.StringType()),
    ("variant", T.StringType()),
)

BEHAVIOR_EVENT = T.StructType([T.StructField(n, t) for n, t in EVENT_COLUMNS])

# On the wire both times are text, so that one bad time does not lose the row.
WIRE_EVENT = T.StructType(
    [
        T.StructField(n, T.StringType() if isinstance(t, T.TimestampType) else t)
        for n, t in EVENT_COLUMNS
    ]
)

DAILY_METRICS = (
    "stat_date date, event_type string, pv long, uv long, new_user_count long, "
    "avg_duration double, top_city string, top_device string, download_count long, search_count long"
)
REALTIME_METRICS = (
    "metric_time timestamp, metric_name string, metric_value double, "
    "dimension string, dimension_value string, window_size string"
)
FUNNEL = (
    "stat_date date, funnel_name string, step_order int, step_name string, "
    "user_count long, step_rate double, overall_rate double"
)
RETENTION = (
    "first_date date, ret_day int, new_user_count long, retained_count long, retention_rate double"
)
AB_EXPERIMENT = (
    "experiment_id string, stat_date date, variant string, metric_name string, metric_value double, "
    "metric_unit string, user_count long, p_value double, is_significant int, uplift double, sample_data string"
)
USER_PROFILE = (
    "user_id string, activity_level string, user_type string, total_events long, active_days long, "
    "downloads long, searches long, purchases long, device_model string, "
    "first_seen timestamp, last_seen timestamp"
)

# Helper tables of the daily run: they spare it from reading the detail history again.
USER_DAYS = (
    "user_id string, stat_date date, device_model string, events long, downloads long, searches long, "
    "purchases long, first_seen timestamp, last_seen timestamp"
)
USER_FIRST_SEEN = "user_id string, first_date date"

# Days each layer table is kept.
TTL_DAYS = {
    "ods_user_behavior_log": 30,
    "dwd_user_behavior": 90,
    "dws_daily_metrics": 365,
    "ads_realtime_metrics": 7,
    "ads_funnel_analysis": 365,
    "ads_retention": 365,
    "ads_ab_experiment": 90,
}
