"""Column expressions shared by the operators; all stay inside JVM codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.schema import EVENT_TYPES, UNKNOWN


def half_up(value: Column, digits: int = 2) -> Column:
    """Round half away from zero on the binary value: the same double in every engine.

    ``round`` is avoided: engines disagree on values such as 1.005.
    """
    scale = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` in percent; 0.0 when ``whole`` is zero or missing."""
    scale = float(10**digits)
    ratio = F.floor(part * F.lit(100.0 * scale) / whole + F.lit(0.5)) / F.lit(scale)
    return F.when(whole > 0, ratio).otherwise(F.lit(0.0))


def event_day(time_col: str = "event_time") -> Column:
    return F.to_date(F.col(time_col))


def is_type(*event_types: str) -> Column:
    if len(event_types) == 1:
        return F.col("event_type") == event_types[0]
    return F.col("event_type").isin(*event_types)


def count_where(condition: Column) -> Column:
    """Rows meeting ``condition``; 0, never null, when there are none."""
    return F.count(F.when(condition, F.lit(1)))


def valid_user() -> Column:
    user = F.col("user_id")
    return user.isNotNull() & (user != "") & (user != "null")


def valid_event_type() -> Column:
    return F.col("event_type").isin(*EVENT_TYPES)


def or_unknown(name: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(UNKNOWN))


def json_field(field: str, default: str | None = None, source: str = "properties") -> Column:
    """One field of the JSON text; null (or ``default``) when missing or unparsable."""
    value = F.get_json_object(F.col(source), f"$.{field}")
    return value if default is None else F.coalesce(value, F.lit(default))


def app_name(default: str | None = "unknown") -> Column:
    return json_field("app_name", default)


# The labels and limits of the next two.
def activity_level(total: Column) -> Column:
    return (
        F.when(total >= 100, "高活跃")
        .when(total >= 30, "中活跃")
        .when(total >= 5, "低活跃")
        .otherwise("沉睡用户")
    )


def user_type(purchases: Column, downloads: Column, searches: Column) -> Column:
    return (
        F.when(purchases > 0, "付费用户")
        .when(downloads > 0, "下载型用户")
        .when(searches > 2, "搜索型用户")
        .otherwise("浏览型用户")
    )


def time_slot(time_col: str = "event_time") -> Column:
    """Part of the day. Only the names are documented; the hours are our definition."""
    hour = F.hour(time_col)
    return (
        F.when(hour.between(5, 10), "早")
        .when(hour.between(11, 16), "中")
        .when(hour.between(17, 22), "晚")
        .otherwise("深夜")
    )


def hash_bucket(text: Column, buckets: int = 100) -> Column:
    """First four bytes of the MD5, as an unsigned big-endian number, modulo ``buckets``."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def experiment_bucket(user: Column, experiment: Column) -> Column:
    return hash_bucket(F.concat_ws("_", user, experiment))


def assign_variant(user: Column, experiment: Column, a_share: Column | int) -> Column:
    """``A`` or ``B``: the same user always gets the same group, independently per experiment."""
    share = F.lit(a_share) if isinstance(a_share, int) else a_share
    return F.when(experiment_bucket(user, experiment) < share, "A").otherwise("B")


def parse_time(name: str) -> Column:
    """Text or timestamp to timestamp; null, not an error, on unparsable text."""
    return F.try_to_timestamp(F.col(name).cast("string"))


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def interval_micros(text: str) -> int:
    """``"30 minutes"`` as microseconds."""
    number, unit = text.split()
    return round(float(number) * _UNIT_SECONDS[unit.rstrip("s")] * 1_000_000)


def window_label(text: str) -> str:
    """``"5 minutes"`` as the short form ``5m`` kept in result tables."""
    number, unit = text.split()
    return f"{number}{unit[0]}"
