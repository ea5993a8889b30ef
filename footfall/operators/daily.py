"""Traffic summaries: per day, hour and event type, new users, drill-downs, distinct-user counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions.expressions import count_where, event_day, half_up, is_type, percent

ALL = "all"


def _bucket(grain: str) -> tuple[str, Column]:
    if grain == "day":
        return "stat_date", event_day()
    if grain == "hour":
        return "stat_hour", F.date_trunc("hour", "event_time")
    raise ValueError(f"grain must be 'day' or 'hour', not {grain!r}")


def traffic_summary(
    dwd: DataFrame, grain: str = "day", by_type: bool = False, approx_new: bool = False
) -> DataFrame:
    """One row per period (and event type): the daily-metrics columns, for all periods in one job.

    The detail rows are read once. Grouping sets count them per user, per city and
    per device of each period, with map-side partial sums, so neither a busy user
    nor a busy city is ever one task's whole input. Everything after works on those
    counts. A user is new in the first period of ``dwd`` it appears in; with
    ``approx_new`` every visitor counts as new.
    """
    name, period = _bucket(grain)
    page_view = is_type("page_view")
    rows = dwd.select(period.alias(name), "event_type", "user_id", "city", "device_model", "duration")
    typed = ["event_type"] if by_type else []
    sets = [[name, dim] for dim in ("user_id", "city", "device_model")]
    if by_type:
        sets += [[name, "event_type", dim] for dim in ("user_id", "city", "device_model")]
    # grouping_id must see every grouping column in order.
    keys = [name, *typed, "user_id", "city", "device_model"]
    is_kept = {dim: F.grouping(dim) == 0 for dim in ("user_id", "city", "device_model")}
    kind = F.when(is_kept["user_id"], "user").when(is_kept["city"], "city").otherwise("device")
    # Inside a grouping set the key is null where it is not grouped, so counts use a copy.
    counted = rows.withColumns({"_type": F.col("event_type")})
    of_type = lambda t: count_where(F.col("_type") == t)
    counts = counted.groupingSets([[*s] for s in sets], *keys).agg(
        kind.alias("kind"),
        (F.grouping("event_type") if by_type else F.lit(1)).alias("is_all"),
        F.count("*").alias("events"),
        of_type("page_view").alias("views"),
        F.sum(F.when(F.col("_type") == "page_view", F.col("duration").cast("bigint"))).alias("view_ms"),
        of_type("app_download").alias("downloads"),
        of_type("search_query").alias("searches"),
    )
    event_type = F.when(F.col("is_all") == 1, ALL).otherwise(F.col("event_type")) if by_type else F.lit(ALL)
    counts = counts.withColumn("event_type", event_type)
    is_user = F.col("kind") == "user"
    if approx_new:
        is_new = is_user
    else:
        # At most one row per user and period: a bounded group, whoever the user is.
        first = F.min(name).over(Window.partitionBy("user_id", "city", "device_model"))
        counts = counts.withColumn("_first", first)
        is_new = is_user & (F.col("_first") == F.col(name))
    of_users = lambda c: F.coalesce(F.sum(F.when(is_user, F.col(c))), F.lit(0))
    city = F.when(F.col("kind") == "city", F.col("city"))
    device = F.when(F.col("kind") == "device", F.col("device_model"))
    weight = lambda kind: F.when(F.col("kind") == kind, F.col("events"))
    merged = counts.groupBy(name, "event_type").agg(
        of_users("events").alias("pv"),
        count_where(is_user).alias("uv"),
        count_where(is_new).alias("new_user_count"),
        of_users("views").alias("_views"),
        of_users("view_ms").alias("_view_ms"),
        _top(city, weight("city")).alias("top_city"),
        _top(device, weight("device")).alias("top_device"),
        of_users("downloads").alias("download_count"),
        of_users("searches").alias("search_count"),
    )
    average = half_up(F.col("_view_ms").cast("double") / F.col("_views"))
    return merged.select(
        name,
        "event_type",
        "pv",
        "uv",
        "new_user_count",
        F.when(F.col("_views") > 0, average).otherwise(F.lit(0.0)).alias("avg_duration"),
        "top_city",
        "top_device",
        "download_count",
        "search_count",
    )


def _top(value: Column, weight: Column) -> Column:
    return F.min(F.when(value.isNotNull(), F.struct((-weight).alias("w"), value.alias("v"))))["v"]


def daily_summary(dwd: DataFrame, by_type: bool = False, approx_new: bool = False) -> DataFrame:
    return traffic_summary(dwd, "day", by_type, approx_new)


def hourly_summary(dwd: DataFrame, by_type: bool = False) -> DataFrame:
    return traffic_summary(dwd, "hour", by_type)


def top_value(df: DataFrame, group: Sequence[str], column: str) -> DataFrame:
    """The most frequent ``column`` of each group; of equals, the smallest text."""
    counts = df.groupBy(*group, column).agg(F.count("*").alias("n"))
    return counts.groupBy(*group).agg(_top(F.col(column), F.col("n")).alias(f"top_{column}"))


def first_seen(dwd: DataFrame) -> DataFrame:
    """The first active day of every user; kept as a table it makes new users an incremental job."""
    return dwd.groupBy("user_id").agg(F.min(event_day()).alias("first_date"))


def new_users(dwd: DataFrame) -> DataFrame:
    """New users per day over the whole history: one pass, one minimum per user."""
    return (
        first_seen(dwd)
        .groupBy(F.col("first_date").alias("stat_date"))
        .agg(F.count("*").alias("new_user_count"))
    )


def new_users_of_day(day_rows: DataFrame, seen_before: DataFrame) -> DataFrame:
    """The day's users missing from ``seen_before``: the incremental form, an anti-join."""
    return day_rows.select("user_id").distinct().join(seen_before.select("user_id"), "user_id", "left_anti")


def drill_down(dwd: DataFrame, dims: Sequence[str], how: str = "cube") -> DataFrame:
    """PV, UV and downloads over every combination (``cube``) or prefix (``rollup``) of ``dims``.

    Rows are first merged per user and finest cell; only those pairs are expanded.
    A dimension that is summed over reads ``all``.
    """
    pairs = dwd.groupBy(*dims, "user_id").agg(
        F.count("*").alias("events"), count_where(is_type("app_download")).alias("downloads")
    )
    cells = pairs.cube(*dims) if how == "cube" else pairs.rollup(*dims)
    level = cells.agg(
        F.grouping_id().cast("int").alias("level"),
        *[F.grouping(d).alias(f"_all_{d}") for d in dims],
        F.sum("events").alias("pv"),
        F.countDistinct("user_id").alias("uv"),
        F.sum("downloads").alias("download_count"),
    )
    labels = [F.when(F.col(f"_all_{d}") == 1, ALL).otherwise(F.col(d)).alias(d) for d in dims]
    return level.select(*labels, "level", "pv", "uv", "download_count")


def city_distribution(dwd: DataFrame) -> DataFrame:
    """Users per city and each city's share of the sum over cities, in percent."""
    cities = dwd.groupBy("city").agg(F.countDistinct("user_id").alias("user_count"))
    # One row per city: the grand total is a window over a catalogue-sized table.
    total = F.sum("user_count").over(Window.partitionBy())
    return cities.select("city", "user_count", percent(F.col("user_count"), total).alias("user_share"))


def uv_approx(dwd: DataFrame, rsd: float = 0.02) -> DataFrame:
    return dwd.groupBy(event_day().alias("stat_date")).agg(
        F.approx_count_distinct("user_id", rsd).alias("uv_approx")
    )


def uv_sketches(dwd: DataFrame, log_k: int = 14) -> DataFrame:
    """One mergeable distinct-user sketch per day (relative error below 1 % at ``log_k`` 14)."""
    return dwd.groupBy(event_day().alias("stat_date")).agg(
        F.hll_sketch_agg("user_id", F.lit(log_k)).alias("uv_sketch")
    )


def uv_from_sketches(sketches: DataFrame, *keys: str | Column) -> DataFrame:
    """Distinct users of any union of days, from the stored sketches alone."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("uv_sketch")).alias("uv_estimate")
    )


def uv_bitmap(dwd: DataFrame, user_number: Column) -> DataFrame:
    """Exact distinct users per day from bitmaps of 32,768 users; needs integer user numbers."""
    bits = dwd.select(event_day().alias("stat_date"), user_number.alias("n")).filter("n is not null")
    chunks = bits.groupBy("stat_date", F.bitmap_bucket_number("n").alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")
    )
    return chunks.groupBy("stat_date").agg(F.sum(F.bitmap_count("bits")).alias("uv"))


def uv_of_sets(dwd: DataFrame, grain: str = "day") -> DataFrame:
    """The size of each period's set of users; the set itself is never collected into one row."""
    name, period = _bucket(grain)
    return dwd.select(period.alias(name), "user_id").distinct().groupBy(name).agg(F.count("user_id").alias("uv"))
