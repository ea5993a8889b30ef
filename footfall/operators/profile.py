"""User profiles: totals, labels and preferences, one row per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.expressions import (
    activity_level,
    count_where,
    event_day,
    is_type,
    json_field,
    percent,
    time_slot,
    user_type,
)


def user_days(dwd: DataFrame) -> DataFrame:
    """What a profile needs of the events, merged per user, day and device.

    Kept as a day table, it lets the daily profile refresh and retention read one row
    per user and day instead of the detail history.
    """
    return dwd.groupBy("user_id", event_day().alias("stat_date"), "device_model").agg(
        F.count("*").alias("events"),
        count_where(is_type("app_download")).alias("downloads"),
        count_where(is_type("search_query")).alias("searches"),
        count_where(is_type("in_app_purchase")).alias("purchases"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )


def user_profile(dwd: DataFrame) -> DataFrame:
    return profile_of_days(user_days(dwd))


def profile_of_days(days: DataFrame) -> DataFrame:
    """Totals, first and last activity, most used device and the two labels, one row per user."""
    return profile_of_parts(profile_parts(days))


#: What a part adds up; ``days`` counts the days of a user.
PART_SUMS = ("events", "downloads", "searches", "purchases", "days")
PART_KEY = ("user_id", "by_day", "device_model")


def profile_parts(days: DataFrame) -> DataFrame:
    """``user_days`` merged to one row per (user, day) and one per (user, device).

    All columns but the key add up, or take the least and greatest, over any set of days: parts of
    different days may be united, and those of a day taken away again by ``signed``.
    """
    merged = days.groupingSets(
        [["user_id", "stat_date"], ["user_id", "device_model"]], "user_id", "stat_date", "device_model"
    ).agg(
        (F.grouping("stat_date") == 0).alias("by_day"),
        *[F.sum(c).alias(c) for c in PART_SUMS[:-1]],
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    return merged.select(
        *PART_KEY, *PART_SUMS[:-1], F.col("by_day").cast("bigint").alias("days"), "first_seen", "last_seen"
    )


def signed(parts: DataFrame, sign: int) -> DataFrame:
    """Parts to add (+1), or to take away (-1): those have no times, as an extreme cannot be taken away."""
    times = [F.col(c) if sign > 0 else F.lit(None).cast("timestamp").alias(c) for c in ("first_seen", "last_seen")]
    return parts.select(*PART_KEY, *[(F.col(c) * sign).alias(c) for c in PART_SUMS], *times)


def merge_parts(parts: DataFrame) -> DataFrame:
    """One part per user, and one per user and device; those that nothing is left of go."""
    merged = parts.groupBy(*PART_KEY).agg(
        *[F.sum(c).alias(c) for c in PART_SUMS],
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    return merged.filter("events > 0")


def profile_of_parts(parts: DataFrame) -> DataFrame:
    """The profile of parts, merged or not: the last step sees as many rows of a user as it has days and devices."""
    by_day = F.col("by_day")
    of_days = lambda c: F.coalesce(F.sum(F.when(by_day, F.col(c))), F.lit(0))
    device = F.when(
        ~by_day, F.struct((-F.col("events")).alias("w"), F.col("device_model").alias("v"))
    )
    totals = parts.groupBy("user_id").agg(
        of_days("events").alias("total_events"),
        of_days("days").alias("active_days"),
        of_days("downloads").alias("downloads"),
        of_days("searches").alias("searches"),
        of_days("purchases").alias("purchases"),
        F.min(device)["v"].alias("device_model"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    return totals.select(
        "user_id",
        activity_level(F.col("total_events")).alias("activity_level"),
        user_type(F.col("purchases"), F.col("downloads"), F.col("searches")).alias("user_type"),
        "total_events",
        "active_days",
        "downloads",
        "searches",
        "purchases",
        "device_model",
        "first_seen",
        "last_seen",
    )


def profile_report(profile: DataFrame) -> DataFrame:
    counts = profile.agg(
        F.count("*").alias("users"),
        count_where(F.col("activity_level") == "高活跃").alias("high_active"),
        count_where(F.col("user_type") == "付费用户").alias("paying"),
    )
    return counts.select(
        "users",
        "high_active",
        percent(F.col("high_active"), F.col("users")).alias("high_active_rate"),
        "paying",
        percent(F.col("paying"), F.col("users")).alias("paying_rate"),
    )


def user_preferences(dwd: DataFrame, device_tiers: DataFrame) -> DataFrame:
    """Favourite app category, usual part of the day, device and its tier, per user.

    Documented, never computed, by the original. ``device_tiers(device_model,
    device_tier)`` is a catalogue; it is broadcast only while Spark's size statistics
    say it is small.
    """
    counts = (
        dwd.select(
            "user_id",
            json_field("app_category").alias("category"),
            time_slot().alias("slot"),
            "device_model",
        )
        .groupingSets(
            [["user_id", "category"], ["user_id", "slot"], ["user_id", "device_model"]],
            "user_id",
            "category",
            "slot",
            "device_model",
        )
        .agg(
            F.when(F.grouping("category") == 0, "category")
            .when(F.grouping("slot") == 0, "slot")
            .otherwise("device")
            .alias("kind"),
            F.count("*").alias("n"),
        )
    )

    def favourite(kind: str, column: str):
        value = F.col(column)
        seen = (F.col("kind") == kind) & value.isNotNull()
        return F.min(F.when(seen, F.struct((-F.col("n")).alias("w"), value.alias("v"))))["v"]

    per_user = counts.groupBy("user_id").agg(
        favourite("category", "category").alias("preferred_category"),
        favourite("slot", "slot").alias("time_slot"),
        favourite("device", "device_model").alias("device_model"),
    )
    return per_user.join(device_tiers, "device_model", "left").select(
        "user_id", "preferred_category", "time_slot", "device_model", "device_tier"
    )
