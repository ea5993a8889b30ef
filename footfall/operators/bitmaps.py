"""Exact distinct users from bitmaps: dense user numbers, a bitmap table, unions and intersections of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions.expressions import event_day, percent
from footfall.operators.retention import RET_DAYS

#: ``monotonically_increasing_id`` counts the rows of a partition in the lower 33 bits.
_ROW_BITS = 33


def drafted_numbers(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """user_id, draft: the different users that ``known`` has not, each with a partition and a place in it.

    The places depend on how the rows lie, so write the result before :func:`dense_numbers` reads it.
    """
    new = users.select("user_id").filter("user_id is not null").distinct()
    if known is not None:
        new = new.join(known.select("user_id"), "user_id", "left_anti")
    return new.withColumn("draft", F.monotonically_increasing_id())


def dense_numbers(drafted: DataFrame, first: int = 1) -> DataFrame:
    """user_id, user_number from ``first`` on without gaps, in no order that users share.

    Places within a partition plus the sizes of the partitions before it: the only window runs over one row
    per partition, and no row is sorted or moved. Append the result to the dimension of known users, whose largest
    number plus one is the next ``first``.
    """
    part = F.shiftright("draft", _ROW_BITS)
    sizes = drafted.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    place = F.col("draft").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # A row per partition: its broadcast is bounded by the number of tasks.
    numbered = drafted.withColumn("part", part).join(F.broadcast(offsets), "part")
    return numbered.select("user_id", (F.lit(first) + F.col("offset") + place).alias("user_number"))


def day_bitmaps(events: DataFrame, numbers: DataFrame) -> DataFrame:
    """stat_date, bucket, bits: a bit per user number and day, 32,768 users to a row of 4 KB.

    Rows are merged per user and day before they meet the numbers; bitmaps merge in the map tasks. Written by
    day, the table answers for any set of days without reading events again.
    """
    days = events.filter("user_id is not null").select(event_day().alias("stat_date"), "user_id").distinct()
    found = days.join(numbers, "user_id")
    return found.groupBy("stat_date", F.bitmap_bucket_number("user_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_number")).alias("bits")
    )


def bitmap_uv(bitmaps: DataFrame, period: Column, name: str) -> DataFrame:
    """Distinct users of each period: its days' bitmaps OR-ed per bucket, then counted."""
    merged = bitmaps.groupBy(period.alias(name), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(name).agg(F.sum(F.bitmap_count("bits")).alias("uv"))


def bitmap_retention(bitmaps: DataFrame, ret_days: Sequence[int] = RET_DAYS) -> DataFrame:
    """N-day retention of all base days, as ``retention`` gives it: the bitmaps of two days AND-ed per bucket.

    A bitmap row goes out once per N as base day and once as the day N later, so a pair of days meets in one group of
    two rows; nothing depends on the number of users in it.
    """
    day, n = F.col("stat_date"), F.col("ret_day")
    pairs = bitmaps.withColumn("ret_day", F.explode(F.array(*[F.lit(i) for i in ret_days])))
    both = pairs.select("bits", "bucket", "ret_day", F.inline(F.array(_role(day, 0), _role(F.date_sub(day, n), 1))))
    met = both.groupBy("first_date", "ret_day", "bucket").agg(
        F.max(F.when(F.col("later") == 0, F.bitmap_count("bits"))).alias("users"),
        F.when(F.count("*") == 2, F.bitmap_count(F.bitmap_and_agg("bits"))).otherwise(0).alias("retained"),
    )
    counts = met.groupBy("first_date", "ret_day").agg(F.sum("users").alias("n"), F.sum("retained").alias("retained_count"))
    return counts.filter("n is not null").select(
        "first_date",
        "ret_day",
        F.col("n").alias("new_user_count"),
        "retained_count",
        percent(F.col("retained_count"), F.col("n")).alias("retention_rate"),
    )


def _role(first_date: Column, later: int) -> Column:
    return F.struct(first_date.alias("first_date"), F.lit(later).alias("later"))
