"""Sessions: runs of a user's events with gaps below 30 minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions.expressions import interval_micros


def _bins(df: DataFrame, gap: str) -> DataFrame:
    """``(user_id, bin, t_min, t_max, events, session_start)``, times in microseconds.

    Events in a bin shorter than the gap always share a session, so a bin is all a
    user needs to keep: merged before the shuffle, a user's window is bounded by the
    length of the log, not by the number of events.
    """
    gap_micros = interval_micros(gap)
    bins = (
        df.filter("user_id is not null and event_time is not null")
        .groupBy("user_id", _bin(gap).alias("bin"))
        .agg(
            F.min(F.unix_micros("event_time")).alias("t_min"),
            F.max(F.unix_micros("event_time")).alias("t_max"),
            F.count("*").alias("events"),
        )
    )
    in_time = Window.partitionBy("user_id").orderBy("bin")
    before = F.lag("t_max").over(in_time)
    starts = F.when(before.isNull() | (F.col("t_min") - before >= gap_micros), F.col("t_min"))
    opened = bins.withColumn("_starts", starts)
    return opened.withColumn("session_start", F.last("_starts", ignorenulls=True).over(in_time)).drop("_starts")


def _bin(gap: str) -> Column:
    return F.floor(F.unix_micros("event_time") / (interval_micros(gap) // 3))


def session_key(user: Column, start_micros: Column) -> Column:
    """A repeatable session id in place of a random one."""
    digest = F.md5(F.concat_ws("_", user, start_micros.cast("string")))
    return F.concat(F.lit("sess_"), F.substring(digest, 1, 12))


def sessions(df: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """One row per session. A gap of exactly ``gap`` starts a new session."""
    merged = _bins(df, gap).groupBy("user_id", "session_start").agg(
        F.max("t_max").alias("t_max"), F.sum("events").alias("event_count")
    )
    return merged.select(
        session_key(F.col("user_id"), F.col("session_start")).alias("session_id"),
        "user_id",
        F.timestamp_micros("session_start").alias("session_start"),
        F.timestamp_micros("t_max").alias("session_end"),
        "event_count",
    )


def sessionize(df: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """The rows with ``session_id`` filled in; rows without a user or time keep null.

    Rows meet their bin's session on (user, bin): one short bin per key, which the
    adaptive skew join can split when a user is very busy.
    """
    starts = _bins(df, gap).select(
        "user_id", F.col("bin").alias("_bin"), session_key(F.col("user_id"), F.col("session_start")).alias("_id")
    )
    columns = list(dict.fromkeys([*df.columns, "session_id"]))
    rows = df.withColumn("_bin", _bin(gap))
    return rows.join(starts, ["user_id", "_bin"], "left").withColumn("session_id", F.col("_id")).select(*columns)


def session_windows(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Streaming form, on Spark's session windows.

    Spark joins events exactly one gap apart, so its gap is one microsecond shorter.
    """
    short = f"{interval_micros(gap) - 1} microseconds"
    merged = events.groupBy("user_id", F.session_window("event_time", short).alias("w")).agg(
        F.count("*").alias("event_count"), F.max("event_time").alias("session_end")
    )
    start = F.col("w.start")
    return merged.select(
        session_key(F.col("user_id"), F.unix_micros(start)).alias("session_id"),
        "user_id",
        start.alias("session_start"),
        "session_end",
        "event_count",
    )
