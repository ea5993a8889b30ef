"""The running sums behind the user profile, moved on by what days add and take away."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.clean import Day, as_date
from footfall.operators.profile import PART_KEY, PART_SUMS, merge_parts, profile_parts, signed
from footfall.sinks.tables import complete_versions, drop_versions, new_version, table_path
from footfall.sources.tables import read_layer

#: One row per user and one per user and device (``kind=parts``); one per day that is in them (``kind=days``).
_STATE = (
    "user_id string, by_day boolean, device_model string, events long, downloads long, searches long, purchases long, "
    "days long, first_seen timestamp, last_seen timestamp, stat_date date, digest string, kind string"
)
_TABLE = "dws_profile_parts"
_DAY_COLUMNS = ("user_id", "stat_date", "device_model", "events", "downloads", "searches", "purchases", "first_seen", "last_seen")


def settle_profile(spark: SparkSession, root: str, fresh: DataFrame, days: Sequence[Day]) -> DataFrame:
    """Moves the sums on from the stored version of ``days`` in ``dws_user_days`` to ``fresh``, their new rows; returns the parts.

    Call it before ``fresh`` is written to ``dws_user_days``, and only then write it. What changes is the
    new version of the days minus their old one, so of the history only these days are read, and one row per
    user and device. First and last times cannot be taken away: users whose first or last event
    goes get theirs from all their days, nobody else.

    The parts and the digests of the days that they hold are written as one version, which counts once it is
    complete. So a run that was stopped may be started again: days that are in already are not added
    twice, and if the stored days are not those that the parts hold, the parts are made anew from all days.
    """
    wanted = [as_date(d) for d in days]
    path = table_path(root, _TABLE)
    versions = complete_versions(spark, path)
    stored = read_layer(spark, root, "dws_user_days").select(*_DAY_COLUMNS, "dt")
    named = [str(d) for d in wanted]
    old = stored.filter(F.col("dt").isin(*named)).drop("dt")
    others = stored.filter(~F.col("dt").isin(*named)).drop("dt")
    fresh = fresh.select(*_DAY_COLUMNS)

    # A row per day, here and below.
    now, was, held = _digests(fresh), _digests(old), _held(spark, path, versions)
    there = {r.stat_date for r in stored.select(F.col("dt").cast("date").alias("stat_date")).distinct().collect()}
    open_days = [d for d in wanted if held.get(d) != now.get(d)]
    sound = bool(versions) and all(held.get(d) == was.get(d) for d in open_days) and held.keys() - set(wanted) == there - set(wanted)
    if sound and not open_days:
        return _parts(spark, path, versions[-1])

    if sound:
        of_open = F.col("stat_date").isin(*open_days)
        add, take = profile_parts(fresh.filter(of_open)), profile_parts(old.filter(of_open))
        before = _parts(spark, path, versions[-1])
        moved = before.unionByName(signed(add, 1)).unionByName(signed(take, -1))
        lost = _lost_extremes(fresh.filter(of_open), old.filter(of_open)) if was else None
        if lost is not None and not lost.isEmpty():
            every = others.unionByName(fresh).join(lost, "user_id", "left_semi")
            times = profile_parts(every).select(*PART_KEY, *[F.lit(0).cast("bigint").alias(c) for c in PART_SUMS], "first_seen", "last_seen")
            gone = F.col("lost").isNotNull()
            bare = moved.join(lost.withColumn("lost", F.lit(True)), "user_id", "left")
            bare = bare.withColumns({c: F.when(~gone, F.col(c)) for c in ("first_seen", "last_seen")}).drop("lost")
            moved = bare.unionByName(times)
        digests = {d: x for d, x in held.items() if d not in open_days} | {d: now[d] for d in open_days if d in now}
    else:
        moved = profile_parts(others.unionByName(fresh))
        digests = _digests(others) | now
    version = new_version(0)
    _write(spark, merge_parts(moved), digests, f"{path}/version={version}")
    drop_versions(spark, path, versions[:-1])
    return _parts(spark, path, version)


def _digests(rows: DataFrame) -> dict[dt.date, str]:
    """Per day its rows and two sums of row hashes, which no order of the rows changes."""
    hashes = [F.sum(F.xxhash64(F.lit(seed), *_DAY_COLUMNS).cast("decimal(38,0)")) for seed in (1, 2)]
    found = rows.groupBy("stat_date").agg(F.concat_ws(":", F.count("*"), *hashes).alias("digest"))
    return {r.stat_date: r.digest for r in found.collect()}


def _lost_extremes(fresh: DataFrame, old: DataFrame) -> DataFrame:
    """Users whose first event of the old days came before, or whose last one after, all that the new ones have."""
    times = lambda rows, sign: rows.select("user_id", F.lit(sign).alias("sign"), "first_seen", "last_seen")
    both = times(fresh, 1).unionByName(times(old, -1)).groupBy("user_id")
    of = lambda c, sign: F.when(F.col("sign") == sign, F.col(c))
    seen = both.agg(
        F.min(of("first_seen", 1)).alias("first_new"), F.min(of("first_seen", -1)).alias("first_old"),
        F.max(of("last_seen", 1)).alias("last_new"), F.max(of("last_seen", -1)).alias("last_old"),
    )
    goes = F.col("first_new").isNull() | (F.col("first_old") < F.col("first_new")) | (F.col("last_old") > F.col("last_new"))
    return seen.filter(F.col("first_old").isNotNull() & goes).select("user_id")


def _write(spark: SparkSession, parts: DataFrame, digests: dict[dt.date, str], path: str) -> None:
    listed = spark.createDataFrame(sorted(digests.items()), "stat_date date, digest string").withColumn("kind", F.lit("days"))
    rows = parts.withColumn("kind", F.lit("parts")).unionByName(listed, allowMissingColumns=True)
    rows.write.partitionBy("kind").parquet(path)


def _state(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.schema(_STATE).parquet(f"{path}/version={version}")


def _parts(spark: SparkSession, path: str, version: str) -> DataFrame:
    return _state(spark, path, version).filter("kind = 'parts'").drop("stat_date", "digest", "kind")


def _held(spark: SparkSession, path: str, versions: list[str]) -> dict[dt.date, str]:
    if not versions:
        return {}
    days = _state(spark, path, versions[-1]).filter("kind = 'days'").select("stat_date", "digest")
    return {r.stat_date: r.digest for r in days.collect()}
