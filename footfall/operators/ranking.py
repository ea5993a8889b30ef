"""Top-k downloads and reproducible sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.expressions import app_name, is_type
from footfall.operators.clean import Day, last_days, on_day


def _top(rows: DataFrame, limit: int, missing: str | None) -> DataFrame:
    counts = (
        rows.filter(is_type("app_download"))
        .groupBy(app_name(missing).alias("app_name"))
        .agg(F.count("*").alias("download_count"))
    )
    return counts.orderBy(F.col("download_count").desc(), F.col("app_name").asc_nulls_first()).limit(limit)


def top_downloads(dwd: DataFrame, as_of: Day, days: int = 7, limit: int = 10) -> DataFrame:
    """Most downloaded apps from ``as_of - days`` on; of equals, by name. A missing name is ``''``."""
    return _top(last_days(dwd, as_of, days), limit, "")


def top_downloads_of_day(dwd: DataFrame, day: Day, limit: int = 10) -> DataFrame:
    """The same for one day; a missing name is null."""
    return _top(on_day(dwd, day), limit, None)


def sample_users(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` users in a seeded order: a random-looking but repeatable sample."""
    users = df.select("user_id").filter("user_id is not null").distinct()
    return users.orderBy(F.md5(F.concat_ws("_", F.lit(str(seed)), "user_id")), "user_id").limit(n)


def sample_fraction(df: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """A fraction of the rows, drawn per partition without a shuffle."""
    return df.sample(fraction=fraction, seed=seed)
