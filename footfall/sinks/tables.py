"""Layer tables: day-partition overwrite, merges, expiry, buckets; database tables."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall import schema as S
from footfall.operators.clean import Day, as_date, dedup_latest

PARTITION = "dt"

# Table: (columns, the column its day comes from, order inside a file).
_LAYERS: dict[str, tuple[T.StructType | str, str | None, Sequence[str]]] = {
    "ods_user_behavior_log": (S.BEHAVIOR_EVENT, "event_time", ("event_type", "event_time", "user_id")),
    "dwd_user_behavior": (S.BEHAVIOR_EVENT, "event_time", ("event_type", "event_time", "user_id")),
    "dws_daily_metrics": (S.DAILY_METRICS, "stat_date", ("event_type",)),
    "ads_realtime_metrics": (S.REALTIME_METRICS, "metric_time", ("metric_time", "metric_name")),
    "ads_funnel_analysis": (S.FUNNEL, "stat_date", ("funnel_name", "step_order")),
    "ads_retention": (S.RETENTION, "first_date", ("ret_day",)),
    "ads_ab_experiment": (S.AB_EXPERIMENT, "stat_date", ("experiment_id", "variant", "metric_name")),
    "ads_user_profile": (S.USER_PROFILE, None, ("user_id",)),
    "dws_user_days": (S.USER_DAYS, "stat_date", ("user_id",)),
    "dim_user_first_seen": (S.USER_FIRST_SEEN, "first_date", ("user_id",)),
}


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def layer_schema(table: str) -> T.StructType:
    """Declared columns, with the day as text, so a read infers nothing."""
    columns, day, _ = _LAYERS[table]
    struct = columns if isinstance(columns, T.StructType) else T.StructType.fromDDL(columns)
    fields = list(struct.fields)
    return T.StructType(fields + [T.StructField(PARTITION, T.StringType())] if day else fields)


def table_exists(spark: SparkSession, root: str, table: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, table))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def ensure_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def new_version(batch_id: int) -> str:
    """A folder name that sorts behind those of earlier runs, whatever checkpoint they had."""
    return f"{time.time_ns() // 1_000_000:015d}-{batch_id:09d}"


def complete_versions(spark: SparkSession, path: str) -> list[str]:
    """The ``version=…`` folders below ``path`` that were written to the end, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    done = [n for n in names if n.startswith("version=") and files.exists(_child(spark, path, f"{n}/_SUCCESS"))]
    return sorted(n.removeprefix("version=") for n in done)


def drop_versions(spark: SparkSession, path: str, versions: list[str]) -> None:
    for version in versions:
        folder = _child(spark, path, f"version={version}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers N of the folders ``<name>=N`` that match ``path``, a folder or a pattern of folders, in order."""
    pattern = _child(spark, path, f"{name}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(status.getPath().getName().split("=", 1)[1]) for status in found or [])


def folder_days(spark: SparkSession, path: str) -> list[str]:
    pattern = _child(spark, path, f"{PARTITION}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(status.getPath().getName().split("=", 1)[1] for status in found or [])


def is_complete(spark: SparkSession, path: str) -> bool:
    """Was this folder written to its end, by a job of its own?"""
    mark = _child(spark, path, "_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _child(spark: SparkSession, path: str, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")


def write_layer(df: DataFrame, root: str, table: str, day: Day | None = None) -> None:
    """Overwrite days of a layer table; rerunning a day changes nothing.

    With ``day`` all rows belong to that day, whose folder is replaced even when there
    are none. Without it, the day folders that ``df`` touches are replaced, no others.
    A table without a day column is replaced whole.

    The rebalance hint lets AQE split a heavy day over many tasks and merge light ones,
    so files get even sizes; rows are sorted inside a file for its min/max statistics.
    """
    columns, day_column, order = _LAYERS[table]
    names = layer_schema(table).fieldNames()
    path = table_path(root, table)
    if day_column is None:
        df.select(*names).hint("rebalance").write.mode("overwrite").parquet(path)
    elif day is not None:
        rows = df.select(*[n for n in names if n != PARTITION]).hint("rebalance").sortWithinPartitions(*order)
        rows.write.mode("overwrite").parquet(f"{path}/{PARTITION}={as_date(day)}")
    else:
        rows = df.withColumn(PARTITION, F.date_format(day_column, "yyyy-MM-dd")).select(*names)
        (
            rows.hint("rebalance", PARTITION)
            .sortWithinPartitions(PARTITION, *order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PARTITION)
            .parquet(path)
        )


def write_bucketed(df: DataFrame, table: str, buckets: int = 32, key: str = "event_id") -> None:
    """ORC table bucketed on ``key`` with a bloom filter: joins on the key need no shuffle."""
    (
        df.write.mode("overwrite")
        .format("orc")
        .option("compression", "snappy")
        .option("orc.bloom.filter.columns", key)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )


def write_jdbc_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
    connections: int = 16,
) -> None:
    """Write in batches of 10,000 rows over at most ``connections`` connections."""
    options = {"batchsize": "10000", "numPartitions": str(connections), **(properties or {})}
    df.write.mode(mode).jdbc(url, table, properties=options)


def replacing_merge(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per key, the newest version."""
    return dedup_latest(df, keys, version)


def summing_merge(
    df: DataFrame, keys: Sequence[str], sums: Sequence[str], firsts: Sequence[str] = (), version: str | None = None
) -> DataFrame:
    """One row per key: ``sums`` added up; of ``firsts`` the row with the lowest ``version`` is taken whole.

    Only additive columns belong in ``sums``: an average must not be summed.
    """
    merged = [F.sum(c).alias(c) for c in sums]
    if firsts:
        taken = F.struct(*([version] if version else []), *firsts)
        merged.append(F.min(taken).alias("_first"))
    out = df.groupBy(*keys).agg(*merged)
    return out.select(*keys, *sums, *[F.col(f"_first.{c}").alias(c) for c in firsts])


def apply_ttl(df: DataFrame, time_col: str, days: int, as_of: Day) -> DataFrame:
    """Rows younger than ``days`` days at ``as_of``."""
    return df.filter(F.col(time_col) > F.lit(str(as_date(as_of) - dt.timedelta(days=days))).cast("timestamp"))


def drop_expired(spark: SparkSession, root: str, table: str, as_of: Day, days: int | None = None) -> list[str]:
    """Delete the day folders older than the table's lifetime; returns the days dropped."""
    cutoff = str(as_date(as_of) - dt.timedelta(days=S.TTL_DAYS[table] if days is None else days))
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(table_path(root, table))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(f"{PARTITION}=") and name.split("=", 1)[1] < cutoff:
            files.delete(status.getPath(), True)
            dropped.append(name.split("=", 1)[1])
    return sorted(dropped)
