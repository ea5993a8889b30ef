"""Layer tables and database tables as sources."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from footfall.operators.clean import Day, as_date
from footfall.sinks.tables import PARTITION, layer_schema, table_exists, table_path

#: Where a bucket's number stands in the name of a file that Spark wrote.
_BUCKET = re.compile(r"_(\d{5})(?:\.c\d+)?\.[^/]+$")


def read_layer(
    spark: SparkSession, root: str, table: str, date_from: Day | None = None, date_to: Day | None = None
) -> DataFrame:
    """A layer table, reading only the day folders asked for (both ends included); empty if never written."""
    if not table_exists(spark, root, table):
        return spark.createDataFrame([], layer_schema(table))
    df = spark.read.schema(layer_schema(table)).parquet(table_path(root, table))
    if date_from is not None:
        df = df.filter(df[PARTITION] >= str(as_date(date_from)))
    if date_to is not None:
        df = df.filter(df[PARTITION] <= str(as_date(date_to)))
    return df


def read_buckets(spark: SparkSession, table: str, buckets: Sequence[int]) -> DataFrame:
    """The rows of some buckets of a bucketed table: a repeatable sample of its keys that reads no other file.

    All rows of a key are in one bucket, so of a table of 32 buckets, k of them hold all rows of about k / 32 of the keys. The
    number of a bucket is part of its files' names; only that list comes to the driver, no row does.
    """
    whole = spark.table(table)
    wanted = set(buckets)
    files = [f for f in whole.inputFiles() if (named := _BUCKET.search(f)) and int(named[1]) in wanted]
    if not files:
        return whole.limit(0)
    return spark.read.schema(whole.schema).format(files[0].rsplit(".", 1)[1]).load(files)


def day_slices(day: Day, time_col: str = "event_time", slices: int = 24) -> list[str]:
    """Half-open time predicates that together cover the day, one per JDBC partition."""
    start = dt.datetime.combine(as_date(day), dt.time())
    edges = [start + dt.timedelta(days=1) * i / slices for i in range(slices + 1)]
    return [f"{time_col} >= '{a}' AND {time_col} < '{b}'" for a, b in zip(edges, edges[1:])]


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    date: Day | None = None,
    properties: Mapping[str, str] | None = None,
    partition: Mapping[str, object] | None = None,
    slices: int = 24,
) -> DataFrame:
    """A database table, in parallel.

    With ``date`` the day is cut into ``slices`` predicates that the database
    evaluates. Otherwise ``partition`` gives ``column, lowerBound, upperBound,
    numPartitions`` of a numeric or time column. One of the two is needed: a table is
    never read by a single task.
    """
    if date is None and not partition:
        raise ValueError("give a date or the bounds of a partition column")
    options = {"fetchsize": "10000", **(properties or {})}
    if date is not None:
        return spark.read.jdbc(url, table, predicates=day_slices(date, slices=slices), properties=options)
    return spark.read.jdbc(url, table, properties=options, **(partition or {}))
