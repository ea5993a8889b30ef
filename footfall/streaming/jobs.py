"""Streaming forms of the cleaning and of the windowed metrics, and how they are run."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from footfall.functions.expressions import interval_micros, valid_event_type, valid_user
from footfall.operators.clean import CHECKED, fill_defaults, parse_times
from footfall.session import configure_streaming, scratch_dir
from footfall.sinks.tables import PARTITION, drop_folder, folder_days, folder_numbers, is_complete

WATERMARK = "5 seconds"
CHECKPOINT_INTERVAL = "60 seconds"

# The functions of this module travel to the executors by value: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def with_event_time(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Event time from ``event_time``, rows up to ``delay`` out of order."""
    return events.withWatermark("event_time", delay)


def stream_clean(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Streaming ODS to DWD. Of copies, the first to arrive is kept while the watermark remembers its id."""
    unique = with_event_time(parse_times(events), delay).dropDuplicatesWithinWatermark(["event_id"])
    return fill_defaults(unique.filter(valid_user() & valid_event_type()))


def stream_clean_newest(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Streaming ODS to DWD with the newest copy of each event, as in batch; rows come out when the
    watermark has passed them. Copies share their event time; of others the first to close is kept.
    """
    timed = with_event_time(parse_times(events), delay).filter("event_id is not null")
    rest = [c for c in timed.columns if c not in ("event_id", "event_time", "server_time")]
    rest.sort(key=lambda c: CHECKED.index(c) if c in CHECKED else len(CHECKED))
    newest = timed.groupBy("event_time", "event_id").agg(F.max(F.struct("server_time", *rest)).alias("e"))
    rows = newest.select("event_id", "event_time", "e.*").select(*events.columns)
    unique = rows.dropDuplicatesWithinWatermark(["event_id"])
    return fill_defaults(unique.filter(valid_user() & valid_event_type()))


def clean_stateless(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Validation and fill only, for metrics that do not need de-duplication."""
    valid = parse_times(events).filter(valid_user() & valid_event_type())
    return with_event_time(fill_defaults(valid), delay)


def land(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append events to day folders (the ODS or DWD landing of a stream)."""
    rows = stream.withColumn("dt", F.date_format("event_time", "yyyy-MM-dd"))
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy("dt")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return writer.trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL})).start()


def to_console(stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
    """Debug sink."""
    writer = stream.writeStream.format("console").option("truncate", "false")
    return writer.option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"processingTime": CHECKPOINT_INTERVAL})
    ).start()


def to_table(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append closed windows to a file table; restarting from the checkpoint repeats nothing."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(
        **(trigger or {"processingTime": CHECKPOINT_INTERVAL})
    ).start()


def run_available(stream: DataFrame, purpose: str) -> DataFrame:
    """Run a stream over everything there is now and return what it wrote, read back."""
    spark = stream.sparkSession
    configure_streaming(spark)
    folder = scratch_dir(spark, purpose)
    to_table(stream, f"{folder}/out", f"{folder}/checkpoint", availableNow=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


_SUMS = ("events", "downloads", "searches")
_COUNTS = "stat_date date, user_id string, events long, downloads long, searches long, dt string, batch long"
#: Numbers of one run; its batches have even ones.
_RUN = 2_000_000_000


def incremental_daily(
    events: DataFrame, path: str, checkpoint: str, compact_every: int = 50, **trigger
) -> StreamingQuery:
    """Keep per-day counts current as rows arrive: a running aggregate whose touched days are overwritten.

    The state is one row per user and day. Days are windows, so the watermark drops
    the state of days that can no longer change. Every ``compact_every`` batches the folders of the batches
    are merged, see ``compact_daily``.
    """
    users = events.groupBy(F.window("event_time", "1 day"), "user_id").agg(
        F.count("*").alias("events"),
        F.count(F.when(F.col("event_type") == "app_download", 1)).alias("downloads"),
        F.count(F.when(F.col("event_type") == "search_query", 1)).alias("searches"),
    )

    spark = events.sparkSession
    # Behind all that any earlier run has stored, whatever its checkpoint and the clock.
    run = max(folder_numbers(spark, f"{path}/{PARTITION}=*", "batch"), default=0) // _RUN + 1

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # The changed users of this batch, one small file set per batch. Counts only grow, and those of
        # a later run, even from a new checkpoint, stand behind all earlier ones.
        rows = batch.withColumn("stat_date", F.to_date("window.start")).drop("window")
        number = run * _RUN + 2 * batch_id
        rows = rows.withColumns({"dt": F.date_format("stat_date", "yyyy-MM-dd"), "batch": F.lit(number)})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "dt", "batch"
        ).parquet(path)
        if batch_id % compact_every == compact_every - 1:
            compact_daily(batch.sparkSession, path, compact_every)

    writer = users.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL})).start()


def compact_daily(spark: SparkSession, path: str, max_open: int = 50) -> list[str]:
    """Merge the batch folders of every day that has ``max_open`` or more of them; returns these days.

    Batches have even numbers. The merged folder has the odd number behind the newest batch that it holds, and per
    user that batch's row, so it says what they say, and a reader may meet both. Its success mark is
    the switch: folders behind a merged one that is complete go at the next call, so those who have
    them open can finish. A call that is stopped anywhere loses nothing and is made good by the next one.
    """
    merged_days = []
    for day in folder_days(spark, path):  # a name per day
        of_day = f"{path}/{PARTITION}={day}"
        numbers = folder_numbers(spark, of_day, "batch")
        merged = max((n for n in numbers if n % 2 and is_complete(spark, f"{of_day}/batch={n}")), default=-1)
        for n in numbers:
            if n < merged:
                drop_folder(spark, f"{of_day}/batch={n}")
        open_ = [n for n in numbers if n > merged]
        batches = [n for n in open_ if n % 2 == 0]
        if len(batches) < max_open:
            continue
        folders = [f"{of_day}/batch={n}" for n in [*([merged] if merged >= 0 else []), *batches]]
        rows = spark.read.schema(_COUNTS).option("basePath", path).parquet(*folders)
        newest = rows.groupBy("stat_date", "user_id").agg(F.max(F.struct("batch", *_SUMS)).alias("n"))
        target = f"{of_day}/batch={batches[-1] + 1}"
        newest.select("stat_date", "user_id", *[f"n.{c}" for c in _SUMS]).write.mode("overwrite").parquet(target)
        merged_days.append(day)
    return merged_days


def read_incremental_daily(spark: SparkSession, path: str) -> DataFrame:
    """The current day totals: per user and day the newest row counts."""
    rows = spark.read.schema(_COUNTS).parquet(path)
    newest = rows.groupBy("stat_date", "user_id").agg(
        F.max(F.struct("batch", "events", "downloads", "searches")).alias("n")
    )
    return newest.groupBy("stat_date").agg(
        F.sum("n.events").alias("pv"),
        F.count("*").alias("uv"),
        F.sum("n.downloads").alias("download_count"),
        F.sum("n.searches").alias("search_count"),
    )


def mark_late(events: DataFrame, delay: str = WATERMARK, shards: int | None = None) -> DataFrame:
    """All rows of a stream with ``is_late``: behind the watermark that their micro-batch runs under.

    Spark drops late rows silently where it keeps time-bounded state. A stateful function without a timeout gets them
    too, and it knows the watermark, which the checkpoint carries over restarts. It keeps no state of its own. A null
    time is not late. Rows are dealt by hash over ``shards`` groups, by default two per shuffle partition.
    """
    spark = events.sparkSession
    shards = shards or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Longs travel as text: pandas makes floats of a column with nulls.
    kinds = {f.name: T.StringType() if isinstance(f.dataType, T.LongType) else f.dataType for f in events.schema}
    out = T.StructType([*[T.StructField(n, kind) for n, kind in kinds.items()], T.StructField("is_late", T.BooleanType())])

    def judge(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs() * 1000
        for part in parts:
            # A missing number compares as false.
            yield part.assign(is_late=part["_micros"] < watermark).drop(columns=["_shard", "_micros"])

    shard = F.pmod(F.xxhash64("event_id", "event_time"), F.lit(shards)).alias("_shard")
    columns = [F.col(n).cast(kind) if kind != events.schema[n].dataType else F.col(n) for n, kind in kinds.items()]
    timed = with_event_time(events, delay).select(*columns, shard, F.unix_micros("event_time").alias("_micros"))
    marked = timed.groupBy("_shard").applyInPandasWithState(judge, out, "unused int", "append", GroupStateTimeout.NoTimeout)
    return marked.select(*[F.col(f.name).cast(f.dataType) for f in events.schema], "is_late")


def split_late(events: DataFrame, path: str, checkpoint: str, delay: str = WATERMARK, **trigger) -> StreamingQuery:
    """Send rows behind the watermark aside instead of dropping them: folders ``late`` and ``on_time``.

    Every batch writes folders of its own number: a repeated batch overwrites, never doubles.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, part in (("late", batch.filter("is_late")), ("on_time", batch.filter("not is_late"))):
                part.drop("is_late").write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = mark_late(events, delay).writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL})).start()


def followed_within(first: DataFrame, then: DataFrame, within: str, slices: int = 4) -> DataFrame:
    """Stream-stream interval join: rows of ``first`` whose user has a row of ``then`` at most ``within`` later.

    A semi-join: each row (id, user, time) comes out once, however many rows follow, and no pairs
    are made. Rows of ``then`` with one user and time are one. Both inputs carry a watermark on
    ``event_time``, which bounds the state.

    A user may hold a third of all rows, so the join key is user, time bucket and slice. A row of ``first`` stands in
    the bucket of its time and in one slice by the hash of its id; what may follow it lies in this bucket or the next,
    so a row of ``then`` stands in its own bucket and the one before, in every slice. No row of ``first`` meets a row
    twice. More ``slices`` spread a user further and copy the smaller, merged side more often.
    """
    bucket = F.floor(F.unix_micros("event_time") / interval_micros(within)).alias("bucket")
    piece = F.pmod(F.xxhash64("event_id"), F.lit(slices)).cast("int").alias("slice")
    a = first.select("event_id", "user_id", "event_time", bucket, piece).alias("a")
    merged = then.select("user_id", "event_time").dropDuplicates(["user_id", "event_time"])
    before = merged.select("user_id", "event_time", F.explode(F.array(bucket, bucket - 1)).alias("bucket"))
    b = before.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")).alias("b")
    on = F.expr(
        "a.user_id = b.user_id and a.bucket = b.bucket and a.slice = b.slice and b.event_time > a.event_time "
        f"and b.event_time <= a.event_time + interval {within}"
    )
    return a.join(b, on, "left_semi").select("event_id", "user_id", "event_time")
