"""The event log as a message stream, as JSON-lines files, and as decoded rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators.clean import parse_times
from footfall.schema import WIRE_EVENT

_CORRUPT = "_corrupt_record"
_DECODE_SCHEMA = T.StructType(WIRE_EVENT.fields + [T.StructField(_CORRUPT, T.StringType())])

# What a missing field reads as.
DEFAULTS = {
    "duration": 0,
    "properties": "{}",
    "source": "simulator",
    "experiment_id": "",
    "variant": "",
}


def with_defaults(events: DataFrame) -> DataFrame:
    return events.fillna(DEFAULTS)


def parse_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """JSON messages to ``(raw, is_rejected, e)``, ``e`` holding the event's fields; batch or stream.

    Unknown fields are ignored. A message that is no JSON object is rejected instead
    of failing the job.
    """
    text = F.col(column).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = messages.select(text.alias("raw"), F.from_json(text, _DECODE_SCHEMA, options).alias("e"))
    bad = F.col("raw").isNull() | F.col(f"e.{_CORRUPT}").isNotNull()
    return parsed.select("raw", bad.alias("is_rejected"), "e")


def decode_events(messages: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON messages to ``(events, rejects)``; the rejects keep their text."""
    parsed = parse_messages(messages, column)
    good = parsed.filter(~F.col("is_rejected")).select(*[f"e.{name}" for name in WIRE_EVENT.fieldNames()])
    return with_defaults(parse_times(good)), parsed.filter("is_rejected").select("raw")


def read_event_messages(
    spark: SparkSession, options: Mapping[str, str], starting: str = "latest"
) -> DataFrame:
    """The raw message stream. ``options`` holds the servers and the topic; needs the Kafka connector.

    Messages that are gone before they were read fail the query, unless ``options`` says otherwise.
    """
    return (
        spark.readStream.format("kafka")
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .select("key", "value", "timestamp")
    )


def read_event_stream(
    spark: SparkSession, options: Mapping[str, str], starting: str = "latest"
) -> tuple[DataFrame, DataFrame]:
    """``(events, rejects)`` of the message stream; land the rejects, they are nowhere else."""
    return decode_events(read_event_messages(spark, options, starting))


def decode_jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(events, rejects)`` of JSON-lines files, decoded as messages are; empty lines are neither."""
    return decode_events(_lines(spark.read.text(path)))


def decode_jsonl_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The same folder as a stream of new files."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return decode_events(_lines(reader.text(path)))


def _lines(text: DataFrame) -> DataFrame:
    return text.filter(F.trim("value") != "")


def read_events_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Only the events of :func:`decode_jsonl`, for files whose rejects are kept elsewhere."""
    return decode_jsonl(spark, path)[0]


def stream_events_jsonl(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return decode_jsonl_stream(spark, path, max_files)[0]
