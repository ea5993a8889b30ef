"""Small helpers that the text operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from footfall.session import scratch_dir

#: A run of white space, as the contracts of all operators define it.
WHITE = r"[\x20\x09-\x0D]+"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary_file(vocabulary: str) -> str:
    """Where a vocabulary lies on this machine: a path as it is, a bare name among the installed public ones.

    Called in the tasks, so that each executor finds its own copy.
    """
    return vocabulary if os.path.dirname(vocabulary) else public_tokenizers.path(vocabulary)


def text_of(column: str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table to the shared scratch folder and reads it back.

    Cuts the lineage: a lost executor costs no recomputation of what came before.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows in a batch of texts that goes to Python: some thousand characters each, and several batches lie in memory at once.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows for this session."""
    if int(spark.conf.get(_BATCH_CONF)) > BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def map_columns(df: DataFrame, schema: str, start: Callable[[], Callable]) -> DataFrame:
    """Maps Arrow batches as Python lists, a list per column.

    ``start`` runs once in each task and returns the function that gets the lists of a batch and
    returns the lists of the result. Unlike with pandas, a null leaves integers what they are.
    """
    arrow = to_arrow_schema(_struct(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            lists = step(*(column.to_pylist() for column in batch.columns))
            yield record_batch(lists, arrow)

    return df.mapInArrow(run, schema)


def record_batch(lists, arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(lists, arrow.types, strict=True)], arrow.names)


def arrow_schema(schema: str) -> pa.Schema:
    return to_arrow_schema(_struct(schema))


def _struct(schema: str) -> StructType:
    return _parse_datatype_string(schema)
