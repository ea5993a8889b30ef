"""A corpus from raw documents to packed sequences, a stage at a time.

Every stage but the last returns the columns of ``documents``. A null text counts as empty, and so
leaves with the first stage; rows without a label are judged like any other; extra columns pass
through; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm.common import read_documents, written
from footfall.llm.exact_dedup import drop_exact_copies
from footfall.llm.jaccard_join import drop_near_copies
from footfall.llm.kneser_ney import QualityClassifier
from footfall.llm.packing import pack_documents
from footfall.llm.pii import redact_documents

VOCABULARY = "word_bpe_49k.json"
NEAR_WORDS, NEAR_PERCENT = 5, 80

#: No SQL: the stages fit a language model, merge word pieces and pack by differencing.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents far less likely than trusted ones of their language go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return QualityClassifier(docs, labels).keep(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similar word n-grams connect, the smallest id stays."""
    return drop_near_copies(docs, NEAR_WORDS, NEAR_PERCENT)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in them becomes a mark of its kind."""
    return redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack_documents(docs, VOCABULARY)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("private", private), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
