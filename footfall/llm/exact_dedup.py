"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import WHITE, text_of, written


def normalised(text: str) -> Column:
    """Each run of white space as one space; nothing else is changed."""
    return F.regexp_replace(text_of(text), WHITE, " ")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash: Callable[[Column], Column] = F.md5
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The text is shuffled once, and copies already meet in the map tasks: the grouping key is the
    hash *and* the text, so that equal keys are equal bytes and a collision makes two classes. Of a
    class only its hash, id, size and digest go on. Rows find their class by the hash. Where two
    classes share a hash (never met with md5, tested with weaker hashes), the rows of that hash
    find theirs by hash and text.

    A null text counts as empty. Rows that repeat an id and a text are one document: all of them
    carry the same flag. A null id is larger than any other; in a class of null ids only, all are
    kept. Other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("norm"))
    rows = rows.select("doc_id", content_hash(F.col("norm")).alias("digest"), "norm")
    classes = written(_classes(rows).drop("norm"), "exact-classes")
    shared = classes.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    if shared.isEmpty():
        found = rows.drop("norm").join(classes, "digest")
    else:
        shared = written(shared, "exact-collisions")
        clear = rows.drop("norm").join(shared, "digest", "left_anti").join(classes, "digest")
        mixed = rows.join(shared, "digest", "left_semi")
        found = clear.unionByName(mixed.join(_classes(mixed), ["digest", "norm"]).drop("norm"))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _classes(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("digest", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .withColumn("text_sha256", F.sha2("norm", 256))
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text no row with a smaller id has, with all their columns.

    Rows that repeat id and text become one. Rows of different texts may share an id: the digest is
    part of the join.
    """
    rows = docs.select("doc_id", normalised("text").alias("norm")).select("doc_id", F.md5("norm").alias("digest"), "norm")
    # A class's smallest id and its digest name the rows that stay: no row has to look for its class first.
    keep = written(_classes(rows).select(F.col("keep_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha")), "exact-kept")
    same = docs["doc_id"].eqNullSafe(keep["kept_id"]) & (F.sha2(normalised("text"), 256) == keep["kept_sha"])
    matched = docs.join(keep, same, "left_semi")
    # Only where ids repeat is the text shuffled once more.
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    return matched if repeated.isEmpty() else matched.dropDuplicates(["doc_id", "text"])
