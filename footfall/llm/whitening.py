"""Whitening of embeddings: covariance of distinct vectors weighted by how often they occur."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import arrow_schema, record_batch, written

#: Entries become integers: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries this large or larger have no exact x and count as not finite.
LARGEST = float(1 << 50)
#: An eigenvalue below this share of the largest, times the dimension, is rounding: its component is not returned.
RANK_SHARE = 1e-13


def integer_vectors(rows: DataFrame) -> DataFrame:
    """id, x of the rows whose ``vector`` is whole: no null, no null, non-finite or enormous entry."""
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    x = F.transform("vector", lambda c: F.floor(c * SCALE).cast("bigint") + SHIFT)
    return rows.filter(F.col("vector").isNotNull() & finite).select("id", x.alias("x"))


def packed(vector: np.ndarray) -> bytes:
    """One spelling per vector: its width in bytes, then its entries less SHIFT in the least width that holds them."""
    low = vector - SHIFT
    least, most = (int(low.min()), int(low.max())) if len(low) else (0, 0)
    width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= least and most < 1 << 8 * w - 1)
    return bytes([width]) + low.astype(f"<i{width}").tobytes()


def unpacked(key: bytes) -> np.ndarray:
    return np.frombuffer(key, f"<i{key[0]}", offset=1).astype(np.int64) + SHIFT


def _packed_rows(vectors: DataFrame, id_type: str) -> DataFrame:
    """id, dim, key: the vectors as bytes, which group and shuffle as one value."""
    schema = f"id {id_type}, dim int, key binary"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            parts = np.split(flat, ends[:-1]) if len(ends) else []
            columns = [batch.column(0), pa.array([len(p) for p in parts], arrow.types[1]), pa.array([packed(p) for p in parts], arrow.types[2])]
            yield pa.RecordBatch.from_arrays(columns, arrow.names)

    return vectors.mapInArrow(run, schema)


@dataclass
class Whitening:
    """What a fit leaves: a few arrays whose size the dimension alone decides."""

    n: int
    sums: list[int]
    #: A column per component, divided by the root of its eigenvalue.
    projection: np.ndarray
    explained: list[float]


def weighted_sums(distinct: DataFrame, weight: Column) -> tuple[int, list[int]]:
    """The number of vectors and their exact sums per dimension; one row per dimension comes to the driver."""
    schema = "dim int, weight bigint, total decimal(38,0)"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                vectors, w = np.stack([unpacked(key.as_py()) for key in batch.column(0)]), batch.column(1).to_numpy()
                if int(np.abs(vectors).max(initial=0)) * int(w.sum()) >= 1 << 63:
                    vectors, w = vectors.astype(object), w.astype(object)  # whole numbers of any size
                part = (w @ vectors).astype(object)
                total = part if total is None else total + part
                n += int(w.sum())
        if total is not None and len(total):
            yield record_batch((range(len(total)), [n] * len(total), [int(t) for t in total]), arrow)

    parts = distinct.select("key", weight.cast("bigint")).mapInArrow(run, schema)
    rows = parts.groupBy("dim").agg(F.sum("weight").alias("n"), F.sum("total").alias("s")).orderBy("dim").collect()
    return (rows[0]["n"], [int(r["s"]) for r in rows]) if rows else (0, [])


def weighted_covariance(distinct: DataFrame, weight: Column, n: int, sums: list[int]) -> np.ndarray:
    """The covariance with divisor n. Each task multiplies its centred vectors, blocks of them at a time; the
    products' upper halves, whose number the dimension decides, are summed in Spark."""
    mean = np.array([float(s) / n for s in sums])
    dim = len(sums)
    upper = np.triu_indices(dim)
    arrow = arrow_schema("cell int, v double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                centred = np.stack([unpacked(key.as_py()) for key in batch.column(0)]) - mean
                total += (centred * batch.column(1).to_numpy()[:, None].astype(float)).T @ centred
        yield record_batch((np.arange(len(upper[0]), dtype=np.int32), total[upper]), arrow)

    parts = distinct.select("key", weight.cast("bigint")).mapInArrow(run, "cell int, v double")
    found = parts.groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    matrix = np.zeros((dim, dim))
    cells = found.column(0).to_numpy()
    matrix[upper[0][cells], upper[1][cells]] = found.column(1).to_numpy() / n
    return matrix + np.triu(matrix, 1).T


def fit_whitening(distinct: DataFrame, components: int = COMPONENTS, multiplicity: bool = True) -> Whitening | None:
    """Fits on (key, weight), each vector with its multiplicity or once. None where there is nothing to whiten."""
    weight = F.col("weight") if multiplicity else F.lit(1)
    n, sums = weighted_sums(distinct, weight)
    if not n:
        return None
    covariance = weighted_covariance(distinct, weight, n, sums)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(covariance))
    usable = int(np.sum(values[:components] > max(values[0], 0.0) * RANK_SHARE * len(sums))) if trace > 0 else 0
    chosen = values[:usable]
    return Whitening(n, sums, vectors[:, :usable] / np.sqrt(chosen), [float(v) / trace for v in chosen])


def deviations(vectors: np.ndarray, n: int, sums: list[int]) -> tuple[list[int], np.ndarray]:
    """The exact sums of (n*x - S)^2, and x - S/n without rounding n*x - S."""
    largest = max(int(np.abs(vectors).max(initial=0)) * n, *map(abs, sums))
    if largest < 1 << 62:
        apart = vectors * n - np.array(sums, dtype=np.int64)
        if int(np.abs(apart).max(initial=0)) ** 2 * len(sums) < 1 << 63:
            return np.einsum("ij,ij->i", apart, apart).tolist(), apart / n
    apart = vectors.astype(object) * n - np.array(sums, dtype=object)
    return [int(d) for d in (apart * apart).sum(axis=1)], (apart / n).astype(float)


def whitened_distinct(distinct: DataFrame, model: Whitening) -> DataFrame:
    """key, weight, deviation, whitened: each distinct vector once."""
    schema = "digest binary, weight bigint, deviation bigint, whitened array<double>"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = np.stack([unpacked(key.as_py()) for key in batch.column(1)])
                far, centred = deviations(vectors, model.n, model.sums)
                out = centred @ model.projection
                yield record_batch((batch.column(0).to_pylist(), batch.column(2).to_pylist(), far, out.tolist()), arrow)

    return distinct.select("digest", "key", "weight").mapInArrow(run, schema)


def identity_error(whitened: DataFrame, components: int, multiplicity: bool = True) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured on the vectors.

    Centred before multiplying: the means come first. One row of ``components`` squared sums comes to the driver.
    """
    w = F.col("weight").cast("double") if multiplicity else F.lit(1.0)
    c = [F.col("whitened")[i] for i in range(components)]
    total, *sums = whitened.agg(F.sum(w), *(F.sum(w * x) for x in c)).first()
    means = [s / total for s in sums]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    products = whitened.agg(*(F.sum(w * (c[i] - means[i]) * (c[j] - means[j])) for i, j in pairs)).first()
    return max(abs(v / total - (i == j)) for (i, j), v in zip(pairs, products))


def whiten(docs: DataFrame, components: int = COMPONENTS, multiplicity: bool = True, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: a row per row and component.

    Each vector's entries become whole numbers x; rows whose vector is null, or has a null or non-finite entry, fall
    out. Equal x-vectors are grouped, which merges in the map tasks, and from there on each is handled once: the fit
    weighs it by its multiplicity (or once, without ``multiplicity``), it is whitened once, and rows get theirs back by
    a join on its digest, which Spark may split where one vector has many rows. What reaches the driver, and goes out
    to the tasks with the model, has the dimension's size squared.

    Components are numbered by falling eigenvalue; those without variance are left out, so vectors that are all equal
    give no rows, and neither do empty vectors or an empty table. Where vectors differ in length the length of most
    rows counts (the longer one of equals), and the other rows fall out. Equal eigenvalues have no order of
    their own. Ids may be null or repeat: each row is a row of the fit. Other columns are ignored. A ``deviation``
    beyond 64 bits fails instead of turning over.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    result = f"id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = docs.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = written(_packed_rows(integer_vectors(rows), id_type), "whitening-rows")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not sizes or not sizes[0]["dim"]:
        return docs.sparkSession.createDataFrame([], result)
    rows = rows.filter(F.col("dim") == sizes[0]["dim"])
    distinct = rows.groupBy("key").agg(F.count("*").alias("weight")).select(F.unhex(F.sha2("key", 256)).alias("digest"), "key", "weight")
    distinct = written(distinct, "whitening-distinct")
    model = fit_whitening(distinct, components, multiplicity)
    if model is None or not model.explained:
        return docs.sparkSession.createDataFrame([], result)
    whitened = written(whitened_distinct(distinct, model), "whitening-vectors")
    error = identity_error(whitened, len(model.explained), multiplicity)
    # A merge join at every size: both sides grow with the input.
    joined = rows.select("id", F.unhex(F.sha2("key", 256)).alias("digest")).join(whitened.hint("merge"), "digest")
    explained = F.array(*map(F.lit, model.explained))
    return joined.select("id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
