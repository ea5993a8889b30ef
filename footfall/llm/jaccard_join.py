"""N-gram Jaccard join: a blocked sparse product of documents by n-grams, and the classes of its links."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import cache
from hashlib import md5

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.llm.common import arrow_schema, map_columns, record_batch, text_of, written
from footfall.llm.components import connected_components

#: Rows and n-grams of a block of the product: what two blocks hold fits in a task.
BLOCK_ROWS = 256
BLOCK_GRAMS = 1_000_000
#: Columns of a block that so many rows have are multiplied as dense ones.
DENSE_ROWS = 16
#: How often a set is dealt out anew that leaves too many parts empty, before empty parts count as equal.
SEEDS = 8
#: Dealings that a key's label tells apart; one more class of size would be beyond any text.
SCHEMES = 1024

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_S30, _S27, _S31, _S14 = (np.uint64(x) for x in (30, 27, 31, 14))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S30)) * _M2
    x = (x ^ (x >> _S27)) * _M3
    return x ^ (x >> _S31)


class Shingler:
    """Sets of word n-grams as sorted 64-bit hashes; remembers the hashes of words."""

    def __init__(self, n: int, memory: int = 500_000):
        self.n, self.memory, self.known = n, memory, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z and ASCII white space only
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > self.memory:
            self.known = {}
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.n, len(words))
        grams = np.full(len(hashes) - width + 1, width, np.uint64)
        for k in range(width):
            grams = _mixed(grams * _M1 + hashes[k : len(hashes) - width + 1 + k])
        return np.unique(grams)


class SizeClasses:
    """Which parts of two sets can differ, by their sizes alone.

    Sets link when their intersection is at least ``threshold`` of their union. Then the smaller one
    has at least that share of the larger one's size, and at most ``(1 - t) / (1 + t)`` of the sum
    of the sizes lies outside the intersection. Class c holds the sizes from ``bounds[c]`` on, so
    that partners are at most one class apart.
    """

    def __init__(self, threshold: Fraction):
        self.t = threshold
        self.bounds = [1]
        while self.bounds[-1] < 1 << 40:
            self.bounds.append(max(self.bounds[-1] + 1, -(-self.bounds[-1] * self.t.denominator // self.t.numerator)))
        self.array = np.array(self.bounds)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.array, size, side="right")) - 1

    @cache
    def parts(self, c: int) -> tuple[int, int, int]:
        """Of the dealing for sets of class c and larger partners: how many parts, how many of them may
        be empty, and in how many full ones sets that link agree at least.

        The parts are as many as such sets can differ in, plus the two other numbers. What may be
        empty is what chance rarely exceeds. Asking for more than one part in common costs a few
        parts and spares most sets that agree in one by chance. Where there are no such numbers,
        it is one part and no empty one.
        """
        most = self.bounds[c + 1] - 1
        both = most + most * self.t.denominator // self.t.numerator
        differ = int(both * (1 - self.t) / (1 + self.t))
        common = max(1, differ // 10)
        k = differ + common
        while differ and k <= 2 * (differ + 1):
            mean = k * math.exp(-self.bounds[c] / k)
            empty = math.ceil(mean + 4 * math.sqrt(mean))
            if differ + common + empty <= k:
                return k, k - differ - common, common
            k = differ + common + empty
        return differ + 1, 0, 1

    def links(self, overlap, a, b):
        """Overlap needed by sizes, in whole numbers."""
        p, q = self.t.numerator, self.t.denominator
        return q * overlap >= p * (a + b - overlap)


def part_keys(grams: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """The keys by which a set meets all sets that it may link with.

    The columns of the product are dealt into more parts than linked sets can differ in, so they
    agree in whole parts. A set takes part in the dealing of its own class, with partners of its
    class or the next, and in that of the class before. Agreeing in an empty part says nothing; as
    long as one of two sets has no more of these than the dealing allows, they agree in a full one
    too. Sets with more are dealt out once more.
    """
    c, keys = classes.of(len(grams)), []
    for scheme in (c, c - 1):
        k, allowed, _ = classes.parts(scheme) if scheme >= 0 else (1, 0, 1)
        if k == 1:
            continue  # only equal sets link, and they are one row
        edges = np.array([(j << 64) // k for j in range(1, k)], np.uint64)
        dealt = grams
        for seed in range(SEEDS):
            if seed:
                dealt = np.sort(_mixed(grams + np.uint64(seed * int(_M1) % 2**64)))
            cuts = np.concatenate(([0], np.searchsorted(dealt, edges), [len(dealt)]))
            full = np.flatnonzero(cuts[1:] > cuts[:-1])
            sums = np.add.reduceat(_mixed(dealt * _M1 + _M3), cuts[full])
            place = np.uint64(scheme << 40 | seed << 34) + full.astype(np.uint64)
            keys.append(_labelled(_mixed(_mixed(sums) + place * _M1), scheme, seed))
            if k - len(full) <= allowed:
                break
            if seed == SEEDS - 1:
                empty = np.setdiff1d(np.arange(k), full).astype(np.uint64)
                keys.append(_labelled(_mixed((np.uint64(scheme << 40 | SEEDS << 34) + empty) * _M1), scheme, seed))
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def _labelled(hashes: np.ndarray, scheme: int, seed: int) -> np.ndarray:
    """The lowest bits of a key tell its dealing."""
    return (hashes >> _S14 << _S14) | np.uint64(scheme % SCHEMES << 4 | seed)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, grams as bytes."""

    def start():
        shingler = Shingler(n)
        return lambda ids, texts: (ids, [shingler(text or "").tobytes() for text in texts])

    return map_columns(docs, "doc_id bigint, grams binary", start)


def _profiles(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null if empty)."""

    def start():
        shingler = Shingler(n)

        def step(ids, texts):
            sets = [shingler(text or "") for text in texts]
            return ids, [len(s) for s in sets], [md5(s.tobytes()).digest() if len(s) else None for s in sets]

        return step

    return map_columns(docs, "doc_id bigint, n_shingles bigint, digest binary", start)


def _keys(docs: DataFrame, n: int, classes: SizeClasses) -> DataFrame:
    """doc_id, key. Of equal sets in a batch the smallest id stands for all: copies merge before the shuffle."""
    arrow = arrow_schema("doc_id bigint, key bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            first: dict[bytes, int] = {}
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                grams = shingler(text).tobytes()
                if grams:
                    first[grams] = min(doc_id, first.get(grams, doc_id))
            rows = list(first.items())
            for at in range(0, len(rows), 1000):
                keys = [part_keys(np.frombuffer(grams, np.uint64), classes) for grams, _ in rows[at : at + 1000]]
                ids = np.repeat([doc_id for _, doc_id in rows[at : at + 1000]], [len(k) for k in keys])
                yield record_batch((ids.astype(np.int64), np.concatenate(keys).view(np.int64)), arrow)

    return docs.filter("doc_id is not null").mapInArrow(run, "doc_id bigint, key bigint")


def jaccard_join(
    docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id: links between sets of n-grams, and the smallest id they lead to.

    1. Equal sets become one row of the incidence matrix, named by its smallest id.
    2. The columns are dealt into parts by sizes alone (see :func:`part_keys`). Rows that agree in as
       many parts as their sizes demand may link; all others are discarded unseen.
    3. All rows of a part go to the cell of its hub, the row that meets most others. Cells are cut
       into blocks of bounded size, and each pair of blocks is one product: it accumulates overlap
       counts, discards pairs below the bound of their sizes, and gives links that span the rest. A
       pair leaves the task only if it links two rows that were not linked before.
    4. The links' components are found by joins.

    Texts are lower-cased in A-Z; fewer than ``n`` words are one n-gram; a null or empty text has
    none and links with nothing. Rows that share an id are one document. A row without an id gets no
    component. Other columns are ignored; an empty table gives no rows.
    """
    classes = SizeClasses(Fraction(percent, 100))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    profiles = written(_profiles(texts, n), "jaccard-profiles")
    linked = profiles.filter("doc_id is not null and digest is not null")
    rows = written(linked.groupBy("digest").agg(F.min("doc_id").alias("row_id")), "jaccard-rows")

    keys = _keys(texts, n, classes)
    met = keys.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1").select("doc_id", "key")
    # Equal sets have equal keys, so their smallest id is among those that met.
    met = written(met.join(rows.select(F.col("row_id").alias("doc_id")), "doc_id", "left_semi"), "jaccard-parts")
    for _ in range(2):
        met = written(_enough_in_common(met, classes), "jaccard-rows-met")
    cells = written(_cells(met), "jaccard-cells")
    links = written(_products(cells, texts, n, classes), "jaccard-links")
    labels = connected_components(links).select(F.col("node").alias("row_id"), "component")

    classes_of = written(rows.join(labels, "row_id", "left").select("digest", F.coalesce("component", "row_id").alias("component")), "jaccard-classes")
    found = profiles.select("doc_id", "n_shingles", "digest").join(classes_of, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"))


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with all their columns.

    Rows without an id are linked with none and stay.
    """
    found = jaccard_join(docs, n, percent)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def _enough_in_common(met: DataFrame, classes: SizeClasses) -> DataFrame:
    """doc_id, key, n: of parts that ``n`` rows agree in, those of rows with enough such parts in a dealing."""
    least = [(scheme % SCHEMES, classes.parts(scheme)[2]) for scheme in range(min(SCHEMES, len(classes.bounds) - 1))]
    least = F.create_map(*[F.lit(x) for pair in least for x in pair])
    shared = met.select("doc_id", "key", F.count("*").over(Window.partitionBy("key")).alias("n")).filter("n > 1")
    label = F.col("key").bitwiseAND(SCHEMES * 16 - 1)
    counted = shared.withColumn("parts", F.count("*").over(Window.partitionBy("doc_id", label)))
    needed = F.try_element_at(least, F.shiftright(label, 4).cast("int"))
    return counted.filter(F.col("parts") >= needed).drop("parts")


def _cells(met: DataFrame) -> DataFrame:
    """cell, doc_id: each part's rows in the cell of the part's hub."""
    score = written(met.groupBy("doc_id").agg(F.sum("n").alias("score")), "jaccard-scores")
    scored = met.join(score, "doc_id")
    hubs = written(scored.groupBy("key").agg(F.max(F.struct("score", (-F.col("doc_id")).alias("minus"))).alias("hub")), "jaccard-hubs")
    placed = met.join(hubs, "key").select((-F.col("hub.minus")).alias("cell"), "doc_id")
    return placed.distinct()


def _products(cells: DataFrame, texts: DataFrame, n: int, classes: SizeClasses) -> DataFrame:
    """a, b: links that span the linked rows of each pair of blocks."""
    used = written(cells.select("doc_id").distinct(), "jaccard-used")
    sets = written(_sets(texts.join(used, "doc_id", "left_semi"), n), "jaccard-sets")
    grams = sets.select("doc_id", F.expr("octet_length(grams) div 8").alias("n"))
    size = cells.join(grams, "doc_id").groupBy("cell").agg(F.count("*").alias("rows"), F.sum("n").alias("grams"))
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("grams") / BLOCK_GRAMS)).cast("int")
    size = written(size.select("cell", blocks.alias("blocks")), "jaccard-sizes")
    mine = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = cells.join(size, "cell").select("cell", "doc_id", mine.alias("mine"), other.alias("other"))
    dealt = dealt.select("cell", "doc_id", "mine", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
    dealt = written(dealt, "jaccard-blocks")
    full = dealt.join(sets, "doc_id").select("cell", "low", "high", "mine", "doc_id", "grams")
    spread = full.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
    arrow = arrow_schema("a bigint, b bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, mine, grams = None, [], [], []
        for batch in batches:
            for cell, low, high, side, doc_id, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (cell, low, high) != key:
                    if len(ids) > 1:
                        yield record_batch(product_links(ids, mine, grams, classes), arrow)
                    key, ids, mine, grams = (cell, low, high), [], [], []
                ids.append(doc_id)
                mine.append(side)
                grams.append(np.frombuffer(raw, np.uint64))
        if len(ids) > 1:
            yield record_batch(product_links(ids, mine, grams, classes), arrow)

    return spread.mapInArrow(run, "a bigint, b bigint")


def product_links(ids: list[int], side: list[int], grams: list[np.ndarray], classes: SizeClasses) -> tuple[list, list]:
    """Links between rows of two blocks (or within the one block), as far as they connect anew."""
    overlap = overlaps(grams)
    size = np.fromiter(map(len, grams), np.int64, len(grams))
    linked = classes.links(overlap, size[:, None], size[None, :])
    linked &= overlap > 0
    if len(set(side)) > 1:
        block = np.array(side)
        linked &= block[:, None] != block[None, :]
    low, high = np.nonzero(np.triu(linked, 1))
    parent = list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    left, right = [], []
    for i, j in zip(low.tolist(), high.tolist()):
        a, b = root(i), root(j)
        if a != b:
            parent[b] = a
            left.append(ids[i])
            right.append(ids[j])
    return left, right


def overlaps(grams: list[np.ndarray]) -> np.ndarray:
    """Common n-grams of each pair of rows i < j, accumulated column by column.

    Columns of one row add nothing. Those of many rows are multiplied as dense blocks, those of few
    rows add one to each of their pairs.
    """
    rows = len(grams)
    column, row = np.concatenate(grams), np.repeat(np.arange(rows), [len(g) for g in grams])
    by = np.argsort(column, kind="stable")
    column, row = column[by], row[by]
    first = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1])))
    count = np.diff(np.append(first, len(column)))
    total = np.zeros((rows, rows), np.int64)
    dense = np.flatnonzero(count >= DENSE_ROWS)
    for at in range(0, len(dense), 4096):
        some = dense[at : at + 4096]
        matrix = np.zeros((rows, len(some)), np.float32)
        where = np.concatenate([np.arange(first[c], first[c] + count[c]) for c in some])
        matrix[row[where], np.repeat(np.arange(len(some)), count[some])] = 1
        total += (matrix @ matrix.T).astype(np.int64)
    flat = total.reshape(-1)
    for width in np.unique(count[(count > 1) & (count < DENSE_ROWS)]).tolist():
        starts = first[count == width]
        for at in range(0, len(starts), 100_000):
            block = row[starts[at : at + 100_000, None] + np.arange(width)]
            for i in range(width):
                for j in range(i + 1, width):
                    np.add.at(flat, block[:, i] * rows + block[:, j], 1)
    return total
