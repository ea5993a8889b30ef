"""Ranked lexical search by NRA: impact-sorted lists read in order, scores known as intervals."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from footfall.llm.common import arrow_schema, record_batch, written

TOP = 50
#: Items are searched in blocks of about so many bytes of terms: what a block sends to every task is bounded by it, or
#: by its one item where that is longer.
BLOCK_BYTES = 4_000_000
#: A task indexes its documents in portions of about so many postings.
PORTION = 1_000_000
#: Postings of a list that are read at first; twice as many each time.
FIRST_READ = 64

_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """Runs of letters, digits and all that is not ASCII, in UTF-8; only A-Z is lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


# --- what the documents hold


def item_terms(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """block, item_id, n (bytes), terms (different ones) per row of items that has any; and the number of blocks."""
    id_type = items.schema[id_col].dataType.simpleString()
    schema = f"item_id {id_type}, n bigint, terms array<binary>"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = sorted(set(terms_of(text or "")))
                out += [(item, sum(map(len, found)) + 16 * len(found), found)] if found else []
            if out:
                yield record_batch(zip(*out), arrow)

    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    rows = written(rows, "search-items")
    total = rows.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_bytes)
    return rows.withColumn("block", F.pmod(F.xxhash64("item_id", "terms"), F.lit(max(1, blocks)))), blocks


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (terms with repeats), terms, tfs of the ``vocabulary``: a row per document that has a term."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, n bigint, terms array<int>, tfs array<int>"
    arrow = arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            out = []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = terms_of(text or "")
                if words:
                    counts = Counter(map(known.get, words))
                    counts.pop(None, None)
                    out.append((doc, len(words), list(counts), list(counts.values())))
            if out:
                yield record_batch(zip(*out), arrow)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def weight(df: Column, n_documents: int) -> Column:
    """floor(1000 ln((2N+2)/(2df+1))), in doubles."""
    return F.floor(1000 * F.log(F.lit(float(2 * n_documents + 2)) / (2 * df + 1).cast("double"))).cast("bigint")


def impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """What each posting adds to a score: whole numbers, rounded down twice. All values are positive."""
    m = 50 + (50 * n * n_documents) // n_terms
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


# --- one task


@dataclass
class Lists:
    """Impact-sorted lists of some documents: a term's postings are ``start[t]:start[t+1]``, highest impact first."""

    start: np.ndarray
    docs: np.ndarray
    impact: np.ndarray
    n_docs: int


def build_lists(terms: np.ndarray, docs: np.ndarray, impact: np.ndarray, n_terms: int, n_docs: int) -> Lists:
    useful = impact > 0  # what adds nothing changes no interval
    terms, docs, impact = terms[useful], docs[useful], impact[useful]
    order = np.lexsort((-impact, terms))
    start = np.searchsorted(terms[order], np.arange(n_terms + 1))
    return Lists(start, docs[order], impact[order], n_docs)


def nra(lists: Lists, terms: np.ndarray, top: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(documents, exact scores) of all documents that may be among the ``top`` highest: these, and ties with the last.

    Lists are only read from the front, in rounds. After a round a document's score lies between the sum of the
    impacts read (lower) and that sum plus, for each list in which it was not met, the list's next impact (upper).
    A document met nowhere is at most the sum of all next impacts. The bar is the ``top``-th highest lower
    bound, or ``floor`` if that is higher; what cannot reach it is given up. Reading ends when no document unmet can
    reach the bar and the intervals of all that are left have closed.
    """
    terms = terms[lists.start[terms + 1] > lists.start[terms]]
    begin, end = lists.start[terms], lists.start[terms + 1]
    at = begin.copy()
    lower = np.zeros(lists.n_docs, np.int64)
    left: np.ndarray | None = None  # the documents still in question, once none can join them
    keeps = np.zeros(lists.n_docs, bool)
    step, bar = FIRST_READ, max(floor, 1)
    while True:
        for i in range(len(terms)):
            to = min(at[i] + step, end[i])
            if to > at[i]:
                docs, gain = lists.docs[at[i] : to], lists.impact[at[i] : to]
                if left is not None:
                    wanted = keeps[docs]
                    docs, gain = docs[wanted], gain[wanted]
                lower[docs] += gain  # a list names a document once
                at[i] = to
        nexts = np.where(at < end, lists.impact[np.minimum(at, len(lists.impact) - 1)], 0) if len(terms) else np.zeros(0, np.int64)
        unmet = int(nexts.sum())
        if left is None:
            met = lower if lists.n_docs <= top else np.partition(lower, lists.n_docs - top)[lists.n_docs - top :]
            bar = max(bar, int(met.min()) if lists.n_docs > top else 0)
        else:
            bounds = lower[left]
            bar = max(bar, int(np.partition(bounds, len(bounds) - top)[len(bounds) - top]) if len(bounds) > top else 0)
        if unmet < bar or unmet == 0:
            # The next impacts of the lists that a document was met in count no more.
            met_in = np.zeros(lists.n_docs, np.int64)
            for i in range(len(terms)):
                if nexts[i]:
                    met_in[lists.docs[begin[i] : at[i]]] += nexts[i]
            left = np.flatnonzero(lower >= bar) if unmet == 0 else np.flatnonzero((lower > 0) & (lower + unmet - met_in >= bar)) if left is None else left[lower[left] + unmet - met_in[left] >= bar]
            if unmet == 0 or not len(left) or not np.any(unmet - met_in[left]):
                return left, lower[left]
            keeps[:] = False
            keeps[left] = True
        step *= 2


class Best:
    """The best of an item so far, in one task: at most ``top`` (score, document) pairs."""

    def __init__(self, top: int):
        self.top = top
        self.rows: list[tuple] = []

    def floor(self) -> int:
        return -self.rows[-1][0] if len(self.rows) == self.top else 0

    def add(self, scores: list[int], ids: list) -> None:
        # A null id comes behind the others of its score.
        self.rows += [(-score, id_ is None, 0 if id_ is None else id_) for score, id_ in zip(scores, ids)]
        self.rows.sort()
        del self.rows[self.top :]


def _searched(index: DataFrame, items: list[tuple], weights: np.ndarray, n_documents: int, n_terms: int, top: int, portion: int) -> DataFrame:
    """item (its number), doc_id, score: the best of each task for each item."""
    doc_type = index.schema["doc_id"].dataType.simpleString()
    schema = f"item int, doc_id {doc_type}, score bigint"
    arrow = arrow_schema(schema)
    shared = index.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weight_of = shared.value
        best = [Best(top) for _ in wanted]

        def search(parts: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(parts)
            ids = table.column(0).to_pylist()
            lists = table.column(2).combine_chunks()
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            terms = lists.flatten().to_numpy(zero_copy_only=False)
            tf = table.column(3).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            docs = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
            n = table.column(1).to_numpy()
            gain = impacts(weight_of[terms], tf, n[docs], n_documents, n_terms)
            index_ = build_lists(terms, docs, gain, len(weight_of), len(ids))
            for number, its_terms in enumerate(wanted):
                found, scores = nra(index_, its_terms, top, best[number].floor())
                best[number].add(scores.tolist(), [ids[i] for i in found])

        parts, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                parts.append(part)
                size += len(part.column(2).flatten())
                if size >= portion:
                    search(parts)
                    parts, size = [], 0
        if parts:
            search(parts)
        rows = [(number, None if null else id_, -score) for number, b in enumerate(best) for score, null, id_ in b.rows]
        if rows:
            yield record_batch(zip(*rows), arrow)

    return index.mapInArrow(run, schema)


# --- all together


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    portion: int = PORTION,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` documents of the highest scores above 0.

    1. Items are dealt into blocks of bounded size; the work below is done for each block.
    2. One pass over the texts keeps, per document, its length and its counts of the block's terms. Frequencies of terms
       and the length of all documents are sums over it.
    3. Documents stay where they are: each task sorts the postings of its documents by term and impact, a portion at
       a time, and answers all items of the block from these lists by NRA (:func:`nra`). Later portions start from the
       bar that earlier ones set.
    4. The best of all tasks meet, at most ``top`` per task and item, and the best of these are the result: scores are
       exact, so nothing is lost by the parts.

    Equal scores go by ascending id; a null id comes last. Rows that repeat an id are documents, or items, of their own:
    each item row has its ranks, and two documents of one id may both be ranked. Null texts, and texts without
    a term, are neither found nor counted, and items without one find nothing. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows, blocks = item_terms(items, item_col, item_text_col, block_bytes)
    item_type, doc_type = items.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    found = [_search_block(docs, rows.filter(F.col("block") == b), top, id_col, text_col, portion, item_type) for b in range(blocks)]
    found = [f for f in found if f is not None]
    if not found:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {doc_type}, score bigint")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _search_block(docs: DataFrame, rows: DataFrame, top: int, id_col: str, text_col: str, portion: int, item_type: str) -> DataFrame | None:
    spark = docs.sparkSession
    wanted = rows.select("item_id", "terms").collect()  # bounded: a block
    if not wanted:
        return None
    numbers = {term: i for i, term in enumerate(sorted({bytes(t) for row in wanted for t in row["terms"]}))}
    index = written(postings(docs, numbers, id_col, text_col), "search-postings")
    n_documents, n_terms = index.agg(F.count("*"), F.sum("n")).first()
    if not n_documents:
        return None
    counted = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    # A row per term of the block.
    listed = counted.select("term", weight(F.col("df"), n_documents).alias("w")).collect()
    weights = np.zeros(len(numbers), np.int64)
    for row in listed:
        weights[row["term"]] = row["w"]
    items = [np.array([numbers[bytes(t)] for t in row["terms"]], dtype=np.int64) for row in wanted]
    best = _searched(index, items, weights, n_documents, n_terms, top, portion)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(wanted)], f"item int, item_id {item_type}")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
