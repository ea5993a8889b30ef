"""Removal of repeated byte strings by suffix arrays of the stretches that may hold them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import arrow_schema, map_columns, record_batch, text_of, written
from footfall.llm.suffix_array import permuted_common_prefixes, suffix_array

#: Bytes of text that one suffix array is made for, about.
SHARD_BYTES = 700_000
#: Bytes of text under one anchor that still go into one suffix array, which takes some eighty times
#: as much memory; beyond that an anchor's strings are counted one by one.
ANCHOR_BYTES = 4_000_000
#: Starts that a document's anchors are sought for at a time.
CHUNK = 1_000_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S30, _S29, _S32 = np.uint64(30), np.uint64(29), np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S30)) * _M2
    return x ^ (x >> _S29)


def gram_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all strings of ``width`` bytes (a power of two), by doubling."""
    hashes, w = _mixed((raw.astype(np.uint64) + np.uint64(1)) * _M1), 1
    while w < width:
        hashes = _mixed(hashes[:-w] * _M1 + hashes[w:])
        w *= 2
    return hashes


def stretches(raw: bytes, length: int, chunk: int = CHUNK) -> Iterator[tuple[list[int], list[int], list[int], list[int]]]:
    """Cuts the starts of strings of ``length`` bytes into runs that share an anchor, a part of the text at a time.

    The anchor of a string is the gram inside it with the smallest hash, the leftmost of equals; so
    equal strings have equal anchors, wherever they stand. Yields each run's first start, its last
    start, the hash of its anchor, and an end, which is 0 but for periodic text.

    Where bytes repeat with a short period the anchor would move with every period. There the run holds one start per
    place in the period, which are all different strings that the periodic text has, and the end says how far this goes on:
    all bytes from the first start to the end are covered by strings that occur again.
    """
    width = 1 << ((length * 2 // 5).bit_length() - 1)
    for at in range(0, len(raw) - length + 1, chunk):
        part = np.frombuffer(raw, np.uint8)[at : at + chunk + length - 1]
        hashes = gram_hashes(part, width)
        least = (hashes >> _S32 << _S32) | np.arange(len(hashes), dtype=np.uint64)
        window, w = length - width + 1, 1
        while 2 * w <= window:
            least = np.minimum(least[:-w], least[w:])
            w *= 2
        if w < window:
            least = np.minimum(least[: len(least) - (window - w)], least[window - w :])
        begin = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.append(begin[1:], len(least)) - 1
        place = (least[begin] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        anchors = hashes[place].view(np.int64)
        end = np.zeros(len(begin), np.int64)
        gone = np.zeros(len(begin), bool)
        for i, j, period in periodic_runs(place, anchors):
            first, stop = int(begin[i]), int(last[j]) + length
            if last[j] - first + 1 >= 2 * period and (part[first : stop - period] == part[first + period : stop]).all():
                end[i], last[i] = stop + at, first + period - 1
                gone[i + 1 : j + 1] = True
        stay = ~gone
        yield (begin[stay] + at).tolist(), (last[stay] + at).tolist(), anchors[stay].tolist(), end[stay].tolist()


def periodic_runs(place: np.ndarray, anchors: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, last, distance) of at least three anchors in a row of one hash and one distance."""
    step = np.diff(place)
    same = (anchors[1:] == anchors[:-1])
    joined = same[1:] & same[:-1] & (step[1:] == step[:-1])
    edges = np.flatnonzero(np.diff(np.concatenate(([False], joined, [False])).astype(np.int8)))
    taken = -1
    for first, stop in edges.reshape(-1, 2).tolist():
        if first > taken:
            taken = stop + 1
            yield first, stop + 1, int(step[first])


_STRETCH = "row_id binary, at bigint, size bigint, anchor bigint, content bigint, until bigint"


def _found_stretches(docs: DataFrame, length: int) -> DataFrame:
    """row_id, at, size (bytes), anchor, content (hashes), until (of periodic text, else 0): a row per stretch."""
    arrow = arrow_schema(_STRETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for row_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode("utf-8", "surrogatepass")
                for first, last, anchors, ends in stretches(raw, length):
                    sizes = [b - a + length for a, b in zip(first, last)]
                    out[0] += [row_id] * len(first)
                    out[1] += first
                    out[2] += sizes
                    out[3] += anchors
                    out[4] += [xxhash.xxh3_64_intdigest(raw[a : a + n]) - (1 << 63) for a, n in zip(first, sizes)]
                    out[5] += ends
                    if len(out[0]) > 50_000:
                        yield record_batch(out, arrow)
                        out = [[], [], [], [], [], []]
            yield record_batch(out, arrow)

    return docs.mapInArrow(run, _STRETCH)


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """row_id, start, end: bytes of the texts (row_id, text) covered by strings that start elsewhere too.

    1. All starts of strings are cut into stretches by content alone, so that equal strings lie in
       stretches of equal anchors. Periodic text is repeated as it stands; one period of its starts stands for it.
    2. Stretches that are equal as a whole are repeated from end to end. They are counted by hash,
       merged in the map tasks, and need no bytes: this takes most copies.
    3. A stretch that is the only one of its content, with an anchor that others have, may repeat in
       part. These, with one stretch of each repeated content beside them, are dealt into shards by
       anchor. A shard's suffix array has equal strings side by side.
    4. An anchor whose stretches would not fit a task has its strings counted as such, by a digest
       that merges in the map tasks.
    """
    found = written(_found_stretches(docs, length), "stretches")
    place = F.struct("row_id", "at", "size")
    times = F.sum(F.when(F.col("until") > 0, 2).otherwise(1))  # periodic text repeats what its stretch holds
    content = found.groupBy("anchor", "content").agg(times.alias("n"), F.min(place).alias("place"))
    content = written(content, "stretch-contents")
    anchors = content.groupBy("anchor").agg(F.count("*").alias("contents"), F.sum((F.col("n") == 1).cast("int")).alias("single"), F.sum("place.size").alias("bytes"))
    anchors = written(anchors.filter("contents > 1 and single > 0"), "stretch-anchors")

    repeated = written(content.filter("n > 1").select("anchor", "content"), "stretch-repeated")
    reach = F.greatest(F.col("at") + F.col("size"), F.col("until"))
    whole = found.join(repeated, ["anchor", "content"]).select("row_id", F.col("at").alias("start"), reach.alias("end"))

    open_ = content.join(anchors.select("anchor", "bytes"), "anchor").select(
        F.col("place.row_id").alias("row_id"), F.struct(F.col("place.at").alias("at"), F.col("place.size").alias("size"), "anchor", (F.col("n") > 1).alias("known"), (F.col("bytes") > ANCHOR_BYTES).alias("hot")).alias("s")
    )
    needed = written(open_.groupBy("row_id").agg(F.collect_list("s").alias("wanted")), "stretch-wanted")
    bytes_ = written(_cut(docs.join(needed, "row_id")), "stretch-bytes")
    return whole.unionByName(_by_suffix_arrays(bytes_.filter("not hot"), length)).unionByName(_by_strings(bytes_.filter("hot"), length))


def _cut(wanted: DataFrame) -> DataFrame:
    """row_id, at, anchor, known, hot, raw: the bytes of the wanted stretches."""
    schema = "row_id binary, at bigint, anchor bigint, known boolean, hot boolean, raw binary"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row_id, text, stretches_ in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode("utf-8", "surrogatepass")
                for s in stretches_:
                    rows.append((row_id, s["at"], s["anchor"], s["known"], s["hot"], raw[s["at"] : s["at"] + s["size"]]))
                    if len(rows) > 50_000:
                        yield record_batch(zip(*rows), arrow)
                        rows = []
            if rows:
                yield record_batch(zip(*rows), arrow)

    return wanted.select("row_id", "text", "wanted").mapInArrow(run, schema)


def _by_suffix_arrays(stretches_: DataFrame, length: int) -> DataFrame:
    """row_id, start, end of what repeats in the stretches that are not known to."""
    total = stretches_.agg(F.coalesce(F.sum(F.octet_length("raw")), F.lit(0))).first()[0]
    shards = max(1, total // SHARD_BYTES)
    dealt = stretches_.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    dealt = dealt.select("shard", "row_id", "at", "known", "raw").repartition("shard").sortWithinPartitions("shard")
    arrow = arrow_schema("row_id binary, start bigint, end bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            for shard, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != current and rows:
                    yield record_batch(shard_repeats(rows, length), arrow)
                    rows = []
                current = shard
                rows.append(row)
        if rows:
            yield record_batch(shard_repeats(rows, length), arrow)

    return dealt.mapInArrow(run, "row_id binary, start bigint, end bigint")


def shard_repeats(rows: list, length: int) -> tuple[list, list, list]:
    """Of (row_id, at, known, bytes): the spans covered by strings of ``length`` that another row or
    place has. Each start stands in one row only, so any equal neighbour is another place."""
    raws = [row[3] for row in rows]
    text = np.zeros(sum(map(len, raws)) + len(raws), dtype=np.int64)
    sizes = np.array([len(raw) for raw in raws])
    offset = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    for at, raw in zip(offset.tolist(), raws):
        text[at : at + len(raw)] = np.frombuffer(raw, np.uint8)
        text[at : at + len(raw)] += 1  # 0 ends each stretch
    order = suffix_array(text)
    shared = permuted_common_prefixes(text, order, 0)
    repeats = shared >= length
    before = np.zeros(len(text), dtype=bool)
    before[order[:-1]] = repeats[order[1:]]
    repeats |= before
    owner = np.repeat(np.arange(len(rows)), sizes + 1)
    hits = np.flatnonzero(repeats)
    hits = hits[~np.array([row[2] for row in rows])[owner[hits]]]
    if not len(hits):
        return [], [], []
    own = owner[hits]
    fresh = np.concatenate(([True], (hits[1:] - hits[:-1] > length) | (own[1:] != own[:-1])))
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(hits)) - 1
    own = own[first]
    shift = np.array([row[1] for row in rows])[own] - offset[own]
    return [rows[i][0] for i in own], (hits[first] + shift).tolist(), (hits[last] + length + shift).tolist()


def _by_strings(stretches_: DataFrame, length: int) -> DataFrame:
    """The same for the stretches of hot anchors: all their strings by digest."""
    schema = "row_id binary, start bigint, known boolean, string binary"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row_id, at, known, raw in zip(*(c.to_pylist() for c in batch.columns)):
                for first in range(0, len(raw) - length + 1, 50_000):
                    n = min(50_000, len(raw) - length + 1 - first)
                    digests = [xxhash.xxh3_128_digest(raw[i : i + length]) for i in range(first, first + n)]
                    yield record_batch(([row_id] * n, range(at + first, at + first + n), [known] * n, digests), arrow)

    strings = stretches_.select("row_id", "at", "known", "raw").mapInArrow(run, schema)
    repeated = strings.groupBy("string").agg(F.count("*").alias("n")).filter("n > 1").select("string")
    repeated = written(repeated, "stretch-strings")
    hits = strings.filter("not known").join(repeated, "string")
    return hits.select("row_id", "start", (F.col("start") + length).alias("end"))


def suffix_array_dedup(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (start, end of the removed runs), kept (the other bytes).

    Removes each UTF-8 byte covered by a string of ``length`` bytes that starts anywhere else too,
    in the same text or another, as the texts came in. Texts under ``length`` bytes stay; a null text
    is empty. A text may be as long as a row holds; one that repeats itself with a short period costs no more than
    another. Rows that repeat id and text repeat each other, whatever their number. Ids may be
    null; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), F.col("text"))
    rows = rows.select(F.unhex(F.md5(named)).alias("row_id"), "doc_id", "text")
    spans = repeated_spans(rows.select("row_id", "text"), length)
    removed = spans.groupBy("row_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.join(removed, "row_id", "left").select("doc_id", "text", "spans")

    def start():
        def step(ids, texts, all_spans):
            sizes, merged, kept = [], [], []
            for text, spans_ in zip(texts, all_spans):
                raw = text.encode("utf-8", "surrogatepass")
                runs = merged_runs(spans_ or [])
                at, parts = 0, []
                for run in runs:
                    parts.append(raw[at : run["start"]])
                    at = run["end"]
                sizes.append(len(raw))
                merged.append(runs)
                kept.append(b"".join([*parts, raw[at:]]))
            return ids, sizes, merged, kept

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(joined, f"doc_id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary", start)


def merged_runs(spans: list[dict]) -> list[dict]:
    """Maximal runs: spans that overlap or touch become one."""
    runs: list[dict] = []
    for span in sorted(spans, key=lambda s: s["start"]):
        if runs and span["start"] <= runs[-1]["end"]:
            runs[-1]["end"] = max(runs[-1]["end"], span["end"])
        else:
            runs.append(dict(span))
    return runs
