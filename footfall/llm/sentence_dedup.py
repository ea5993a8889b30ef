"""Substring dedup: runs of consecutive sentences that stood somewhere before."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import arrow_schema, map_columns, record_batch, text_of, written

#: Sentences in a run.
RUN = 3
#: A run of fewer words says too little.
MIN_WORDS = 10
#: A longer sentence counts as several.
MAX_WORDS = 16
#: Short sentences in a row, whose runs would have too few words, are joined and cut into so many words at most.
MAX_JOINED = 8
#: A cut stands behind a word whose hash is the least of so many words to each side.
REACH = 3

#: Letters of scripts that set no spaces between words: each counts as a word.
_WIDE = "\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U000323af"
#: Marks that end a sentence, and line ends.
_ENDS = ".!?\n\u2028\u2029\u037e\u0589\u061f\u06d4\u0964\u0965\u104a\u104b\u1362\u1367\u17d4\u17d5\u203c\u203d\u2047-\u2049\u2026\u3002\ufe52\ufe56\ufe57\uff01\uff0e\uff1f\uff61"
_SENTENCE = re.compile(rf"[^{_ENDS}]*[{_ENDS}]*\s*")
_WORD = re.compile(rf"[{_WIDE}]\s*|[^\s{_WIDE}]+\s*")
_HAS_WIDE = re.compile(rf"[{_WIDE}]")


def n_words(text: str) -> int:
    return len(text.split()) if text.isascii() or not _HAS_WIDE.search(text) else len(_WORD.findall(text))


def content_cuts(text: str, limit: int) -> list[str]:
    """The text in pieces of at most ``limit`` words, cut where the words around say so.

    A passage is so cut at the same words whatever stands before it, from its first such word on: only cuts at
    the limit count from the cut before. Words that repeat with a period are cut at multiples of it; pieces have
    more words than REACH, but for the last.
    """
    words = _WORD.findall(text)
    hashes = [xxhash.xxh32_intdigest(word.rstrip().lower().encode("utf-8", "surrogatepass")) for word in words]
    if words:
        words[0] = text[: len(text) - sum(map(len, words))] + words[0]  # white space before
    found, first = [], 0
    for k in range(len(words) - 1):
        own, length = hashes[k], k + 1 - first
        least = length > REACH and own < hashes[k + 1] and own == min(hashes[max(0, k - REACH) : k + REACH + 1])
        if least or length == limit:
            found.append("".join(words[first : k + 1]))
            first = k + 1
    return [*found, "".join(words[first:]) if words else text]


def sentences(text: str, max_words: int = MAX_WORDS, run: int = RUN, min_words: int = MIN_WORDS) -> list[str]:
    """The text in order and complete: sentences end with marks or a line, with the white space behind.

    Longer ones are cut by content. Neighbours that stand in no run of enough words are joined, and cut by
    content too, so that their runs have as many.
    """
    pieces, sizes = [], []
    for sentence in _SENTENCE.findall(text):
        if sentence:
            size = n_words(sentence)
            cut = [sentence] if size <= max_words else content_cuts(sentence, max_words)
            pieces += cut
            sizes += [size] if size <= max_words else map(n_words, cut)
    covered = bytearray(len(sizes))
    for i in range(len(sizes) - run + 1):
        if sum(sizes[i : i + run]) >= min_words:
            covered[i : i + run] = b"\1" * run
    if all(covered):
        return pieces
    found, i = [], 0
    while i < len(pieces):
        end = i + 1
        if not covered[i]:
            while end < len(pieces) and not covered[end]:
                end += 1
        found += pieces[i:end] if end == i + 1 else content_cuts("".join(pieces[i:end]), MAX_JOINED)
        i = end
    return found


def run_digests(pieces: list[str], run: int, min_words: int) -> Iterator[tuple[int, bytes]]:
    """Where a run starts, and the digest of its words; case and white space do not count."""
    words = [piece.lower().split() for piece in pieces]
    wide = any(not piece.isascii() and _HAS_WIDE.search(piece) for piece in pieces)
    sizes = list(map(n_words, pieces) if wide else map(len, words))
    joined = [" ".join(w) for w in words]
    for i in range(len(words) - run + 1):
        if sum(sizes[i : i + run]) >= min_words:
            yield i, xxhash.xxh3_128_digest("\n".join(joined[i : i + run]).encode("utf-8", "surrogatepass"))


def _cut_documents(rows: DataFrame, run: int, min_words: int, max_words: int) -> DataFrame:
    """key, doc_id, n, sizes (characters of each sentence), ats, digests (of the runs): a row per row."""
    schema = "key binary, doc_id bigint, n int, sizes array<int>, ats array<int>, digests array<binary>"
    arrow = arrow_schema(schema)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            held = 0
            for key, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                pieces = sentences(text, max_words, run, min_words)
                found = list(run_digests(pieces, run, min_words))
                row = (key, doc_id, len(pieces), [len(p) for p in pieces], [at for at, _ in found], [digest for _, digest in found])
                for column, value in zip(out, row):
                    column.append(value)
                held += len(pieces)
                if held > 50_000:
                    yield record_batch(out, arrow)
                    out, held = [[], [], [], [], [], []], 0
            yield record_batch(out, arrow)

    return rows.select("key", "doc_id", "text").mapInArrow(spread, schema)


def sentence_span_dedup(
    docs: DataFrame,
    run: int = RUN,
    min_words: int = MIN_WORDS,
    max_words: int = MAX_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_sentences, removed (numbers of the sentences that go), text (the others, as they stood).

    All runs of ``run`` consecutive sentences of at least ``min_words`` words are hashed; sentences that stand
    in none are joined first (see :func:`sentences`), so what no run covers is one piece of few words. Of a digest that occurs more than once the
    first place is kept: the smallest id, and in a document the earliest run. Sentences covered by
    any other occurrence go. Counting merges in the map tasks, and only digests that repeat are
    joined back to their places, by a join that Spark may split at a digest of many places. Each text is split and hashed
    once; its digests and the lengths of its sentences are written, and all later steps read these.

    A null text is empty; a text of fewer sentences than a run is left alone. Rows that repeat id
    and text are one document (by a 128-bit key), which is its own first place. A null id counts as smaller than any
    other. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), F.col("text"))
    rows = rows.select(F.unhex(F.md5(named)).alias("key"), "doc_id", "text")
    cut = written(_cut_documents(rows, run, min_words, max_words), "sentence-runs")
    runs = cut.select("key", "doc_id", F.explode(F.arrays_zip("ats", "digests")).alias("r"))
    runs = runs.select("key", "doc_id", F.col("r.ats").alias("at"), F.col("r.digests").alias("digest"))
    counted = runs.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "at")).alias("first"))
    repeated = written(
        counted.filter("n > 1").select("digest", F.col("first.key").alias("first_key"), F.col("first.at").alias("first_at")),
        "repeated-runs",
    )
    others = runs.join(repeated, "digest").filter("key <> first_key or at <> first_at")
    starts = others.groupBy("key").agg(F.collect_set("at").alias("starts"))
    found = cut.select("key", "n", "sizes").dropDuplicates(["key"]).join(starts, "key", "left")
    joined = rows.join(found, "key", "left").select("doc_id", "text", "n", "sizes", "starts")

    def start():
        def step(ids, texts, counts, all_sizes, all_starts):
            removed, kept = [], []
            for text, sizes, starts_ in zip(texts, all_sizes, all_starts):
                gone = {at + k for at in starts_ or () for k in range(run)}
                removed.append(sorted(gone))
                if gone:
                    ends = list(accumulate(sizes))
                    text = "".join(text[end - size : end] for at, (size, end) in enumerate(zip(sizes, ends)) if at not in gone)
                kept.append(text)
            return ids, counts, removed, kept

        return step

    return map_columns(joined, "doc_id bigint, n_sentences bigint, removed array<int>, text string", start)
