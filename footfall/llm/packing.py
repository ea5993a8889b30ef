"""Packing by Karmarkar-Karp differencing: documents into windows of nearly equal numbers of tokens."""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import arrow_schema, record_batch, vocabulary_file

#: Windows that are packed together; a block holds that many windows' tokens, times FILL.
BLOCK_WINDOWS = 64
#: What a block holds of its windows' capacity: room for what differencing leaves uneven.
FILL = 0.99
#: Words that a task remembers; beyond it keeps those that came up again.
MEMORY = 400_000

PIECES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def karmarkar_karp(sizes: list[int], windows: int) -> list[list[int]]:
    """The items of each of ``windows`` windows, with sums as equal as differencing makes them.

    Starts with a partial partition for each item. Always takes the two whose sums differ most and
    lays the largest sum of one on the smallest of the other. Equal differences go by the smaller
    item, so that the result depends on the sizes alone.
    """
    # A partial partition: its sums in falling order without the zeros, and the items of each.
    heap = [(-size, i, [size], [i]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, sums, items = heapq.heappop(heap)
        _, j, more, others = heapq.heappop(heap)
        overlap = len(sums) + len(more) - windows
        if overlap <= 0:
            parts = [*zip(sums, items), *zip(more, others)]
        else:
            clear = len(sums) - overlap
            upon = len(more) - overlap
            parts = [*zip(sums[:clear], items[:clear]), *zip(more[:upon], others[:upon])]
            for k in range(overlap):
                a, b = len(sums) - 1 - k, upon + k
                parts.append((sums[a] + more[b], (items[a], others[b])))
        parts.sort(key=lambda part: -part[0])
        sums, items = [part[0] for part in parts], [part[1] for part in parts]
        least = sums[-1] if len(sums) == windows else 0
        heapq.heappush(heap, (least - sums[0], min(i, j), sums, items))
    return [_flat(tree) for tree in heap[0][3]] if heap else []


def _flat(tree) -> list[int]:
    flat, open_ = [], [tree]
    while open_:
        node = open_.pop()
        if isinstance(node, tuple):
            open_ += node
        else:
            flat.append(node)
    return sorted(flat)


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; one window more as long as one is too full."""
    if any(size > capacity for size in sizes):
        raise ValueError("an item is larger than a window")
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        packed = karmarkar_karp(sizes, windows)
        if all(sum(sizes[i] for i in window) <= capacity for window in packed):
            return packed
        windows += 1


class WordTokens:
    """Token ids of texts, through a memory of the words that the vocabulary's splitter gives.

    Texts within Latin-1 are split here, by the splitter's pattern with its classes written out;
    a stretch of others is what stands between white space, which the splitter never joins. Words
    of letters are tokenised many at a time: each ends with its first token that ends a word.
    """

    LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\x09-\x0d \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
    WHITE = re.compile("[ \t\n\r]+")

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks already use all cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_file(vocabulary))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [str(token) for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids as little-endian 32-bit numbers."""
        split = [self._split(text or "") for text in texts]
        met = set().union(*split)
        if len(self.known) > MEMORY:
            self.known = {word: self.known[word] for word in met.intersection(self.known)}
        fresh = list(met.difference(self.known))
        plain = [word for word in fresh if word.isalpha() and _is_latin(word)]
        if plain:
            coded = self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0]
            ids = np.array(coded.ids, dtype="<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            raw = ids.tobytes()
            for word, a, b in zip(plain, [0, *stops[:-1]], stops, strict=True):
                self.known[word] = raw[4 * a : 4 * b]
        other = list(set(fresh).difference(plain))
        for word, coded in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            self.known[word] = np.array(coded.ids, dtype="<u4").tobytes()
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def _split(self, text: str) -> list[str]:
        if _is_latin(text) and not any(token in text for token in self.special):
            return self.LATIN.findall(text.lower())
        return self.WHITE.split(text)


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Block:
    """Pieces of documents that are packed together."""

    def __init__(self, window: int, piece: int, first: int):
        self.window, self.piece, self.room, self.first = window, piece, int(BLOCK_WINDOWS * window * FILL), first
        self.pieces: list[tuple] = []

    def add(self, doc_id, start: int, ids: bytes, total: int) -> int:
        """Takes ids from ``start`` on, as many as there is room for; how far it came."""
        end = min(total, start + self.room)
        self.room -= end - start
        parts = -(-(end - start) // self.piece)
        for k in range(parts):
            a, b = start + (end - start) * k // parts, start + (end - start) * (k + 1) // parts
            self.pieces.append((doc_id, a, b - a, crc32(ids[4 * a : 4 * b]), total))
        return end

    def packed(self) -> list[tuple]:
        rows = []
        windows = pack_sizes([piece[2] for piece in self.pieces], self.window)
        for k, window in enumerate(windows):
            at = 0
            for i in window:
                rows.append((*self.pieces[i], self.first + k, at))
                at += self.pieces[i][2]
        self.first += len(windows)
        return rows


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    window: int = 4096,
    max_piece: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and ``end_id``, cut into pieces of at most ``max_piece`` tokens. Each task
    fills blocks of 64 windows from its share of the table and packs each block by differencing;
    only the last block of a task may be short. Nothing is shuffled, a task holds one block, and a
    task that runs again gives the same rows. Sequence ids are unique and tell the task in the upper bits.

    A null or empty text is one token. Ids pass through, null or repeated; other columns are
    ignored; an empty table gives no rows.
    """
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, {PIECES}"
    arrow = arrow_schema(schema)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(vocabulary)
        block = _Block(window, max_piece, TaskContext.get().partitionId() << 32)
        for batch in batches:
            ids_of, texts = (column.to_pylist() for column in batch.columns)
            for at in range(0, len(texts), 500):
                for doc_id, ids in zip(ids_of[at : at + 500], tokens(texts[at : at + 500])):
                    ids += end
                    start, total = 0, len(ids) // 4
                    while (start := block.add(doc_id, start, ids, total)) < total:
                        yield record_batch(zip(*block.packed()), arrow)
                        block = _Block(window, max_piece, block.first)
        if block.pieces:
            yield record_batch(zip(*block.packed()), arrow)

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, schema)
