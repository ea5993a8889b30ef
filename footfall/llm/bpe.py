"""BPE by speculation: longest-match proposes tokens, array checks test all pairs, few words are merged."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from footfall.llm.common import map_columns, vocabulary_file

#: The split of the byte-level vocabularies, a fixed value.
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: All versions of Unicode agree on the letters, digits and spaces before this one.
NEWER = re.compile("[^\u0000-\u04ff]")
#: Words that a task remembers; beyond it keeps those that came up again.
MEMORY = 400_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encodes words as byte-level BPE merges them.

    A sequence of tokens is what the merges give if and only if each adjacent pair is: no merge that
    comes before the ones that made the two tokens joins bytes across their border. So a proposal is
    right when all its pairs are, and only other words need the merges themselves.
    """

    def __init__(self, path: str):
        with open(vocabulary_file(path), encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        ids = spec["model"]["vocab"]
        size = max(ids.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token)
        self.id_of = {b: i for i, b in enumerate(self.bytes_of) if b}
        self.added = {}
        for token in spec["added_tokens"]:
            self.added[token["content"]] = token["id"]
            self.bytes_of += [b""] * (token["id"] + 1 - len(self.bytes_of))
            self.bytes_of[token["id"]] = token["content"].encode()
        self.added_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        size = len(self.bytes_of)
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.left = np.arange(size, dtype=np.int64)
        self.right = np.arange(size, dtype=np.int64)
        self.order = np.full(size, -1, dtype=np.int64)
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (ids[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            whole = ids["".join(pair if isinstance(pair, list) else pair.split(" "))]
            self.rank[a, b] = rank, whole
            if self.order[whole] < 0:
                self.left[whole], self.right[whole], self.order[whole] = a, b, rank
        keys = np.array([a * size + b for a, b in self.rank], dtype=np.int64)
        by = np.argsort(keys)
        self.pair_keys = keys[by]
        self.pair_ranks = np.array([r for r, _ in self.rank.values()], dtype=np.int64)[by]
        self.size = size
        self.merged = [whole for _, whole in self.rank.values()]
        self.rank_of = {pair: rank for pair, (rank, _) in self.rank.items()}
        #: What tokens begin with: the token's id, or -1 if it is none by itself.
        self.begins = {token[:n]: -1 for token in self.id_of for n in range(1, len(token))} | self.id_of

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        ids, at, n, begins = [], 0, len(word), self.begins.get
        while at < n:
            end = at + 1
            found, best = begins(word[at:end]), end
            while end < n and (i := begins(word[at : end + 1])) is not None:
                end += 1
                if i >= 0:
                    found, best = i, end
            ids.append(found)
            at = best
        return ids

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of both tokens leaves exactly the two tokens, for all pairs at once.

        Undoes the merges of both tokens from the last one back. While a border token of the left
        and one of the right stand side by side, a merge of the two must not rank before the merge
        that ended the time of one of them.
        """
        a, b = left.astype(np.int64), right.astype(np.int64)
        good = np.ones(len(a), dtype=bool)
        # The merge that comes next in time after the pair (a, b) stood side by side; -1 marks bytes.
        until = np.full(len(a), np.iinfo(np.int64).max)
        at_left = np.zeros(len(a), dtype=bool)  # whether that merge was on the left side
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            key = x * self.size + y
            i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[i] == key, self.pair_ranks[i], np.iinfo(np.int64).max)
            # Of merges of equal rank, the one further left comes first: a merge on the right side
            # ranks with that of the border only if it is the same pair, and then the border is first.
            limit = until[open_]
            broken = (rank < limit) | ((rank == limit) & (rank < np.iinfo(np.int64).max) & ~at_left[open_])
            good[open_[broken]] = False
            ox, oy = self.order[x], self.order[y]
            going = ~broken & ((ox >= 0) | (oy >= 0))
            open_, x, y, ox, oy = open_[going], x[going], y[going], ox[going], oy[going]
            # The later of the two merges is undone first; of equal ones, the right one came later.
            undo_left = ox > oy
            a[open_] = np.where(undo_left, self.right[x], x)
            b[open_] = np.where(undo_left, y, self.left[y])
            until[open_] = np.where(undo_left, ox, oy)
            at_left[open_] = undo_left
        return good

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost among equals."""
        ids = [self.id_of[word[i : i + 1]] for i in range(len(word))]
        return self._merge_short(ids) if len(ids) <= 64 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        none, get = len(self.merged), self.rank_of.get
        ranks = [get(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            ids[i] = self.merged[least]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same in n log n."""
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(self.rank[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i] = self.rank[a, b][1]
            ids[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := (ids[i], ids[k])) in self.rank:
                    heapq.heappush(heap, (self.rank[p][0], i, *p))
            if (h := before[i]) >= 0 and (p := (ids[h], ids[i])) in self.rank:
                heapq.heappush(heap, (self.rank[p][0], h, *p))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """The tokens of each word, and how many words the proposal failed for."""
        proposals = [self.propose(word) for word in words]
        lengths = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((i for p in proposals for i in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        inside = owner[1:] == owner[:-1]
        pairs, where = flat[:-1][inside] * self.size + flat[1:][inside], owner[1:][inside]
        distinct, back = np.unique(pairs, return_inverse=True)
        bad = ~self.compatible(distinct // self.size, distinct % self.size)
        failed = np.unique(where[bad[back]])
        for i in failed.tolist():
            proposals[i] = self.merge(words[i])
        return proposals, len(failed)

    def split(self, text: str) -> list[str]:
        """Words and added tokens, in order."""
        if self.added_split is None or not any(token in text for token in self.added):
            return _words(text)
        words = []
        for i, part in enumerate(self.added_split.split(text)):
            words += [Added(part)] if i % 2 else _words(part)
        return words


def _words(text: str) -> list[str]:
    """Where two versions of Unicode may class a character differently, the tokenizers library splits."""
    if NEWER.search(text) is None:
        return SPLIT.findall(text)
    return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)]


class Added(str):
    """An added token; it equals no word of the same characters."""

    def __hash__(self):
        return hash(("added", str(self)))

    def __eq__(self, other):
        return isinstance(other, Added) and str.__eq__(self, other)


@lru_cache(2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


class Lexicon:
    """What a task has learnt about words: for each, ``entry(ids, bytes)``."""

    def __init__(self, codec: Bpe, entry):
        self.codec, self.entry, self.known = codec, entry, {}

    def look_up(self, texts: list[str | None]) -> Iterator[list]:
        """The entries of the words of each text, in order."""
        return (entries for _, entries in self.words(texts))

    def words(self, texts: list[str | None]) -> Iterator[tuple[list[str], list]]:
        """The words of each text and their entries; learns the words of many texts at a time."""
        for at in range(0, len(texts), 500):
            split = [self.codec.split(text or "") for text in texts[at : at + 500]]
            met = set().union(*split)
            if len(self.known) > MEMORY:
                self.known = {word: self.known[word] for word in met.intersection(self.known)}
            self._learn(met)
            # All at once: between two texts the caller may ask for other words.
            yield from [(words, [*map(self.known.__getitem__, words)]) for words in split]

    def entries(self, words: list[str]) -> list:
        self._learn(set(words))
        return [*map(self.known.__getitem__, words)]

    def _learn(self, met: set[str]) -> None:
        fresh = list(met.difference(self.known))
        if not fresh:
            return
        words = [w for w in fresh if not isinstance(w, Added)]
        tokens, _ = self.codec.encode_words([w.encode() for w in words])
        of = self.codec.bytes_of
        for word, ids in zip(words, tokens):
            self.known[word] = self.entry(ids, b"".join([of[i] for i in ids]))
        for word in fresh:
            if isinstance(word, Added):
                i = self.codec.added[str(word)]
                self.known[word] = self.entry([i], of[i])


def bpe_encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, decoded: the tokens of each text and the text that they decode to.

    ``vocabulary`` is a byte-level BPE file that every executor can open. An added token in a text
    is that token. A null text is empty: no tokens. Rows are mapped one by one, nothing is shuffled:
    ids may be null or repeat, other columns are ignored, an empty table gives no rows.
    """

    def start():
        words = Lexicon(bpe(vocabulary), lambda ids, raw: (ids, raw))

        def step(keys, texts):
            found = list(words.look_up(texts))
            return keys, [[i for e in es for i in e[0]] for es in found], [_decoded(e[1] for e in es) for es in found]

        return step

    return _mapped(docs, id_col, text_col, "ids array<int>, decoded string", start)


def bpe_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`bpe_encode`, but of tokens and decoded text their number and sha-256 only."""

    def start():
        words = Lexicon(bpe(vocabulary), lambda ids, raw: (len(ids), ",".join(map(str, ids)), raw))

        def step(keys, texts):
            counts, ids, decoded = [], [], []
            for entries in words.look_up(texts):
                n, numbers, raw = zip(*entries) if entries else ((), (), ())
                counts.append(sum(n))
                ids.append(sha256(",".join(numbers).encode()).hexdigest())
                decoded.append(sha256(_decoded(raw).encode()).hexdigest())
            return keys, counts, ids, decoded

        return step

    return _mapped(docs, id_col, text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", start)


def _decoded(parts) -> str:
    return b"".join(parts).decode("utf-8", "replace")


def _mapped(docs: DataFrame, id_col: str, text_col: str, result: str, start) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_columns(chosen, f"doc_id {kind}, {result}", start)
