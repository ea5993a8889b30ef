"""Token counts that follow edits: a segment tree per document over stretches of words."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.bpe import Lexicon, bpe
from footfall.llm.common import map_columns

#: Words of a leaf, at first; edits change it.
LEAF_WORDS = 32
#: Code points that the splitter may look at behind a word: a change there can move the word's end.
#: To these come as many as the longest added token has.
LOOKAHEAD = 2

EDITS = "array<struct<start:int,end:int,text:string>>"


@dataclass
class TokenTree:
    """Sums of tokens and of code points over leaves, each a stretch of the text from a word's start.

    ``tokens`` and ``chars`` are heap-ordered trees: node i has the children 2i and 2i + 1, the
    leaves start in the middle.
    """

    tokens: np.ndarray
    chars: np.ndarray
    leaves: list[str] = field(default_factory=list)
    #: Code points of text that were split and counted, at building and since.
    encoded: int = 0

    @classmethod
    def build(cls, text: str, words: list[str], tokens: list[int]) -> TokenTree:
        """The tree of a text from its words and their numbers of tokens, LEAF_WORDS words to a leaf."""
        n = max(1, -(-len(words) // LEAF_WORDS))
        size = 1 << (n - 1).bit_length()
        trees = np.zeros((2, 2 * size), dtype=np.int64)
        if words:
            numbers = np.array((tokens, [*map(len, words)]), dtype=np.int64)
            trees[:, size : size + n] = np.add.reduceat(numbers, np.arange(0, len(words), LEAF_WORDS), axis=1)
        level = size
        while level > 1:
            np.add(trees[:, level : 2 * level : 2], trees[:, level + 1 : 2 * level : 2], out=trees[:, level // 2 : level])
            level //= 2
        ends = np.cumsum(trees[1, size : size + n]).tolist()
        return cls(trees[0], trees[1], [text[a:b] for a, b in zip([0, *ends], ends)], len(text))

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds a place, and the place in it; the end of the text is in the last leaf."""
        node, size = 1, len(self.chars) // 2
        at = min(at, int(self.chars[1]))
        while node < size:
            node *= 2
            if at >= self.chars[node] and self.chars[node + 1]:
                at -= int(self.chars[node])
                node += 1
        return node - size, at

    def set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        node = len(self.chars) // 2 + leaf
        more, longer = tokens - self.tokens[node], len(text) - self.chars[node]
        while node:
            self.tokens[node] += more
            self.chars[node] += longer
            node //= 2

    def neighbour(self, leaf: int, step: int) -> int | None:
        """The next leaf that is not empty."""
        leaf += step
        while 0 <= leaf < len(self.leaves) and not self.leaves[leaf]:
            leaf += step
        return leaf if 0 <= leaf < len(self.leaves) else None

    def edit(self, start: int, end: int, text: str, words: Lexicon) -> None:
        """Replaces a stretch. Splits and counts anew the leaves it touches and, as context, those
        before it whose last word may change and those behind it until a word ends where a leaf does.
        """
        context = LOOKAHEAD + max(map(len, words.codec.added), default=0)
        first, at = self.find(start)
        last, until = self.find(end)
        before = self.leaves[first][:at]
        while len(before) < context and (left := self.neighbour(first, -1)) is not None:
            first, before = left, self.leaves[left] + before
        changed = before + text + self.leaves[last][until:]
        while True:
            right = look = self.neighbour(last, 1)
            ahead = ""
            while look is not None and len(ahead) < context:
                ahead += self.leaves[look]
                look = self.neighbour(look, 1)
            split = words.codec.split(changed + ahead)
            done = ends_at(split, len(changed))
            if done is not None:
                break
            last, changed = right, changed + self.leaves[right]
        counts = words.entries(split[:done])
        self.encoded += len(changed)
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self.set(leaf, "", 0)
        self.set(first, changed, sum(counts))


def ends_at(split: list[str], length: int) -> int | None:
    """How many words make up the first ``length`` code points; none if a word goes beyond."""
    at = 0
    for i, word in enumerate(split):
        if at >= length:
            return i if at == length else None
        at += len(word)
    return len(split) if at == length else None


def built(text: str, words: Lexicon) -> TokenTree:
    split = words.codec.split(text)
    return TokenTree.build(text, split, words.entries(split))


def edited_counts(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits"
) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_edited, chars_reencoded, text: counts before and after edits.

    ``edits`` is an array of (start, end, text) in code points of the text as it came; edits do not
    overlap, and those at one place apply in the array's order. Each edit splits only the stretch it
    touches and updates the sums above it; ``n_tokens_edited`` is the root. A null array has no
    edits, a null text is empty, an edit beyond the end adds at the end. Rows are mapped one by one:
    ids may be null or repeat, other columns are ignored, an empty table gives no rows.
    """

    def start():
        words = Lexicon(bpe(vocabulary), lambda ids, raw: len(ids))

        def step(ids, texts, all_edits):
            rows = []
            for doc_id, text, edits, (split, counts) in zip(ids, texts, all_edits, words.words(texts)):
                tree = TokenTree.build(text or "", split, counts)
                before, read = tree.total, tree.encoded
                most = len(text or "")
                places = [(min(e["start"], most), min(e["end"], most), i, e["text"] or "") for i, e in enumerate(edits or ())]
                for first, last, _, new in sorted(places, reverse=True):  # from the back, so that places ahead stay what they are
                    tree.edit(first, last, new, words)
                rows.append((doc_id, before, len(edits or ()), tree.total, tree.encoded - read, "".join(tree.leaves)))
            return zip(*rows) if rows else [[]] * 6

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(edits_col).cast(EDITS).alias("edits"))
    schema = f"doc_id {kind}, n_tokens bigint, n_edits bigint, n_tokens_edited bigint, chars_reencoded bigint, text string"
    return map_columns(chosen, schema, start)
