"""Exact copies, sentence runs, byte strings and similar sets, each against brute force."""

import hashlib
import random
import re
import sys
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from footfall.llm import exact_dedup, jaccard_join, sentence_dedup, suffix_dedup
from footfall.llm.components import connected_components
from footfall.llm.queries import op5_suffix_array_dedup, op6_jaccard_join
from footfall.llm.suffix_array import permuted_common_prefixes, suffix_array
from tests.conftest import SF


def documents():
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return dict(zip(table["doc_id"], table["text"]))


# --- exact copies


def test_exact_dedup_cases(make_docs):
    docs = make_docs([(3, "a  b"), (1, "a\t\nb"), (2, "a b "), (4, None), (5, ""), (None, "a b"), (1, "a\t\nb")])
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {(3, 1, 4, False), (1, 1, 4, True), (2, 2, 1, True), (4, 4, 2, True), (5, 4, 2, False), (None, 1, 4, False)}
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


def test_exact_dedup_sets_collisions_apart(make_docs):
    docs = make_docs([(i, text) for i, text in enumerate(["aa", "bb", "aa", "c", "bb", "dd", "eeee"])])
    got = exact_dedup.exact_dedup(docs, content_hash=lambda text: F.length(text))
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got.collect()) == [
        (0, 0, 2), (1, 1, 2), (2, 0, 2), (3, 3, 1), (4, 1, 2), (5, 5, 1), (6, 6, 1),
    ]


def test_exact_dedup_empty_table(make_docs):
    assert exact_dedup.exact_dedup(make_docs([])).count() == 0
    assert exact_dedup.drop_exact_copies(make_docs([])).count() == 0


def test_exact_dedup_runs_no_python(make_docs):
    plan = exact_dedup.exact_dedup(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- runs of sentences


def test_sentences_are_the_whole_text():
    text = " A b. C?! d\n\ne " + "w " * 40 + "end"
    pieces = sentence_dedup.sentences(text)
    assert "".join(pieces) == text
    assert max(len(p.split()) for p in pieces) == 16
    assert sentence_dedup.sentences("") == []


def test_sentence_dedup_keeps_the_first(make_docs):
    passage = "One two three four. Five six seven eight. Nine ten eleven twelve. "
    rows = [(2, "Mine. " + passage + "Yours."), (1, passage), (3, passage.upper()), (4, "Short. One."), (5, None), (None, "x")]
    got = {r.doc_id: r for r in sentence_dedup.sentence_span_dedup(make_docs(rows)).collect()}
    assert got[1].removed == [] and got[1].text == passage
    assert got[2].removed == [1, 2, 3] and got[2].text == "Mine. Yours."
    assert got[3].removed == [0, 1, 2] and got[3].text == ""
    assert got[4].removed == [] and got[5].n_sentences == 0 and got[None].text == "x"
    assert sentence_dedup.sentence_span_dedup(make_docs([])).count() == 0


def test_sentence_dedup_inside_one_text_and_repeated_rows(make_docs):
    passage = "One two three four. Five six seven eight. Nine ten eleven twelve. "
    got = sentence_dedup.sentence_span_dedup(make_docs([(1, passage + "Z. " + passage)] * 2)).collect()
    assert [r.removed for r in got] == [[4, 5, 6]] * 2


def test_sentence_dedup_against_brute_force(spark):
    docs = documents()
    seen, want = {}, {}
    for doc_id in sorted(docs):
        pieces = sentence_dedup.sentences(docs[doc_id])
        words = [p.lower().split() for p in pieces]
        gone = set()
        for i in range(len(words) - 2):
            key = str(words[i : i + 3])
            if sum(map(len, words[i : i + 3])) >= 10 and seen.setdefault(key, (doc_id, i)) != (doc_id, i):
                gone |= {i, i + 1, i + 2}
        want[doc_id] = sorted(gone)
    got = sentence_dedup.sentence_span_dedup(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r.doc_id: r.removed for r in got.collect()} == want
    assert any(want.values())


def left_of(make_docs, passage, befores=("Mine is this. ", "Yours was that one. ")):
    """The words of the passage that are left in its second place."""
    rows = [(i, before + passage) for i, before in enumerate(befores)]
    got = {r.doc_id: r for r in sentence_dedup.sentence_span_dedup(make_docs(rows)).collect()}
    assert got[0].text == rows[0][1]
    return [w for w in got[1].text.split() if w in set(passage.split())]


def test_sentence_dedup_of_short_sentences(make_docs):
    assert len(left_of(make_docs, " ".join(f"word{i}!!" for i in range(60)))) < 10
    assert len(left_of(make_docs, " ".join(f"No w{i} so here. Yes{i}." for i in range(20)))) < 10


@pytest.mark.parametrize("before", range(1, 16))
def test_sentence_cuts_realign_behind_other_beginnings(before):
    """A passage without marks is cut alike whatever stands before it."""
    passage = [f"word{i}" for i in range(60)]
    runs = lambda words: {d for _, d in sentence_dedup.run_digests(sentence_dedup.sentences(" ".join(words)), 3, 10)}
    shared = runs(passage) & runs([f"x{before}y{i}" for i in range(before)] + passage)
    assert len(shared) >= 3


def test_sentence_dedup_of_passages_without_our_marks(make_docs):
    assert len(left_of(make_docs, " | ".join(f"cell{i}" for i in range(60)), ("mine ", "yours is longer | "))) < 20
    signs = "".join(chr(0x4E00 + 37 * i) + ("\u3002" if i % 7 == 6 else "") for i in range(60))
    rows = [(1, "\u6211\u7684" + signs), (2, "\u4f60" + signs)]
    got = {r.doc_id: r.text for r in sentence_dedup.sentence_span_dedup(make_docs(rows)).collect()}
    assert got[1] == rows[0][1] and len(got[2]) < 20


# --- byte strings


def test_suffix_array_and_prefixes():
    rng = random.Random(7)
    for _ in range(400):
        n, top = rng.randint(0, 50), rng.choice([1, 2, 5, 500])
        text = np.array([rng.randint(0, top) for _ in range(n)], dtype=np.int64)
        if rng.random() < 0.4 and n:
            text = np.tile(text[: max(1, n // 4)], 6)
        symbols = text.tolist()
        want = sorted(range(len(symbols)), key=lambda i: symbols[i:])
        assert suffix_array(text).tolist() == want
        if len(symbols) > 1:
            shared = permuted_common_prefixes(text, np.array(want), 0)
            for a, b in zip(want, want[1:]):
                k = 0
                while max(a, b) + k < len(symbols) and symbols[a + k] == symbols[b + k] != 0:
                    k += 1
                assert shared[b] == k


def test_suffix_array_of_many_symbols_is_made_by_arrays():
    """Neither the text nor the string of its names is gone through entry by entry: the lines run do not grow with them."""
    rng, lines = np.random.default_rng(5), [0]

    def count(frame, event, arg):
        if frame.f_code.co_filename != suffix_array.__code__.co_filename:
            return None
        lines[0] += event == "line"
        return count

    for top, period in [(25, 0), (5_000, 0), (5_000, 700)]:
        text = rng.integers(1, top + 1, 6_000)
        text[3_500:5_500] = text[500:2_500]  # repeats far longer than a string
        if period:
            text = np.tile(text[:period], 8)
        lines[0], before = 0, sys.gettrace()
        sys.settrace(count)
        try:
            order = suffix_array(text)
        finally:
            sys.settrace(before)
        symbols = text.tolist()
        assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])
        assert lines[0] < 10_000


def brute_spans(texts: list[bytes], length: int):
    count = Counter(raw[i : i + length] for raw in texts for i in range(len(raw) - length + 1))
    found = []
    for raw in texts:
        mask = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if count[raw[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        found.append((bytes(b for b, m in zip(raw, mask) if not m), mask))
    return found


def periodic_texts(rng):
    noise = lambda n: "".join(rng.choice("abé \n=") for _ in range(n))
    unit = noise(rng.choice([1, 1, 2, 3, 7, 15, 24, 26, 60]))
    run = lambda: (unit * 400)[rng.randrange(len(unit)) :][: rng.choice([39, 40, 41, 60, 80, 81, 120, 121, 300, 700])]
    texts = [noise(rng.randrange(60)) + run() + noise(rng.randrange(60)) for _ in range(rng.choice([1, 2, 5]))]
    return texts + [noise(20) + run() + noise(5) + run()] * rng.choice([0, 1])


def test_periodic_texts_against_brute_force(make_docs):
    """Runs of one unit in many texts, of lengths around one string and around one and two periods."""
    rng = random.Random(11)
    texts = [t for _ in range(60) for t in periodic_texts(rng)]
    got = suffix_dedup.suffix_array_dedup(make_docs(list(enumerate(texts))), length=40).collect()
    want = brute_spans([t.encode() for t in texts], 40)
    for row in got:
        assert bytes(row.kept) == want[row.doc_id][0]


def test_periodic_text_alone(make_docs):
    """One text that only repeats itself: every start of its periodic part, and nothing else, goes."""
    rng = random.Random(12)
    for case in range(6):
        (text,) = periodic_texts(rng)[:1]
        (row,) = suffix_dedup.suffix_array_dedup(make_docs([(1, text)]), length=40).collect()
        assert bytes(row.kept) == brute_spans([text.encode()], 40)[0][0]


def test_stretches_of_a_long_periodic_text_are_few(make_docs):
    for unit in ("y", "x ", "= =\n"):
        text = (unit * 5_000_000)[:5_000_000]
        found = [part for part in suffix_dedup.stretches(text.encode(), 400)]
        assert sum(len(first) for first, *_ in found) < 30
    got = suffix_dedup.suffix_array_dedup(make_docs([(1, "y" * 8_000_000), (2, "a" + "y" * 400), (3, "y" * 399)])).collect()
    assert {r.doc_id: (r.n_bytes, bytes(r.kept)) for r in got} == {1: (8_000_000, b""), 2: (401, b"a"), 3: (399, b"y" * 399)}


@pytest.mark.parametrize("hot", [1, 4_000_000])
def test_byte_strings_against_brute_force(make_docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "ANCHOR_BYTES", hot)
    rng = random.Random(hot)
    noise = lambda n: "".join(rng.choice("abé \n") for _ in range(n))
    shared = [noise(90), noise(140), "ab" * 120]
    texts = [noise(rng.randint(0, 60)) + rng.choice(shared)[rng.randint(0, 30) :] + noise(50) for _ in range(60)]
    texts += ["", None, "a" * 300, texts[3], texts[3]]
    got = suffix_dedup.suffix_array_dedup(make_docs(list(enumerate(texts))), length=40).collect()
    want = brute_spans([(t or "").encode() for t in texts], 40)
    for row in got:
        kept, mask = want[row.doc_id]
        assert (row.n_bytes, bytes(row.kept)) == (len(mask), kept), row.doc_id
        assert sum(s.end - s.start for s in row.spans) == sum(mask)
    assert len(got) == len(texts)


def test_byte_strings_cases(make_docs):
    long = "".join(random.Random(1).choice("abcdefgh ") for _ in range(5000))
    got = suffix_dedup.suffix_array_dedup(make_docs([(1, long), (1, long), (None, "x" * 399), (2, "y" * 401)])).collect()
    assert sorted((r.doc_id or 0, len(r.kept)) for r in got) == [(0, 399), (1, 0), (1, 0), (2, 0)]
    assert suffix_dedup.suffix_array_dedup(make_docs([])).count() == 0


def test_op5_whole_table(spark):
    docs = documents()
    want = dict(zip(docs, brute_spans([t.encode() for t in docs.values()], 400)))
    for row in op5_suffix_array_dedup(spark, SF).collect():
        kept, mask = want[row.doc_id]
        spans = sum(m and not (i and mask[i - 1]) for i, m in enumerate(mask))
        assert (row.n_removed, row.n_spans, row.kept_sha256) == (sum(mask), spans, hashlib.sha256(kept).hexdigest())


# --- similar sets


def brute_components(docs: dict, n: int, percent: int):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for doc_id, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        width = min(n, len(words))
        sets[doc_id] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng, n, size, words=400, edits=6):
    base = [f"w{rng.randint(0, words)}" for _ in range(size)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(size)] = f"n{rng.randint(0, 10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_jaccard_join_against_brute_force(make_docs, n, percent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 20)
    rng = random.Random(n)
    texts = [t for size in (4, 12, 25, 60, 150, 300) for t in near_copies(rng, 30, size)]
    texts += ["", None, "one", "ONE", "two words", " Two\twords ", texts[0], "a b c d e f g h i j", "a b c d e f g h i k"]
    rng.shuffle(texts)
    docs = dict(enumerate(texts))
    got = jaccard_join.jaccard_join(make_docs(list(docs.items())), n, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(docs, n, percent)


def test_jaccard_join_cases(make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(5, text), (5, text), (None, text), (7, text + " x"), (9, None)])
    got = jaccard_join.jaccard_join(docs)
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got.collect()) == [(0, 0), (5, 5), (5, 5), (7, 5), (9, 9)]
    kept = jaccard_join.drop_near_copies(docs, 3, 90)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 5, 5, 9]
    assert jaccard_join.jaccard_join(make_docs([])).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_sets_with_an_empty_part_still_meet(percent):
    """Linked sets agree in as many parts of a dealing as it demands, whatever they leave empty."""
    classes = jaccard_join.SizeClasses(jaccard_join.Fraction(percent, 100))
    rng = np.random.default_rng(1)
    for size in (12, 25, 60, 200, 700):
        allowed = (2 * size * (100 - percent)) // (100 + percent)
        for _ in range(150):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            b = np.sort(np.concatenate((a[allowed // 2 :], rng.integers(0, 2**63, allowed // 2, dtype=np.uint64))))
            overlap = len(np.intersect1d(a, b))
            if classes.links(overlap, len(a), len(b)):
                common = set(jaccard_join.part_keys(a, classes).tolist()) & set(jaccard_join.part_keys(b, classes).tolist())
                dealings = Counter(key % (16 * jaccard_join.SCHEMES) for key in common)
                assert any(n >= classes.parts(label >> 4)[2] for label, n in dealings.items()), (size, percent)


def test_op6_whole_table(spark):
    got = op6_jaccard_join(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(documents(), 3, 90)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 150)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 10 for i in range(11, 41)) and all(got[i] == 100 for i in [*range(101, 160), 200])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
