"""Ranked search against a plain computation of every score."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from footfall.llm import ranked_search
from footfall.llm.queries import op11_ranked_search
from tests.conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=50):
    """(item, rank, doc, score) of rows (id, text), by the definition."""
    terms = [(i, TERM.findall((text or "").translate(LOWER))) for i, text in docs]
    terms = [(i, found) for i, found in terms if found]
    n_docs, n_terms = len(terms), sum(len(found) for _, found in terms)
    df = Counter(t for _, found in terms for t in set(found))
    result = []
    for item, text in items:
        scores = []
        for i, found in terms:
            counts, m = Counter(found), 50 + (50 * len(found) * n_docs) // n_terms
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))):
                if counts[t]:
                    w = math.floor(1000 * math.log((2.0 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 20 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(scores)[:top], 1):
            result.append((item, rank, None if null else i, -score))
    return Counter(result)


def found(docs, items, **options):
    return Counter(tuple(r) for r in ranked_search.ranked_search(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect())


@pytest.fixture
def make_items(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id bigint, text string, doc_id string, score int")


def test_terms_are_the_matches():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aZ09 _-\n\té中\x7f\x80 .[`{") for _ in range(rng.randrange(30)))
        assert [t.decode() for t in ranked_search.terms_of(text)] == TERM.findall(text.translate(LOWER))


def test_nra_on_lists_with_many_ties():
    rng = np.random.default_rng(2)
    for case in range(150):
        n_docs, n_terms, top = int(rng.integers(1, 400)), int(rng.integers(1, 8)), int(rng.choice([1, 3, 50]))
        table = rng.integers(0, int(rng.choice([2, 4, 1000])), (n_terms, n_docs)) * (rng.random((n_terms, n_docs)) < 0.6)
        table[:, : n_docs // 3] = table[:, :1]  # a third are copies
        terms, docs = np.nonzero(np.ones_like(table))
        lists = ranked_search.build_lists(terms, docs, table[terms, docs], n_terms, n_docs)
        floor = int(rng.choice([0, 0, 3]))
        got, scores = ranked_search.nra(lists, np.arange(n_terms), top, floor)
        total = table.sum(axis=0)
        assert (scores == total[got]).all()
        want = sorted((-s, i) for i, s in enumerate(total.tolist()) if s >= max(1, floor))[:top]
        assert sorted((-s, i) for i, s in zip(got.tolist(), scores.tolist()))[:top] == want


def test_nra_does_not_read_to_the_end_of_a_list_that_cannot_matter():
    """A frequent term of little weight: the bar stands above its next impact long before its end, and then only documents left count."""
    n = 100_000
    rare, common = np.arange(60), np.arange(n)
    terms = np.concatenate((np.zeros(60, int), np.ones(n, int)))
    gains = np.concatenate((np.full(60, 10_000) + np.arange(60), np.full(n, 1)))
    lists = ranked_search.build_lists(terms, np.concatenate((rare, common)), gains, 2, n)
    got, _ = ranked_search.nra(lists, np.array([0, 1]), 50)
    assert len(got) == 50 and set(got) == set(range(10, 60))


def test_whole_tables_against_brute_force(spark):
    docs, items = (pq.read_table(f"{SF}/{name}.parquet").to_pydict() for name in ("documents", "benchmark"))
    got = Counter(tuple(r) for r in op11_ranked_search(spark, SF).select("item_id", "rank", "doc_id", "score").collect())
    assert got == brute(list(zip(docs["doc_id"], docs["text"])), list(zip(items["item_id"], items["text"])))


@pytest.mark.parametrize("options", [{}, {"portion": 40}, {"block_bytes": 60}, {"top": 3}])
def test_odd_rows(make_docs, make_items, options):
    docs = [(i, f"alpha beta{i % 3} w{i}") for i in range(80)] + [(900 + i, "alpha gamma") for i in range(70)]
    docs += [(None, "alpha gamma"), (5, "alpha beta2"), (5, "alpha beta2"), (1000, None), (1001, ""), (1002, " .,- "), (1003, "long " * 200_000 + "gamma"), (1004, "ÉCOLE École 中文 gamma")]
    items = [(1, "Alpha gamma"), (2, "beta1 beta1 BETA2"), (3, None), (4, "..."), (5, "nowhere"), (None, "w7 gamma"), (1, "Alpha gamma"), (6, "École 中文")]
    assert found(make_docs(docs), make_items(items), **options) == brute(docs, items, options.get("top", 50))


def test_empty_tables(make_docs, make_items):
    assert found(make_docs([]), make_items([(1, "a")])) == Counter()
    assert found(make_docs([(1, "a")]), make_items([])) == Counter()
    assert found(make_docs([(1, None)]), make_items([(1, "a")])) == Counter()
