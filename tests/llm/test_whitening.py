"""Whitening against the same steps in plain numpy and whole numbers."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from footfall.llm import whitening
from footfall.llm.queries import op12_whitening
from tests.conftest import SF


def whole(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def brute(rows, multiplicity=True):
    """{id: (deviation, whitened values)}, explained, n."""
    kept = [(i, [math.floor(1024 * float(c)) + 100_000 for c in v]) for i, v in rows if whole(v)]
    fit = [x for _, x in kept] if multiplicity else [list(x) for x in {tuple(x) for _, x in kept}]
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    apart = lambda x: [n * a - s for a, s in zip(x, sums)]
    centred = np.array([apart(x) for x in fit], dtype=float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    result = {i: (sum(a * a for a in apart(x)), np.array(apart(x), float) / n @ vectors / np.sqrt(values)) for i, x in kept}
    return result, values / np.trace(centred.T @ centred / n), n


def compare(rows, got, **options):
    want, explained, n = brute(rows, **options)
    table = {}
    for r in got:
        table.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(table) == set(want)
    signs = None
    for i, (deviation, values) in want.items():
        mine = [table[i][k + 1] for k in range(8)]
        assert {r["deviation"] for r in mine} == {deviation} and {r["n"] for r in mine} == {n}
        assert np.allclose([r["explained"] for r in mine], explained, rtol=1e-9)
        got_values = np.array([r["whitened"] for r in mine])
        if signs is None and (np.abs(values) > 0.01).all():
            signs = np.sign(got_values * values)
        assert np.allclose(np.abs(got_values), np.abs(values), atol=1e-7)
        if signs is not None:
            assert np.allclose(got_values * signs, values, atol=1e-7)
        assert max(r["identity_error"] for r in mine) < 1e-6


def vectors(rng, n, dim=10):
    return [[rng.gauss(0, 1 + k) for k in range(dim)] for _ in range(n)]


@pytest.fixture
def make_vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, "x", "x", 1) for i, v in rows], "vec_id bigint, embedding array<float>, key string, digest string, n int")

    return make


def to_float(rows):
    return [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]


def test_whole_table(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    compare(list(zip(table["vec_id"], table["embedding"])), op12_whitening(spark, SF).collect())


@pytest.mark.parametrize("multiplicity", [True, False])
def test_copies_nulls_and_entries_that_are_no_numbers(make_vectors, multiplicity):
    rng = random.Random(3)
    base = vectors(rng, 60)
    rows = list(enumerate(base + [base[0]] * 40 + [[c + 1e-6 for c in base[1]]]))
    rows += [(500, None), (501, [None, *base[2][1:]]), (502, [math.nan, *base[2][1:]]), (503, [math.inf, *base[2][1:]]), (504, [1e30, *base[2][1:]])]
    docs = make_vectors(rows)
    got = whitening.whiten(docs, multiplicity=multiplicity).withColumnRenamed("id", "vec_id").collect()
    compare(to_float(rows[:-1]), got, multiplicity=multiplicity)


def test_rows_that_share_an_id_and_null_ids(make_vectors):
    rng = random.Random(4)
    rows = [(i // 2 if i < 20 else None, v) for i, v in enumerate(vectors(rng, 30))]
    got = whitening.whiten(make_vectors(rows)).collect()
    assert len(got) == 30 * 8 and sum(r["id"] is None for r in got) == 80


def test_other_lengths_fall_out(make_vectors):
    rng = random.Random(5)
    rows = list(enumerate(vectors(rng, 20))) + [(100, [1.0, 2.0]), (101, [])]
    assert {r["id"] for r in whitening.whiten(make_vectors(rows)).collect()} == set(range(20))


def test_nothing_to_whiten(make_vectors):
    assert whitening.whiten(make_vectors([])).count() == 0
    assert whitening.whiten(make_vectors([(1, None), (2, [])])).count() == 0
    assert whitening.whiten(make_vectors([(i, [1.0, 2.0, 3.0]) for i in range(5)])).count() == 0


def test_components_without_variance_are_left_out(make_vectors):
    rows = [(i, [float(i), 2.0 * i, float(i % 3)]) for i in range(30)]
    got = whitening.whiten(make_vectors(rows)).collect()
    assert {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-6


def test_deviations_beyond_products_of_64_bits():
    rng = np.random.default_rng(6)
    x = rng.integers(99_000, 101_000, (50, 6))
    n, sums = 10**13, (np.full(6, 10**5).astype(object) * 10**13).tolist()
    far, centred = whitening.deviations(x, n, sums)
    assert far == [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert np.allclose(centred, x - 100_000)


def test_one_spelling_per_vector():
    for values in ([], [0], [99_999, 100_001], [132_767], [132_768], [-(2**31), 2**40]):
        x = np.array(values, dtype=np.int64)
        assert whitening.unpacked(whitening.packed(x)).tolist() == values
