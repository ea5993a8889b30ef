import itertools
import math

import pytest

from footfall.functions import stats


def fisher_by_enumeration(a, b, c, d):
    r1, r2, c1 = a + b, c + d, a + c
    total = math.comb(r1 + r2, c1)
    p = {x: math.comb(r1, x) * math.comb(r2, c1 - x) / total for x in range(max(0, c1 - r2), min(r1, c1) + 1)}
    return sum(v for v in p.values() if v <= p[a] * (1 + 1e-7))


def test_fisher_against_enumeration():
    for table in itertools.product(range(0, 13, 3), repeat=4):
        if sum(table):
            assert stats.fisher_two_sided(*table) == pytest.approx(fisher_by_enumeration(*table), rel=1e-9), table


def test_fisher_known_and_large():
    assert stats.fisher_two_sided(8, 2, 1, 5) == pytest.approx(0.03496503496503495)
    assert stats.fisher_two_sided(300, 700, 340, 660) == pytest.approx(fisher_by_enumeration(300, 700, 340, 660), rel=1e-7)
    # Two groups of fifty million users.
    p = stats.fisher_two_sided(5_000_000, 45_000_000, 5_003_000, 44_997_000)
    z = 3000 / math.sqrt(2 * 5e7 * 0.10003 * 0.89997)
    assert p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=2e-3)


def test_student_table():
    # Printed tables: two-sided 5 % and 1 % points.
    for df, t, p in ((1, 12.7062047, 0.05), (5, 2.5705818, 0.05), (10, 3.1692727, 0.01), (30, 2.0422725, 0.05), (1000, 1.9623391, 0.05)):
        assert stats.student_two_sided(t, df) == pytest.approx(p, rel=1e-6)
    assert stats.student_two_sided(0.0, 7.3) == pytest.approx(1.0)


def test_normal_tail(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(z,) for z in (0.0, 0.5, 1.0, 1.96, 3.0, 5.0)], "z double")
    for row in df.withColumn("p", stats.normal_two_sided(F.col("z"))).collect():
        assert row.p == pytest.approx(math.erfc(row.z / math.sqrt(2)), abs=2e-7)


def test_mann_whitney_exact_by_enumeration():
    for m, n in ((5, 6), (8, 5), (3, 12)):
        values = [sum(sum(x > y for y in set(range(m + n)) - set(a)) for x in a) for a in itertools.combinations(range(m + n), m)]
        for u in (0, 3, m * n // 2, m * n):
            larger = max(u, m * n - u)
            want = min(1.0, 2 * sum(v >= larger for v in values) / len(values))
            assert stats.mann_whitney_exact(u, m, n) == pytest.approx(want)


def test_mann_whitney_no_spread():
    assert stats.mann_whitney(12.5, 5, 5, 990.0) == 1.0
