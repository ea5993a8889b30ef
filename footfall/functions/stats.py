"""P-values. They run on aggregated rows only: one per day, experiment and metric."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The functions travel to the executors by value: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The polynomial normal tail of Abramowitz and Stegun, 26.2.17.
_TAIL_P = 0.2316419
_TAIL_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
_INV_SQRT_2PI = 0.3989422804014327


def normal_two_sided(z: Column) -> Column:
    """Two-sided normal p-value as a column expression (error below 1.5e-7)."""
    z = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_TAIL_P) * z)
    poly = F.lit(_TAIL_B[-1])
    for b in reversed(_TAIL_B[:-1]):
        poly = F.lit(b) + t * poly
    tail = F.lit(_INV_SQRT_2PI) * F.exp(-z * z / 2) * t * poly
    return F.least(F.lit(1.0), 2 * tail)


def log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Fisher's exact test of ``[[a, b], [c, d]]``: the sum of all tables no likelier than this one.

    The probabilities fall away from the mode on both sides, so the other side's first
    table is found by bisection and each tail is summed outwards until its terms no
    longer change a double: the work grows with the spread, not with the margins.
    """
    r1, r2, c1 = a + b, c + d, a + c
    lo, hi = max(0, c1 - r2), min(r1, c1)
    if lo == hi:
        return 1.0

    def log_p(x: int) -> float:
        return log_choose(r1, x) + log_choose(r2, c1 - x) - log_choose(r1 + r2, c1)

    def ratio_up(x: int) -> float:  # p(x + 1) / p(x)
        return (r1 - x) * (c1 - x) / ((x + 1) * (r2 - c1 + x + 1))

    def tail(x: int, step: int) -> float:
        total, term = 0.0, math.exp(log_p(x)) if lo <= x <= hi else 0.0
        while lo <= x <= hi and term > total * 1e-18:
            total += term
            if step > 0:
                term *= ratio_up(x) if x < hi else 0.0
            else:
                term = term / ratio_up(x - 1) if x > lo else 0.0
            x += step
        return total

    bound = log_p(a) + math.log1p(1e-7)
    mode = min(max((r1 + 1) * (c1 + 1) // (r1 + r2 + 2), lo), hi)
    if log_p(mode) <= bound:
        return 1.0
    if a < mode:
        left, inside, outside = a, mode, hi + 1
        while outside - inside > 1:
            mid = (inside + outside) // 2
            inside, outside = (inside, mid) if log_p(mid) <= bound else (mid, outside)
        right = outside
    else:
        right, inside, outside = a, mode, lo - 1
        while inside - outside > 1:
            mid = (inside + outside) // 2
            inside, outside = (inside, mid) if log_p(mid) <= bound else (mid, outside)
        left = outside
    # Equal neighbours of the observed table count too.
    while left + 1 < mode and log_p(left + 1) <= bound:
        left += 1
    while right - 1 > mode and log_p(right - 1) <= bound:
        right -= 1
    return min(1.0, tail(left, -1) + tail(right, 1))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - incomplete_beta(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 100_000):
        for factor in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + factor * d
            c = 1.0 + factor / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * value / a


def student_two_sided(t: float, df: float) -> float:
    return incomplete_beta(df / 2, 0.5, df / (df + t * t))


def mann_whitney_exact(u: float, n_a: int, n_b: int) -> float:
    """Exact two-sided p-value without ties; for a sample of at most 8.

    The number of orderings with each U is the coefficient of a Gaussian binomial.
    """
    m, n = min(n_a, n_b), max(n_a, n_b)
    size = m * n + 1
    counts = [1] + [0] * (size - 1)
    for i in range(1, m + 1):
        for k in range(size - 1, n + i - 1, -1):
            counts[k] -= counts[k - n - i]
        for k in range(i, size):
            counts[k] += counts[k - i]
    top = math.ceil(max(u, n_a * n_b - u))
    total = math.comb(m + n, m)
    return min(1.0, 2 * sum(counts[top:]) / total)


def mann_whitney(u: float, n_a: int, n_b: int, ties: float) -> float:
    """Exact for small untied samples, else normal with tie and continuity correction."""
    if ties == 0 and min(n_a, n_b) <= 8:
        return mann_whitney_exact(u, n_a, n_b)
    n = n_a + n_b
    spread = n_a * n_b / 12 * ((n + 1) - ties / (n * (n - 1)))
    if spread <= 0:
        return 1.0
    z = (max(u, n_a * n_b - u) - n_a * n_b / 2 - 0.5) / math.sqrt(spread)
    return min(1.0, math.erfc(z / math.sqrt(2)))


@F.pandas_udf(DoubleType())
def fisher_p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([fisher_two_sided(*map(int, row)) for row in zip(a, b, c, d)], dtype="float64")


@F.pandas_udf(DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    known = t.notna() & df.notna() & (df > 0)
    return pd.Series([student_two_sided(x, v) if k else None for x, v, k in zip(t, df, known)], dtype="float64")


@F.pandas_udf(DoubleType())
def mann_whitney_p(u: pd.Series, n_a: pd.Series, n_b: pd.Series, ties: pd.Series) -> pd.Series:
    rows = zip(u, n_a, n_b, ties)
    return pd.Series([mann_whitney(x, int(m), int(n), t) for x, m, n, t in rows], dtype="float64")
