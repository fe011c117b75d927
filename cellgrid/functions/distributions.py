"""Distribution functions that Spark lacks, as plain numbers: normal, Student, binomial and Kendall."""

from __future__ import annotations

import math
from functools import lru_cache


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    total = d
    for m in range(1, 400):
        for term in (
            m * (b - m) * x / ((a - 1 + 2 * m) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m)),
        ):
            d, c = 1 / (1 + term * d), 1 + term / c
            total *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * total


def t_two_sided(t: float, df: float) -> float:
    """Probability of a Student value at least as far from zero."""
    return incomplete_beta(df / 2, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """Student quantile by bisection, for p from 0.5 on."""
    low, high = 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        if 1 - t_two_sided(mid, df) / 2 < p:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def binomial_pmf(k: int, n: int, p: float) -> float:
    return math.comb(n, k) * p**k * (1 - p) ** (n - k)


@lru_cache(maxsize=64)
def inversions(n: int) -> tuple[int, ...]:
    """How many orders of n values have 0, 1, ... inversions."""
    ways = [1]
    for k in range(2, n + 1):
        longer = [0] * (len(ways) + k - 1)
        for at, w in enumerate(ways):
            for more in range(k):
                longer[at + more] += w
        ways = longer
    return tuple(ways)


def kendall_exact(n: int, s: int) -> float:
    """Probability of a sum of signs at least as far from zero, over all orders of n different values."""
    if n < 2:
        return 1.0
    pairs = n * (n - 1) // 2
    few = (pairs - abs(s)) // 2
    return min(1.0, 2 * sum(inversions(n)[: few + 1]) / math.factorial(n))
