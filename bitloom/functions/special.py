"""Tail probabilities: erfc as an expression, chi-square survival functions and cut-offs."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_FAR = 38.7  # beyond this erfc is 0 in double precision by far, and so is the exponential it is made of


def log_erfc(x: float) -> float:
    """The logarithm of erfc for x >= 0, also where erfc itself is too small for a double."""
    if x < 20:
        return math.log(math.erfc(x))
    f = 0.0
    for i in range(60, 0, -1):  # continued fraction from its far end
        f = i / 2 / (x + f)
    return -x * x - math.log(x + f) - math.log(math.pi) / 2


@cache
def erfc_polynomial() -> tuple[float, ...]:
    """Coefficients, highest first, of log(erfc(x) / t) + x² in v, with t = 2 / (2 + x) mapped onto v in [-1, 1]."""
    low = 2 / (2 + _FAR)
    v = np.cos(np.pi * (np.arange(28) + 0.5) / 28)
    t = (v + 1) / 2 * (1 - low) + low
    x = 2 / t - 2
    values = np.array([log_erfc(a) - math.log(b) + a * a for a, b in zip(x, t)])
    cheb = np.polynomial.chebyshev.chebfit(v, values, 27)
    return tuple(float(c) for c in np.polynomial.chebyshev.cheb2poly(cheb)[::-1])


def erfc_sql(x: str) -> str:
    """erfc of the SQL expression ``x`` >= 0 as text both Spark and other engines evaluate; relative error below 1e-12."""
    low = 2 / (2 + _FAR)
    t = f"(2e0/(2e0+({x})))"
    v = f"(({t}-{low:.17e})*{2 / (1 - low):.17e}-1e0)"
    horner = f"{erfc_polynomial()[0]:.17e}"
    for c in erfc_polynomial()[1:]:
        horner = f"({horner}*{v}+({c:.17e}))"
    return f"(case when ({x}) > {_FAR:.1f} then 0e0 else {t}*exp({horner}-({x})*({x})) end)"


def erfc(x: Column) -> Column:
    """erfc of a column of values >= 0, inside whole-stage code; null and NaN stay as they are."""
    low = 2 / (2 + _FAR)
    t = F.lit(2.0) / (F.lit(2.0) + x)
    v = (t - low) * (2 / (1 - low)) - 1.0
    horner = F.lit(erfc_polynomial()[0])
    for c in erfc_polynomial()[1:]:
        horner = horner * v + c
    return F.when(x <= _FAR, t * F.exp(horner - x * x)).when(x > _FAR, F.when(F.isnan(x), x).otherwise(F.lit(0.0)))


def chi2_sf1(t: Column) -> Column:
    """Survival function of chi-square with 1 degree of freedom; 1 for t <= 0."""
    return F.when(t <= 0, F.lit(1.0)).otherwise(erfc(F.sqrt(t / 2)))


def chi2_sf3(t: Column) -> Column:
    """Survival function of chi-square with 3 degrees of freedom; 1 for t <= 0."""
    h = F.sqrt(t / 2)
    return F.when(t <= 0, F.lit(1.0)).otherwise(erfc(h) + F.exp(-t / 2) * h * (2 / math.sqrt(math.pi)))


def erfc_of(x: np.ndarray) -> np.ndarray:
    """erfc of an array."""
    return np.fromiter(map(math.erfc, x.ravel().tolist()), float, x.size).reshape(x.shape)


def chi2_sf(x: float, k: float) -> float:
    """Survival function for any k > 0 by the regularised incomplete gamma function; NaN for x < 0 or k <= 0."""
    if not (x >= 0 and k > 0):
        return math.nan
    a, h = k / 2, x / 2
    if h == 0:
        return 1.0
    if h < a + 1:  # power series of the lower function
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= h / n
            total += term
        return 1 - total * math.exp(-h + a * math.log(h) - math.lgamma(a))
    # continued fraction of the upper one, evaluated from its far end
    depth = 200 + int(10 * math.sqrt(h))
    f = 0.0
    for i in range(depth, 0, -1):
        f = i * (i - a) / (h + 2 * i + 1 - a - f)
    return math.exp(-h + a * math.log(h) - math.lgamma(a)) / (h + 1 - a - f)


def _least(log10_p: float, log_tail: Callable[[float], float]) -> float:
    low, high, wanted = 0.0, 20.0 + 6 * max(log10_p, 0.0), -log10_p * math.log(10)
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (low, mid) if log_tail(mid) <= wanted else (mid, high)
    return high


@cache
def statistic_cut(log10_p: float) -> float:
    """The least T with a tail of chi-square with 1 degree of freedom of at most 10^-log10_p."""
    return _least(log10_p, lambda t: log_erfc(math.sqrt(t / 2)))


@cache
def statistic_cut3(log10_p: float) -> float:
    """As :func:`statistic_cut` with 3 degrees of freedom."""

    def log_tail(t: float) -> float:
        h = math.sqrt(t / 2)
        one, rest = log_erfc(h), -t / 2 + math.log(max(h, 1e-300) * 2 / math.sqrt(math.pi))
        return max(one, rest) + math.log1p(math.exp(-abs(one - rest)))

    return _least(log10_p, log_tail)


def r2_cut(log10_p: float, n: int) -> float:
    """The least r² of ``n`` samples whose p-value is at most 10^-log10_p."""
    return 1 - math.exp(-statistic_cut(log10_p) / n) if n else 1.0
