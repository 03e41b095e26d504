"""Chi-square distribution function and quantiles (no statistics library is needed)."""

from __future__ import annotations

import math

import numpy as np


def chi2_cdf(x: float, k: int) -> float:
    """P(X <= x) for k degrees of freedom: the regularised lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, y = k / 2, x / 2
    if y > 700 + 10 * a:
        return 1.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= y / n
        total += term
    return min(1.0, total * math.exp(-y + a * math.log(y) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1.0
    while chi2_cdf(high, k) < p and high < 1e6:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return (low + high) / 2


def consistency(share: float, k: int) -> float:
    """Factor that makes the covariance of the central ``share`` of a normal sample unbiased."""
    return share / max(1e-9, chi2_cdf(chi2_quantile(share, k), k + 2))


def upper_triangle(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def symmetric(values: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros((k, k))
    for v, (i, j) in zip(values, upper_triangle(k), strict=True):
        out[i, j] = out[j, i] = v
    return out
