"""Closed-form distribution tails and test statistics (published formulas).

Used on one-row aggregates on the driver; no data passes through here.
"""

from __future__ import annotations

import math


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution for integer ``dof``.

    Even dof: exp(-x/2) * sum_{i<dof/2} (x/2)^i / i!.
    Odd dof:  erfc(sqrt(x/2)) + exp(-x/2) * sum_{j=1}^{(dof-1)/2} (x/2)^(j-1/2) / Gamma(j+1/2).
    """
    if x is None or dof <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    h = x / 2.0
    if dof % 2 == 0:
        term, total = 1.0, 1.0
        for i in range(1, dof // 2):
            term *= h / i
            total += term
        return math.exp(-h) * total
    total = math.erfc(math.sqrt(h))
    for j in range(1, (dof - 1) // 2 + 1):
        total += math.exp((j - 0.5) * math.log(h) - h - math.lgamma(j + 0.5))
    return total


def dagostino_k2(n: int, g1: float, excess_kurtosis: float) -> tuple[float, float]:
    """D'Agostino-Pearson K² from biased skewness and excess kurtosis; p = exp(-K²/2)."""
    b2 = excess_kurtosis + 3.0
    y = g1 * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1.0 + math.sqrt(2.0 * (beta - 1.0))
    delta = 1.0 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2.0 / (w2 - 1.0))
    z1 = delta * math.asinh(y / alpha)
    e = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1.0) ** 2 * (n + 3) * (n + 5))
    x = (b2 - e) / math.sqrt(var)
    s = 6.0 * (n * n - 5 * n + 2) / ((n + 7.0) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3)))
    a = 6.0 + 8.0 / s * (2.0 / s + math.sqrt(1.0 + 4.0 / (s * s)))
    d = 1.0 + x * math.sqrt(2.0 / (a - 4.0))
    t = ((1.0 - 2.0 / a) / abs(d)) ** (1.0 / 3.0)
    z2 = (1.0 - 2.0 / (9.0 * a) - math.copysign(t, d)) / math.sqrt(2.0 / (9.0 * a))
    k2 = z1 * z1 + z2 * z2
    return k2, math.exp(-k2 / 2.0)
