"""Tail probabilities for the few scalar test statistics of a run (no scipy in the environment)."""

from __future__ import annotations

import math
from statistics import NormalDist

_NORMAL = NormalDist()
_TINY = 1e-300
_EPS = 1e-16


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def normal_sf(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def normal_quantile(p: float) -> float:
    return _NORMAL.inv_cdf(p)


def _lentz(terms, first: float) -> float:
    """Continued fraction first + a1/(b1 + a2/(b2 + ...)) by the modified Lentz method."""
    f = first if abs(first) > _TINY else _TINY
    c, d = f, 0.0
    for a, b in terms:
        d = b + a * d
        c = b + a / c
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = c if abs(c) > _TINY else _TINY
        step = c * d
        f *= step
        if abs(step - 1.0) < _EPS:
            break
    return f


def gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * _EPS:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * scale)
    terms = ((-i * (i - a), x + 2 * i + 1 - a) for i in range(1, 100_000))
    return scale / _lentz(terms, x + 1 - a)


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_inc(b, a, 1 - x)

    def terms():
        m = 0
        while m < 100_000:
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
            m += 1
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    log_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                 + a * math.log(x) + b * math.log1p(-x))
    return math.exp(log_front) / a / _lentz(terms(), 1.0)


def chi2_sf(x: float, dof: float) -> float:
    return gamma_q(dof / 2.0, x / 2.0)


def f_sf(f: float, d1: float, d2: float) -> float:
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def t_two_sided(t: float, dof: float) -> float:
    if math.isinf(t):
        return 0.0
    return beta_inc(dof / 2.0, 0.5, dof / (dof + t * t))
