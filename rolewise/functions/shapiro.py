"""Shapiro-Wilk test of normality by Royston's approximation (1995), 3 to 5,000 values."""

from __future__ import annotations

import math

import numpy as np

from .pvalues import normal_quantile, normal_sf


def _weights(n: int) -> np.ndarray:
    if n == 3:
        return np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    m = np.array([normal_quantile((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    norm = float(m @ m)
    u = 1.0 / math.sqrt(n)
    last = m[-1] / math.sqrt(norm) + np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, 0.0], u)
    a = np.empty(n)
    if n <= 5:
        scale = math.sqrt((norm - 2 * m[-1] ** 2) / (1 - 2 * last ** 2))
        a[1:-1] = m[1:-1] / scale
    else:
        before = (m[-2] / math.sqrt(norm)
                  + np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0], u))
        scale = math.sqrt((norm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last ** 2 - 2 * before ** 2))
        a[2:-2] = m[2:-2] / scale
        a[1], a[-2] = -before, before
    a[0], a[-1] = -last, last
    return a


def shapiro_wilk(values: np.ndarray) -> tuple[float, float] | None:
    """(W, p); None below three values, (1, 1) without any spread."""
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    if n < 3:
        return None
    centred = x - x.mean()
    spread = float(centred @ centred)
    if spread <= 1e-300 or x[-1] == x[0]:
        return 1.0, 1.0
    w = min(1.0, float(_weights(n) @ x) ** 2 / spread)
    if n == 3:
        p = 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return w, min(1.0, max(0.0, p))
    y = math.log(max(1.0 - w, 1e-300))
    if n <= 11:
        gamma = -2.273 + 0.459 * n
        if y >= gamma:
            return w, 1e-99
        y = -math.log(gamma - y)
        mean = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)
        deviation = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        log_n = math.log(n)
        mean = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], log_n)
        deviation = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], log_n))
    return w, float(normal_sf((y - mean) / deviation))
