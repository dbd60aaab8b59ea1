"""Small numeric helpers for one daily series: ADF, ARIMA by conditional least squares, Holt.

They run inside grouped tasks, one (series, order) pair at a time; a series has one value per day.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from .pvalues import normal_cdf

STEPS = 60
ROOT_MARGIN = 1.001


# --- stationarity -------------------------------------------------------------------------------

def _least_squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    rest = y - x @ beta
    return beta, float(rest @ rest)


def adf_test(y: np.ndarray) -> tuple[float, float]:
    """Augmented Dickey-Fuller with a constant, lag by AIC; (0, 1) if it cannot be computed."""
    n = len(y)
    max_lag = min(n // 2 - 2, math.ceil(12.0 * (n / 100.0) ** 0.25))
    if max_lag < 0 or np.ptp(y) == 0:
        return 0.0, 1.0
    step = np.diff(y)

    def design(lag: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(skip, len(step))
        columns = [y[rows]] + [step[rows - i] for i in range(1, lag + 1)] + [np.ones(len(rows))]
        return np.column_stack(columns), step[rows]

    def information(lag: int) -> float:
        x, target = design(lag, max_lag)
        _, rss = _least_squares(x, target)
        return len(target) * math.log(max(rss, 1e-300) / len(target)) + 2 * x.shape[1]

    lag = min(range(max_lag + 1), key=information)
    x, target = design(lag, lag)
    beta, rss = _least_squares(x, target)
    dof = len(target) - x.shape[1]
    if dof <= 0 or rss <= 0:
        return 0.0, 1.0
    error = math.sqrt(rss / dof * np.linalg.pinv(x.T @ x)[0, 0])
    tau = float(beta[0] / error)
    return tau, mackinnon_p(tau)


def mackinnon_p(tau: float) -> float:
    """MacKinnon (1994) response surface, constant only."""
    if tau > 2.74:
        return 1.0
    if tau < -18.83:
        return 0.0
    if tau <= -1.61:
        return normal_cdf(float(np.polyval([0.038269, 1.4412, 2.1659], tau)))
    return normal_cdf(float(np.polyval([-0.010368, -0.12745, 0.93202, 1.7339], tau)))


def partial_autocorrelations(autocovariances: np.ndarray) -> np.ndarray:
    """Last Yule-Walker coefficient for every order (Durbin-Levinson); 1 at lag 0."""
    r = np.asarray(autocovariances, dtype=float)
    out = np.ones(len(r))
    phi, variance = np.zeros(0), r[0]
    for k in range(1, len(r)):
        last = (r[k] - phi @ r[k - 1:0:-1]) / variance if variance > 0 else 0.0
        phi = np.append(phi - last * phi[::-1], last)
        variance *= 1.0 - last * last
        out[k] = last
    return out


# --- ARIMA --------------------------------------------------------------------------------------

@dataclass
class Order:
    p: int
    d: int
    q: int
    seasonal: bool = False
    period: int = 7

    @property
    def constant(self) -> bool:
        return self.d == 0 and not self.seasonal

    @property
    def n_params(self) -> int:
        return self.p + self.q + (2 if self.seasonal else 0) + int(self.constant)


def _polynomials(order: Order, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """AR and MA polynomials with the leading 1, and the mean."""
    ar = np.concatenate([[1.0], -theta[:order.p]])
    ma = np.concatenate([[1.0], theta[order.p:order.p + order.q]])
    at = order.p + order.q
    if order.seasonal:
        gap = np.zeros(order.period - 1)
        ar = np.convolve(ar, np.concatenate([[1.0], gap, [-theta[at]]]))
        ma = np.convolve(ma, np.concatenate([[1.0], gap, [theta[at + 1]]]))
    return ar, ma, float(theta[-1]) if order.constant else 0.0


def _differenced(y: np.ndarray, order: Order) -> np.ndarray:
    w = np.diff(y, order.d) if order.d else y.copy()
    return w[order.period:] - w[:-order.period] if order.seasonal else w


def _residuals(w: np.ndarray, ar: np.ndarray, ma: np.ndarray, mean: float) -> np.ndarray:
    """Innovations with zeros before the start."""
    out = np.convolve(w - mean, ar)[:len(w)].tolist()
    lags = [(j, float(m)) for j, m in enumerate(ma) if j and m]
    if lags:
        for t in range(len(out)):
            e = out[t]
            for j, m in lags:
                if t >= j:
                    e -= m * out[t - j]
            out[t] = e
    return np.array(out)


def _stable(poly: np.ndarray) -> bool:
    trimmed = np.trim_zeros(poly, "b")
    if len(trimmed) < 2:
        return True
    return bool(np.all(np.abs(np.roots(trimmed[::-1])) > ROOT_MARGIN))


def _start(w: np.ndarray, order: Order) -> np.ndarray:
    """Hannan-Rissanen: a long autoregression gives innovations, a regression on both the start."""
    mean = w.mean() if order.constant else 0.0
    x = w - mean
    long = min(max(order.p + order.q + 2, 4), len(x) // 4)
    lagged = np.column_stack([x[long - i:len(x) - i] for i in range(1, long + 1)])
    beta, _ = _least_squares(lagged, x[long:])
    e = np.concatenate([np.zeros(long), x[long:] - lagged @ beta])
    first = max(order.p, order.q, 1)
    columns = ([x[first - i:len(x) - i] for i in range(1, order.p + 1)]
               + [e[first - j:len(e) - j] for j in range(1, order.q + 1)])
    theta = np.zeros(order.n_params)
    if columns:
        theta[:len(columns)] = _least_squares(np.column_stack(columns), x[first:])[0]
    if order.seasonal:
        at = order.p + order.q
        theta[at:at + 2] = 0.0, -0.5
    if order.constant:
        theta[-1] = mean
    return theta


def fit_arima(y: np.ndarray, order: Order, sample_from: int) -> dict | None:
    """Least squares on the innovations from index `sample_from` of the series; None if it fails.

    All candidates of a series are compared on the same days, so their AICs are comparable.
    """
    w = _differenced(y, order)
    lost = len(y) - len(w)
    skip = max(sample_from - lost, 0)
    n = len(w) - skip
    if n <= order.n_params + 2 or np.ptp(w) == 0:
        return None

    def innovations(theta):
        ar, ma, mean = _polynomials(order, theta)
        if not (_stable(ar) and _stable(ma)):
            return None
        return _residuals(w, ar, ma, mean)[skip:]

    theta = _start(w, order)
    dynamic = order.n_params - int(order.constant)
    for _ in range(20):
        current = innovations(theta)
        if current is not None:
            break
        theta[:dynamic] *= 0.7
    if current is None or not np.isfinite(current).all():
        return None
    cost, damping = float(current @ current), 1e-3
    for _ in range(STEPS if len(theta) else 0):
        jacobian = np.empty((n, len(theta)))
        for i in range(len(theta)):
            h = 1e-5 * max(1.0, abs(theta[i]))
            moved = theta.copy()
            moved[i] += h
            e = innovations(moved)
            if e is None:
                moved[i] -= 2 * h
                h, e = -h, innovations(moved)
            if e is None:
                return None
            jacobian[:, i] = (e - current) / h
        normal, gradient = jacobian.T @ jacobian, jacobian.T @ current
        improved = False
        for _ in range(8):
            try:
                step = np.linalg.solve(normal + damping * np.diag(np.diag(normal) + 1e-12), gradient)
            except np.linalg.LinAlgError:
                damping *= 10
                continue
            e = innovations(theta - step)
            if e is not None and float(e @ e) < cost:
                gain = cost - float(e @ e)
                theta, current, cost = theta - step, e, float(e @ e)
                damping, improved = damping / 5, gain > 1e-9 * cost
                break
            damping *= 5
        if not improved:
            break
    sigma2 = cost / n
    if not sigma2 > 0:
        return None
    aic = n * (math.log(2 * math.pi * sigma2) + 1.0) + 2 * (order.n_params + 1)
    return {"aic": aic, "theta": theta, "sigma2": sigma2}


def forecast_arima(y: np.ndarray, order: Order, theta: np.ndarray, steps: int) -> np.ndarray:
    w = _differenced(y, order)
    ar, ma, mean = _polynomials(order, theta)
    past, noise = list(w - mean), list(_residuals(w, ar, ma, mean))
    for _ in range(steps):
        value = -sum(a * past[-i] for i, a in enumerate(ar) if i and i <= len(past))
        value += sum(m * noise[-j] for j, m in enumerate(ma) if j and j <= len(noise))
        past.append(value)
        noise.append(0.0)
    future = np.array(past[len(w):]) + mean
    if order.seasonal:
        base = list(np.diff(y, order.d) if order.d else y)
        for v in future:
            base.append(v + base[-order.period])
        future = np.array(base[-steps:])
    for k in range(order.d, 0, -1):
        level = np.diff(y, k - 1)[-1] if k > 1 else y[-1]
        future = level + np.cumsum(future)
    return future


# --- Holt ---------------------------------------------------------------------------------------

def _holt_errors(y: list[float], alpha: float, beta: float, level: float, trend: float):
    sse = 0.0
    for value in y:
        error = value - level - trend
        sse += error * error
        level, before = level + trend + alpha * error, level
        trend += beta * (level - before - trend)
    return sse, level, trend


def holt(y: np.ndarray, steps: int) -> np.ndarray:
    """Additive-trend exponential smoothing; both weights by a grid that is refined around its best."""
    head = y[:min(10, len(y))]
    slope = np.polyfit(np.arange(len(head)), head, 1)[0] if len(head) > 1 else 0.0
    level, values = float(head.mean() - slope * (len(head) + 1) / 2.0), y.tolist()
    centre, width = (0.5, 0.5), 0.5
    for _ in range(6):
        grid = [(min(max(centre[0] + width * i / 4, 1e-4), 1.0), min(max(centre[1] + width * j / 4, 0.0), 1.0))
                for i in range(-4, 5) for j in range(-4, 5)]
        centre = min(grid, key=lambda ab: _holt_errors(values, *ab, level, float(slope))[0])
        width /= 3
    _, last, trend = _holt_errors(values, *centre, level, float(slope))
    return last + trend * np.arange(1, steps + 1)
