"""Linear models from cross-product matrices.

One scan gives the matrix of (1, x, y) for every fold; ordinary least squares, the whole Lasso path
with cross-validation and every Ridge penalty are then small matrix work on the driver.  Only the
leave-one-out search of Ridge needs a second scan, which serves all penalties and folds together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import q
from ..functions.gram import gram_by_group

N_ALPHAS = 25
LASSO_SWEEPS = 2_000
LASSO_TOLERANCE = 1e-8


@dataclass
class Centred:
    """Moments of a row set around its own means, features scaled to unit deviation."""

    n: float
    mean: np.ndarray
    scale: np.ndarray
    y_mean: float
    zz: np.ndarray
    zy: np.ndarray
    yy: float

    def original(self, beta: np.ndarray) -> tuple[float, np.ndarray]:
        """Intercept and coefficients for unscaled features."""
        coef = beta / self.scale
        return float(self.y_mean - self.mean @ coef), coef


def centre(matrix: np.ndarray) -> Centred:
    """From the cross products of (1, x, y)."""
    n = matrix[0, 0]
    means = matrix[0, 1:] / n
    cross = matrix[1:, 1:] - n * np.outer(means, means)
    scale = np.sqrt(np.maximum(np.diag(cross)[:-1], 0.0) / n)
    scale = np.where(scale > 1e-12 * np.maximum(1.0, np.abs(means[:-1])), scale, 1.0)
    return Centred(n, means[:-1], scale, float(means[-1]), cross[:-1, :-1] / np.outer(scale, scale),
                   cross[:-1, -1] / scale, float(cross[-1, -1]))


def feature_grams(df: DataFrame, x: list[str], y: str = "y", group: str | None = None
                  ) -> dict[int, np.ndarray]:
    """Cross products of (1, x, y) per group, taken around the overall means for accuracy."""
    means = df.agg(*[F.avg(c).alias(c) for c in [*x, y]]).first()
    shifted = df.select(*([q(group)] if group else []),
                        *[(q(c) - F.lit(means[c] or 0.0)).alias(c) for c in [*x, y]])
    shift = np.array([means[c] or 0.0 for c in [*x, y]])
    return {g: Gram(m, shift) for g, m in sorted(gram_by_group(shifted, [*x, y], group).items())}


class Gram:
    """A cross-product matrix kept around a fixed shift; adds and subtracts like a row set."""

    def __init__(self, matrix: np.ndarray, shift: np.ndarray):
        self.matrix, self.shift = matrix, shift

    def __add__(self, other: "Gram") -> "Gram":
        return Gram(self.matrix + other.matrix, self.shift)

    def __sub__(self, other: "Gram") -> "Gram":
        return Gram(self.matrix - other.matrix, self.shift)

    def centred(self) -> Centred:
        c = centre(self.matrix)
        c.mean = c.mean + self.shift[:-1]
        c.y_mean += self.shift[-1]
        return c

    def squared_error(self, intercept: float, coef: np.ndarray) -> float:
        """Sum of squared errors of a linear rule on these rows."""
        inner = intercept + float(coef @ self.shift[:-1]) - self.shift[-1]
        v = np.concatenate([[-inner], -coef, [1.0]])
        return float(v @ self.matrix @ v)


def total(grams: dict[int, Gram]) -> Gram:
    parts = list(grams.values())
    out = parts[0]
    for g in parts[1:]:
        out = out + g
    return out


def solve_ols(c: Centred) -> np.ndarray:
    return np.linalg.lstsq(c.zz, c.zy, rcond=1e-12)[0]


def solve_ridge(c: Centred, alpha: float) -> np.ndarray:
    return np.linalg.solve(c.zz + alpha * np.eye(len(c.zy)), c.zy)


def solve_lasso(c: Centred, alpha: float, start: np.ndarray | None = None) -> np.ndarray:
    """Coordinate descent on (1/2n)|y - zb|² + alpha |b|₁."""
    gram, target = c.zz / c.n, c.zy / c.n
    beta = np.zeros(len(target)) if start is None else start.copy()
    diagonal = np.diag(gram)
    for _ in range(LASSO_SWEEPS):
        largest = 0.0
        for j in range(len(beta)):
            if diagonal[j] <= 0:
                continue
            rho = target[j] - gram[j] @ beta + diagonal[j] * beta[j]
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / diagonal[j]
            largest = max(largest, abs(new - beta[j]))
            beta[j] = new
        if largest <= LASSO_TOLERANCE * max(1.0, np.sqrt(c.yy / c.n)):
            break
    return beta


def alpha_grid(bounds: tuple[float, float]) -> np.ndarray:
    return np.logspace(np.log10(bounds[0]), np.log10(bounds[1]), N_ALPHAS)


def lasso_cv(grams: dict[int, Gram], alphas: np.ndarray) -> tuple[float, np.ndarray]:
    """Penalty with the least mean error over the held-out folds, and the error per penalty."""
    whole = total(grams)
    errors = np.zeros((len(grams), len(alphas)))
    order = np.argsort(-alphas)
    for i, held_out in enumerate(grams.values()):
        c, beta = (whole - held_out).centred(), None
        for a in order:
            beta = solve_lasso(c, alphas[a], beta)
            errors[i, a] = held_out.squared_error(*c.original(beta)) / held_out.matrix[0, 0]
    mean = errors.mean(0)
    return float(alphas[int(np.argmin(mean))]), mean


def ridge_loo(df: DataFrame, x: list[str], fits: dict[int, Centred], alphas: np.ndarray,
              fold: str | None = None) -> dict[int, np.ndarray]:
    """Leave-one-out squared error per fit and penalty, exact, in one scan.

    `fits` maps a fold number to the moments of the rows outside that fold; -1 means all rows.
    """
    spectra = {}
    for g, c in fits.items():
        values, vectors = np.linalg.eigh(c.zz)
        inverse = 1.0 / (np.maximum(values, 0.0)[:, None] + alphas[None, :])
        spectra[g] = (c, vectors, inverse, inverse * (vectors.T @ c.zy)[:, None])

    def partial_errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {g: np.zeros(len(alphas)) for g in spectra}
        for batch in batches:
            rows = batch[x].to_numpy(dtype=float)
            y, folds = batch["y"].to_numpy(dtype=float), batch["_fold"].to_numpy()
            for g, (c, vectors, inverse, weights) in spectra.items():
                use = folds != g
                u = ((rows[use] - c.mean) / c.scale) @ vectors
                error = (y[use] - c.y_mean)[:, None] - u @ weights
                leverage = 1.0 / c.n + (u * u) @ inverse
                sums[g] += ((error / np.maximum(1.0 - leverage, 1e-12)) ** 2).sum(0)
        for g, s in sums.items():
            yield pd.DataFrame({"g": g, "a": np.arange(len(s)), "v": s})

    flat = df.select(*x, "y", (q(fold) if fold else F.lit(-2)).cast("int").alias("_fold"))
    rows = (flat.mapInPandas(partial_errors, "g int, a int, v double")
            .groupBy("g", "a").agg(F.sum("v").alias("v")).collect())     # fits x penalties numbers
    out = {g: np.zeros(len(alphas)) for g in fits}
    for r in rows:
        out[r["g"]][r["a"]] = r["v"]
    return out


def linear_expression(x: list[str], intercept: float, coef: np.ndarray) -> Column:
    out = F.lit(float(intercept))
    for name, b in zip(x, coef):
        if b != 0:
            out = out + q(name) * F.lit(float(b))
    return out


def variance_inflation(c: Centred) -> np.ndarray:
    """Diagonal of the inverse correlation matrix; NaN where a column depends on the others."""
    p = len(c.zy)
    if p == 0:
        return np.array([])
    if p == 1:
        return np.array([1.0])
    r = c.zz / c.n
    out = np.empty(p)
    for j in range(p):
        rest = np.delete(np.arange(p), j)
        fit = np.linalg.lstsq(r[np.ix_(rest, rest)], r[rest, j], rcond=1e-10)[0]
        unexplained = r[j, j] - r[rest, j] @ fit
        out[j] = r[j, j] / unexplained if unexplained > 1e-10 else np.nan
    return out


def subset(c: Centred, keep: list[int]) -> Centred:
    k = np.array(keep, dtype=int)
    return Centred(c.n, c.mean[k], c.scale[k], c.y_mean, c.zz[np.ix_(k, k)], c.zy[k], c.yy)


def prune_by_vif(c: Centred, names: list[str], limit: float = 10.0) -> tuple[list[int], list[str]]:
    """Drop the undefined or largest inflation over the limit until none is left."""
    keep = [i for i in range(len(names)) if c.zz[i, i] / max(c.n - 1, 1) * c.scale[i] ** 2 > 1e-16]
    dropped = []
    while len(keep) > 1:
        vif = variance_inflation(subset(c, keep))
        if np.isnan(vif).any():
            worst = int(np.flatnonzero(np.isnan(vif))[0])
        elif vif.max() > limit:
            worst = int(np.argmax(vif))
        else:
            break
        dropped.append(names[keep[worst]])
        keep.pop(worst)
    return keep, dropped
