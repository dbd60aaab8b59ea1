"""Logistic regression of two classes by Newton steps that share scans.

Fits differ in the fold that they leave out and in C.  A scan gives loss, gradient and curvature of all of them, so a search
over folds and C takes as many scans as its slowest fit, the refits on all rows included.  The driver holds (features + 1)²
numbers a fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import q
from ..functions.tables import staged

MAX_SCANS = 100
TOLERANCE = 1e-13            # of the loss that a further step could still win


@dataclass
class LogisticFit:
    fold: int | None         # left out
    c: float
    intercept: float
    coefficients: list[float]
    converged: bool
    scans: int               # of all fits together


class _Run:
    """One fit on its way: features about their means, by their own deviation, which the penalty refers to."""

    def __init__(self, fold, c, moments):
        rows, weight, s, ss = moments
        self.fold, self.c = fold, c
        self.mean = s / max(weight, 1e-300)
        variance = np.maximum(ss / max(weight, 1e-300) - self.mean ** 2, 0.0) * rows / max(rows - 1, 1)
        self.scale = np.where(variance > 1e-24 * (1 + self.mean ** 2), np.sqrt(variance), 1.0)
        self.penalty = np.append(0.0, np.full(len(s), weight / (c * max(rows, 1))))
        self.beta, self.step, self.best = np.zeros(len(s) + 1), None, np.inf
        self.live, self.converged = weight > 0, False

    def take(self, sums: np.ndarray) -> None:
        """A step from loss, gradient and curvature at beta; half the last one where that did not help."""
        width = len(self.beta)
        loss = sums[0] + (self.penalty * self.beta ** 2).sum() / 2
        if self.step is not None and loss > self.best + 1e-12 * abs(self.best):
            self.step = self.step / 2
            self.beta = self.beta - self.step
            return
        self.best = loss
        gradient = sums[1:width + 1] + self.penalty * self.beta
        curvature = np.zeros((width, width))
        curvature[np.triu_indices(width)] = sums[width + 1:]
        curvature = curvature + np.triu(curvature, 1).T + np.diag(self.penalty + 1e-14)
        self.step = -np.linalg.lstsq(curvature, gradient, rcond=None)[0]
        self.beta = self.beta + self.step
        if -(gradient @ self.step) <= TOLERANCE * max(1.0, abs(loss)):
            self.live, self.converged = False, True

    def original(self) -> tuple[float, list[float]]:
        coef = self.beta[1:] / self.scale
        return float(self.beta[0] - coef @ self.mean), coef.tolist()


def _moments(table: DataFrame, x: list[str]) -> dict[int, tuple]:
    """Rows, weight, sums and squares by fold, about the means of all rows."""
    sums = [F.sum(q(c) * F.col("weight")) for c in x] + [F.sum(q(c) * q(c) * F.col("weight")) for c in x]
    found = table.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"), F.array(*sums).alias("s")).collect()
    return {r["fold"]: (r["n"], r["w"], np.array(r["s"][:len(x)]), np.array(r["s"][len(x):])) for r in found}


def _scan(table: DataFrame, x: list[str], runs: dict[int, _Run]) -> dict[int, np.ndarray]:
    width = len(x) + 1
    upper = np.triu_indices(width)
    asked = [(i, r.fold, r.mean, r.scale, r.beta) for i, r in runs.items()]

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {i: np.zeros(1 + width + len(upper[0])) for i, *_ in asked}
        for batch in batches:
            values, fold = batch[x].to_numpy(dtype=float), batch["fold"].to_numpy()
            y, w = batch["y"].to_numpy(dtype=float), batch["weight"].to_numpy(dtype=float)
            for i, out, mean, scale, beta in asked:
                rows = slice(None) if out is None else fold != out
                z = np.column_stack([np.ones(len(y[rows])), (values[rows] - mean) / scale])
                margin = z @ beta
                p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
                sums[i][0] += (w[rows] * (np.logaddexp(0, margin) - y[rows] * margin)).sum()
                sums[i][1:width + 1] += z.T @ (w[rows] * (p - y[rows]))
                sums[i][width + 1:] += ((z * (w[rows] * p * (1 - p))[:, None]).T @ z)[upper]
        for i, s in sums.items():
            yield pd.DataFrame({"i": i, "j": np.arange(len(s)), "v": s})

    got = table.mapInPandas(partial_sums, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    return {i: g.sort_values("j")["v"].to_numpy() for i, g in got.groupby("i")}


def fit_logistic(df: DataFrame, x: list[str], wanted: list[tuple[int | None, float]]) -> list[LogisticFit]:
    """Fits of y (0, 1) for each (fold left out, C).  Objective: summed weighted loss + weight / (2 C rows) * squared norm of the
    coefficients of features scaled to unit deviation.  df: x, y, weight and, if a fold is left out, fold."""
    fold = q("fold").cast("int") if "fold" in df.columns else F.lit(0)
    table = df.select(*[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(x)], F.col("y").cast("double"), F.col("weight").cast("double"), fold.alias("fold"))
    places = [f"x{i}" for i in range(len(x))]
    head = table.agg(*[F.avg(c).alias(c) for c in places]).first()
    centre = np.array([head[c] or 0.0 for c in places])
    table = staged(table.select(*[(F.col(c) - F.lit(float(m))).alias(c) for c, m in zip(places, centre)], "y", "weight", "fold"))
    parts = _moments(table, places)

    def outside(out):
        kept = [m for f, m in parts.items() if out is None or f != out]
        return [sum(v[k] for v in kept) for k in range(4)] if kept else [0, 0.0, np.zeros(len(x)), np.zeros(len(x))]

    runs, scans = {i: _Run(f, c, outside(f)) for i, (f, c) in enumerate(wanted)}, 0
    while scans < MAX_SCANS and any(r.live for r in runs.values()):
        sums = _scan(table, places, {i: r for i, r in runs.items() if r.live})
        scans += 1
        for i, s in sums.items():
            runs[i].take(s)
    table.unpersist()
    out = []
    for r in runs.values():
        intercept, coef = r.original()
        out.append(LogisticFit(r.fold, r.c, intercept - float(np.dot(coef, centre)), coef, r.converged, scans))
    return out
