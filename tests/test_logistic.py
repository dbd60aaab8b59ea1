"""Logistic fits that share scans: closed forms, Newton on the driver, folds and C, scans counted, hard cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolewise.operators import logistic, models as m


def frame(spark, x, y, w=None, folds=3):
    names = [f"x{j}" for j in range(len(x[0]))]
    rows = [(*map(float, r), float(t), float(v), i % folds, i) for i, (r, t, v) in enumerate(zip(x, y, np.ones(len(y)) if w is None else w))]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", y double, weight double, fold int, row_key long").repartition(4), names


def newton(x, y, w, c):
    scale = np.sqrt(np.cov(x.T, aweights=w, ddof=0).reshape(x.shape[1], -1).diagonal() * len(y) / (len(y) - 1))
    z, b = np.column_stack([np.ones(len(y)), x / scale]), np.zeros(x.shape[1] + 1)
    penalty = np.diag([0.0, *[w.sum() / (c * len(y))] * x.shape[1]])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ b))
        b = b - np.linalg.solve(z.T @ (z * (w * p * (1 - p))[:, None]) + penalty, z.T @ (w * (p - y)) + penalty @ b)
    return b[0], b[1:] / scale


def test_all_folds_and_penalties_from_shared_scans(spark, rng):
    x = rng.normal(size=(240, 3)) * [1, 50, 0.01] + [0, 1000, 0]
    y, w = (rng.random(240) < 1 / (1 + np.exp(-x[:, 0] - 40 * x[:, 2]))).astype(float), rng.choice([0.5, 2.0], 240)
    df, names = frame(spark, x, y, w)
    wanted = [(f, c) for f in (None, 0, 1, 2) for c in (0.1, 1.0, 10.0)]
    fits = logistic.fit_logistic(df, names, wanted)
    assert [(f.fold, f.c) for f in fits] == wanted and all(f.converged for f in fits)
    assert fits[0].scans <= 10                                      # twelve fits
    for fit in fits:
        kept = np.arange(240) % 3 != (-1 if fit.fold is None else fit.fold)
        intercept, coef = newton(x[kept], y[kept], w[kept], fit.c)
        assert fit.intercept == pytest.approx(intercept, rel=1e-6, abs=1e-8) and fit.coefficients == pytest.approx(list(coef), rel=1e-6, abs=1e-9)


def test_one_binary_feature_has_the_log_odds(spark):
    x = [[i % 2] for i in range(400)]
    y = [float(i % 10 < (3 if i % 2 else 6)) for i in range(400)]
    df, names = frame(spark, x, y)
    fit = logistic.fit_logistic(df, names, [(None, 1e12)])[0]
    share = [np.mean([t for (v,), t in zip(x, y) if v == side]) for side in (0, 1)]
    odds = [np.log(s / (1 - s)) for s in share]
    assert fit.intercept == pytest.approx(odds[0], rel=1e-8) and fit.coefficients[0] == pytest.approx(odds[1] - odds[0], rel=1e-8)


@pytest.mark.parametrize("case", ["separated", "constant", "one class", "copies"])
def test_hard_cases(spark, rng, case):
    x = rng.normal(size=(60, 2))
    y = (x[:, 0] > 0).astype(float)
    if case == "constant":
        x[:, 1] = 7.0
    if case == "one class":
        y[:] = 1.0
    if case == "copies":
        x[:, 1] = x[:, 0]
    df, names = frame(spark, x, y)
    fit = logistic.fit_logistic(df, names, [(None, 1.0)])[0]
    assert fit.converged and np.isfinite([fit.intercept, *fit.coefficients]).all()
    if case == "constant":
        assert fit.coefficients[1] == 0.0
    if case == "copies":
        assert fit.coefficients[0] == pytest.approx(fit.coefficients[1])


def test_search_takes_few_scans_and_refits(spark, rng, monkeypatch):
    x = rng.normal(size=(300, 2))
    df, names = frame(spark, x, (x[:, 0] + rng.normal(size=300) > 0).astype(int))
    scans, scan = [], logistic._scan
    monkeypatch.setattr(logistic, "_scan", lambda *a: scans.append(len(a[2])) or scan(*a))
    fitted = m.fit_all([m.LOGISTIC], "classification", df, names, m.Settings(search=True), 2, 300)[0]
    assert scans[0] == 12 and len(scans) <= 10 and fitted.model.fold is None and fitted.parameters["C"] in (0.1, 1.0, 10.0)
    alone = logistic.fit_logistic(df, names, [(None, fitted.parameters["C"])])[0]
    assert fitted.model.coefficients == pytest.approx(alone.coefficients)
    out = fitted.apply(df)
    assert out.filter((F.col("score") > 0.5) != (F.col("prediction") == 1)).count() == 0
