"""Statistical baseline: OLS or logit with diagnostics."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import pvalues
from ..functions.columns import q
from .association import ALPHA, shapiro_tests
from .linear import (Centred, centre, feature_grams, linear_expression, prune_by_vif, solve_ols, subset,
                     total, variance_inflation)
from .prep import ModelFrame, top_correlated

MAX_FEATURES = 30
VIF_LIMIT = 10.0
LOGIT_ITERATIONS = 200
COEFFICIENT_SCHEMA = "term string, coef double, std_error double, p_value double, vif double, dropped boolean"
STATS_SCHEMA = ("kind string, r2 double, adj_r2 double, breusch_pagan_stat double, "
                "breusch_pagan_p double, heteroscedastic boolean, residual_mean double, "
                "n long, note string")


@dataclass
class Baseline:
    kind: str
    terms: list[tuple] = field(default_factory=list)
    stats: dict[str, float | bool | int | None] = field(default_factory=dict)
    note: str = ""
    residuals: DataFrame | None = None
    normality: DataFrame | None = None

    def coefficients(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.terms, COEFFICIENT_SCHEMA)

    def stats_frame(self, spark: SparkSession) -> DataFrame:
        s = self.stats
        row = (self.kind, s.get("r2"), s.get("adj_r2"), s.get("bp_stat"), s.get("bp_p"),
               s.get("heteroscedastic"), s.get("residual_mean"), s.get("n"), self.note)
        return spark.createDataFrame([row], STATS_SCHEMA)


def vif_table(df: DataFrame, names: list[str]) -> DataFrame:
    """Variance inflation of every column from one cross-product pass; undefined is NULL."""
    c = total(feature_grams(df.withColumn("_zero", F.lit(0.0)), names, "_zero")).centred()
    rows = [(n, None if np.isnan(v) else float(v)) for n, v in zip(names, variance_inflation(c))]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


def vif_pruning(df: DataFrame, names: list[str], limit: float = VIF_LIMIT) -> DataFrame:
    """Which columns the pruning keeps and in which order the others go."""
    c = total(feature_grams(df.withColumn("_zero", F.lit(0.0)), names, "_zero")).centred()
    keep, dropped = prune_by_vif(c, names, limit)
    flat = [n for i, n in enumerate(names) if i not in keep and n not in dropped]
    rows = ([(names[i], True, None) for i in keep] + [(n, False, 0) for n in flat]
            + [(n, False, i + 1) for i, n in enumerate(dropped)])
    return df.sparkSession.createDataFrame(rows, "feature string, kept boolean, drop_order int")


@dataclass
class OlsFit:
    names: list[str]
    intercept: float
    coef: np.ndarray
    errors: np.ndarray          # intercept first
    p_values: np.ndarray
    r2: float
    adj_r2: float
    n: int
    moments: Centred

    def expression(self, columns: list[str]):
        return linear_expression(columns, self.intercept, self.coef)


def fit_ols(c: Centred, names: list[str]) -> OlsFit:
    """Least squares with t-tests from the moments of the rows."""
    beta = solve_ols(c)
    intercept, coef = c.original(beta)
    p, n = len(names), int(round(c.n))
    rss = max(c.yy - float(beta @ c.zy), 0.0)
    dof = n - p - 1
    sigma2 = rss / dof if dof > 0 else float("nan")
    inverse = np.linalg.pinv(c.zz, rcond=1e-12) / np.outer(c.scale, c.scale)
    at_zero = 1.0 / c.n + float(c.mean @ inverse @ c.mean)
    errors = np.sqrt(sigma2 * np.concatenate([[at_zero], np.diag(inverse)]))
    values = np.concatenate([[intercept], coef])
    p_values = np.array([pvalues.t_two_sided(b / e, dof) if e > 0 and dof > 0 else float("nan")
                         for b, e in zip(values, errors)])
    r2 = 1.0 - rss / c.yy if c.yy > 0 else 0.0
    return OlsFit(list(names), intercept, coef, errors, p_values, r2,
                  1.0 - (1.0 - r2) * (n - 1) / dof if dof > 0 else float("nan"), n, c)


def ols(df: DataFrame, x: list[str], y: str) -> OlsFit:
    return fit_ols(total(feature_grams(df.select(*[q(c) for c in [*x, y]]), x, y)).centred(), x)


def breusch_pagan(df: DataFrame, x: list[str], y: str, fit: OlsFit) -> tuple[float, float, float]:
    """LM statistic and p of squared residuals on the same features, and the residual mean.

    The squared residuals enter through p + 3 sums; the feature moments are those of the fit.
    """
    residual = q(y) - fit.expression(x)
    square = residual * residual
    row = df.agg(F.count(F.lit(1)).alias("n"), F.avg(residual).alias("r"), F.avg(square).alias("m"),
                 F.var_pop(square).alias("v"), *[F.covar_pop(square, q(c)).alias(f"c{i}")
                                                for i, c in enumerate(x)]).first()
    n, c = row["n"], fit.moments
    if not x or not row["v"]:
        return 0.0, 1.0, row["r"]
    cross = np.array([row[f"c{i}"] * n for i in range(len(x))]) / c.scale
    explained = float(cross @ np.linalg.lstsq(c.zz, cross, rcond=1e-12)[0])
    lm = n * explained / (row["v"] * n)
    return lm, pvalues.chi2_sf(lm, len(x)), row["r"]


def ols_baseline(frame: ModelFrame, grams: Centred | None = None) -> Baseline:
    """Top columns by correlation, VIF pruning, OLS, Breusch-Pagan, Shapiro-Wilk on residuals."""
    train = frame.train
    x, name_of = frame.x, dict(zip(frame.x, frame.names))
    chosen = top_correlated(train, x, "y", MAX_FEATURES) if len(x) > MAX_FEATURES else x
    whole = total(feature_grams(train, x, "y")).centred() if grams is None else grams
    c = subset(whole, [x.index(n) for n in chosen])
    keep, dropped = prune_by_vif(c, chosen, VIF_LIMIT)
    kept = [chosen[i] for i in keep]
    fit = fit_ols(subset(c, keep), kept)
    vif = variance_inflation(fit.moments)
    lm, lm_p, mean = breusch_pagan(train, kept, "y", fit)
    terms = [("const", fit.intercept, float(fit.errors[0]), float(fit.p_values[0]), None, False)]
    terms += [(name_of[n], float(fit.coef[i]), float(fit.errors[i + 1]), float(fit.p_values[i + 1]),
               None if np.isnan(vif[i]) else float(vif[i]), False) for i, n in enumerate(kept)]
    terms += [(name_of[n], None, None, None, None, True) for n in dropped]
    residuals = train.select("row_key", fit.expression(kept).alias("fitted"),
                             (F.col("y") - fit.expression(kept)).alias("residual"))
    normality = shapiro_tests(residuals.withColumnRenamed("residual", "residuals"), ["residuals"],
                              ["row_key"], n_rows=frame.n_train)
    stats = {"r2": fit.r2, "adj_r2": fit.adj_r2, "bp_stat": lm, "bp_p": lm_p,
             "heteroscedastic": lm_p < ALPHA, "residual_mean": mean, "n": fit.n}
    return Baseline("ols", terms, stats, "", residuals, normality)


def logit(df: DataFrame, x: list[str], y: str = "y"):
    """Unpenalised logistic regression with Wald tests."""
    vectors = VectorAssembler(inputCols=x, outputCol="features").transform(df).select(
        "features", q(y).cast("double").alias("label"))
    return GeneralizedLinearRegression(family="binomial", link="logit", maxIter=LOGIT_ITERATIONS,
                                       featuresCol="features", labelCol="label").fit(vectors)


def logit_baseline(frame: ModelFrame) -> Baseline:
    train, x, name_of = frame.train, frame.x, dict(zip(frame.x, frame.names))
    chosen = top_correlated(train, x, "y", MAX_FEATURES) if len(x) > MAX_FEATURES else x
    c = total(feature_grams(train, chosen, "y")).centred()
    keep, dropped = prune_by_vif(c, chosen, VIF_LIMIT)
    kept = [chosen[i] for i in keep]
    vif = variance_inflation(subset(c, keep))
    try:
        model = logit(train, kept)
        summary = model.summary
        errors, p_values = list(summary.coefficientStandardErrors), list(summary.pValues)
        deviance, null = summary.deviance, summary.nullDeviance
        if not np.isfinite(p_values).all() or deviance < 1e-6 * null:
            raise ArithmeticError("the classes are separated")
    except Exception as problem:
        return Baseline("skipped", note=f"logit did not converge: {type(problem).__name__}")
    coef = [float(model.intercept), *[float(b) for b in model.coefficients]]
    order = [len(kept), *range(len(kept))]                       # the intercept comes last in Spark
    terms = [("const" if i == 0 else name_of[kept[i - 1]], coef[i], float(errors[o]), float(p_values[o]),
              None if i == 0 or np.isnan(vif[i - 1]) else float(vif[i - 1]), False)
             for i, o in enumerate(order)]
    terms += [(name_of[n], None, None, None, None, True) for n in dropped]
    return Baseline("logit", terms, {"r2": 1.0 - deviance / null if null else None, "n": frame.n_train})
