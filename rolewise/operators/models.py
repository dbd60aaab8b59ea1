"""Candidate models: what they are, how they are fitted, what they predict."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import q, to_long
from ..functions.tables import in_parallel
from .boosting import MAX_LEAVES, Boosted, boost, boost_all
from .evaluate import class_metrics, confusion_counts, regression_metrics
from .forest import Forest, fit_forest
from .linear import (alpha_grid, feature_grams, lasso_cv, linear_expression, ridge_loo, solve_lasso,
                     solve_ols, solve_ridge, total)
from .logistic import LogisticFit, fit_logistic
from .prep import with_folds

# Fixed display names of the candidates.
LINEAR, RIDGE, LASSO = "Linear Regression", "Ridge (CV)", "Lasso (CV)"
LOGISTIC, FOREST, BOOSTING = "Logistic Regression", "Random Forest", "Gradient Boosting"
REGRESSORS = (LINEAR, RIDGE, LASSO, FOREST, BOOSTING)
CLASSIFIERS = (LOGISTIC, FOREST, BOOSTING)
TREES = (FOREST, BOOSTING)

SEED = 42
# Fixed values of the two searches (the configured value is always added).
NEAR_DEPTHS = (8, 16)
NEAR = {BOOSTING: {"learning_rate": (0.03, 0.3), "max_iter": (50, 200)}, LOGISTIC: {"C": (0.1, 10.0)}}
WIDE = {
    FOREST: {"n_estimators": (50, 100, 300, 400, 500), "max_depth": (4, 8, 12, 16, 24),
             "min_samples_leaf": (1, 2, 4, 8), "max_features": ("sqrt", "log2", None)},
    BOOSTING: {"learning_rate": (0.01, 0.03, 0.05, 0.2, 0.3), "max_iter": (50, 150, 200, 300),
               "max_depth": (None, 3, 5, 8), "max_leaf_nodes": (15, 31, 63)},
    LOGISTIC: {"C": (0.01, 0.03, 0.1, 3.0, 10.0, 30.0)},
}
SEARCH_FOLDS = 3
SEARCH_DRAWS = 10
INNER_FOLDS = 5


@dataclass
class Settings:
    ridge_alphas: tuple[float, float] = (1e-3, 1e3)
    lasso_alphas: tuple[float, float] = (1e-3, 1e2)
    logistic_c: float = 1.0
    forest_trees: int = 200
    forest_depth: int | None = None
    boosting_rate: float = 0.1
    boosting_rounds: int = 100
    search: bool = False
    broad_search: bool = False
    parallelism: int = 4


@dataclass
class Fitted:
    name: str
    apply: Callable[[DataFrame], DataFrame]      # adds `prediction`, and `score` for two classes
    parameters: dict[str, object] = field(default_factory=dict)
    model: object = None


def available_models() -> list[str]:
    return list(dict.fromkeys([*REGRESSORS, *CLASSIFIERS]))


def candidates(task: str, wanted: list[str] | None = None) -> list[str]:
    """Models of the task that were asked for; all of them if none of the names applies."""
    names = REGRESSORS if task == "regression" else CLASSIFIERS
    return [n for n in names if n in (wanted or names)] or list(names)


def assembled(df: DataFrame, x: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=x, outputCol="features").transform(df)


# --- linear models ------------------------------------------------------------------------------

def fit_linear_family(train: DataFrame, x: list[str], names: list[str], settings: Settings,
                      fold: str = "fold") -> list[Fitted]:
    """Least squares, Ridge and Lasso from one scan of fold-wise cross products, plus one for Ridge."""
    if not names:
        return []
    grams = feature_grams(train, x, "y", fold)
    c = total(grams).centred()
    out = []
    for name in names:
        if name == LINEAR:
            beta, parameters = solve_ols(c), {}
        elif name == RIDGE:
            alphas = alpha_grid(settings.ridge_alphas)
            errors = ridge_loo(train, x, {-1: c}, alphas)[-1]
            alpha = float(alphas[int(np.argmin(errors))])
            beta, parameters = solve_ridge(c, alpha), {"alpha": round(alpha, 6)}
        else:
            alpha, _ = lasso_cv(grams, alpha_grid(settings.lasso_alphas))
            beta, parameters = solve_lasso(c, alpha), {"alpha": round(alpha, 6)}
        out.append(linear_model(name, x, *c.original(beta), parameters))
    return out


def linear_model(name: str, x: list[str], intercept: float, coef: np.ndarray, parameters: dict) -> Fitted:
    rule = linear_expression(x, intercept, coef)
    return Fitted(name, lambda df: df.withColumn("prediction", rule), parameters,
                  {"intercept": intercept, "coef": coef})


def cross_validate_linear(df: DataFrame, x: list[str], names: list[str], settings: Settings,
                          n_folds: int) -> DataFrame:
    """MAE, RMSE and R² per model and fold, with every penalty search done inside the fold.

    One scan gives cross products by (fold, inner fold), a second serves the Ridge searches of all
    folds, a third scores all models on their held-out rows.
    """
    inner = F.pmod(F.xxhash64(F.lit(SEED + 31), "row_key"), F.lit(INNER_FOLDS))
    cells = feature_grams(df.withColumn("_cell", q("fold") * INNER_FOLDS + inner), x, "y", "_cell")
    folds = sorted({g // INNER_FOLDS for g in cells})
    outside = {f: {} for f in folds}                 # fold -> inner fold -> rows outside the fold
    for f in folds:
        for cell, gram in cells.items():
            if cell // INNER_FOLDS != f:
                i = cell % INNER_FOLDS
                outside[f][i] = outside[f][i] + gram if i in outside[f] else gram
    fits = {f: total(outside[f]).centred() for f in folds}
    alphas = alpha_grid(settings.ridge_alphas)
    loo = ridge_loo(df, x, fits, alphas, "fold") if RIDGE in names else {}
    rules = {n: F.lit(None).cast("double") for n in names}
    for name in names:
        for f in folds:
            if name == LINEAR:
                beta = solve_ols(fits[f])
            elif name == RIDGE:
                beta = solve_ridge(fits[f], float(alphas[int(np.argmin(loo[f]))]))
            else:
                alpha, _ = lasso_cv(outside[f], alpha_grid(settings.lasso_alphas))
                beta = solve_lasso(fits[f], alpha)
            rule = linear_expression(x, *fits[f].original(beta))
            rules[name] = F.when(F.col("fold") == f, rule).otherwise(rules[name])
    scored = to_long(df, rules, ["fold", "y"], "model", "prediction")
    return regression_metrics(scored, by=["model", "fold"])


# --- MLlib models -------------------------------------------------------------------------------

def _logistic(s: Settings, n_rows: int):
    """L2 penalty of strength 1 / C on the summed loss over standardised features."""
    return LogisticRegression(featuresCol="features", labelCol="y", weightCol="weight", maxIter=2000,
                              tol=1e-8, regParam=1.0 / (s.logistic_c * max(n_rows, 1)),
                              elasticNetParam=0.0, standardization=True)


# --- trees --------------------------------------------------------------------------------------

def fit_trees(name: str, task: str, train: DataFrame, x: list[str], s: Settings, n_classes: int, n_rows: int) -> Fitted:
    """A forest or a boosted model as configured, or the best of the search."""
    rows = train.select(*[q(c) for c in x], "y", "weight", "row_key")
    choice = _chosen(name, s)
    if s.search:
        choice |= _searched(name, task, rows, x, s, n_classes, n_rows)
    model, apply = _grown(name, task, rows, x, choice, n_classes, n_rows)
    return Fitted(name, apply, {**choice, **({"n_iter": len(model.rounds)} if name == BOOSTING else {})}, model)


def fit_boosted_folds(task: str, table: DataFrame, x: list[str], s: Settings, n_classes: int, n_rows: int, n_folds: int) -> dict[int, Fitted]:
    """Boosted models as configured, each without a fold of the table, from the same passes; n_rows: of a fit."""
    choice = _chosen(BOOSTING, s)
    trains = [table.filter(F.col("fold") != f).select(*[q(c) for c in x], "y", "weight", "row_key") for f in range(n_folds)]
    models = boost_all(trains, x, task, n_classes, n_rows, choice["learning_rate"], choice["max_iter"], choice["max_leaf_nodes"])
    return {f: Fitted(BOOSTING, partial(_apply_boosted, m, x, task, n_classes), {**choice, "n_iter": len(m.rounds)}, m) for f, m in enumerate(models)}


def _chosen(name: str, s: Settings) -> dict[str, object]:
    return {**_configured(name, s), **({"max_leaf_nodes": MAX_LEAVES} if name == BOOSTING else {})}


def _grown(name: str, task: str, rows: DataFrame, x: list[str], choice: dict, n_classes: int, n_rows: int):
    if name == BOOSTING:
        model = _boosted(task, rows, x, choice, n_classes, n_rows)
        return model, partial(_apply_boosted, model, x, task, n_classes)
    model = fit_forest(rows, x, task, n_classes, n_rows, choice["n_estimators"], choice["max_depth"], choice.get("min_samples_leaf", 1),
                       choice.get("max_features", None if task == "regression" else "sqrt"), SEED)
    return model, partial(_apply_forest, model, x, task, n_classes)


def _apply_forest(model: Forest, x: list[str], task: str, n_classes: int, df: DataFrame) -> DataFrame:
    out, shares = model.outputs(df, x), F.col("_outputs")
    if task == "regression":
        return out.select(*map(q, df.columns), shares[0].alias("prediction"))
    best = (F.array_position(shares, F.array_max(shares)) - 1).cast("double").alias("prediction")
    return out.select(*map(q, df.columns), best, *([shares[1].alias("score")] if n_classes == 2 else []))


def _boosted(task: str, rows: DataFrame, x: list[str], choice: dict, n_classes: int, n_rows: int) -> Boosted:
    return boost(rows, x, task, n_classes, n_rows, choice["learning_rate"], choice["max_iter"],
                 choice.get("max_leaf_nodes", MAX_LEAVES), choice.get("max_depth"))


def _apply_boosted(model: Boosted, x: list[str], task: str, n_classes: int, df: DataFrame) -> DataFrame:
    kept, raw = df.columns, F.col("_outputs")
    out = df.withColumn("_outputs", model.raw(x))
    if task == "regression":
        return out.select(*map(q, kept), raw[0].alias("prediction"))
    if n_classes == 2:
        score = 1 / (1 + F.exp(-raw[0]))
        return out.select(*map(q, kept), (raw[0] > 0).cast("double").alias("prediction"), score.alias("score"))
    return out.select(*map(q, kept), (F.array_position(raw, F.array_max(raw)) - 1).cast("double").alias("prediction"))


def _searched(name: str, task: str, rows: DataFrame, x: list[str], s: Settings, n_classes: int, n_rows: int) -> dict[str, object]:
    """The setting that scores best over three folds, by the primary metric of the comparison."""
    choices, evaluator = _choices(name, s), _evaluator(task)
    folded = with_folds(rows, task, SEARCH_FOLDS, SEED + 23).withColumnRenamed("fold", "_fold")

    def value(choice: dict, fold: int) -> float:
        _, apply = _grown(name, task, folded.filter(F.col("_fold") != fold), x, choice, n_classes, n_rows * (SEARCH_FOLDS - 1) // SEARCH_FOLDS)
        return evaluator.evaluate(apply(folded.filter(F.col("_fold") == fold)))

    values = in_parallel([partial(value, c, f) for c in choices for f in range(SEARCH_FOLDS)], s.parallelism)
    return choices[int(np.argmax(np.reshape(values, (-1, SEARCH_FOLDS)).mean(axis=1)))]


def fit_two_classes(train: DataFrame, x: list[str], s: Settings) -> Fitted:
    """Logistic regression of two classes, or the best of the search: fits of all folds and C, and the refits, share their scans."""
    rows = train.select(*[q(c) for c in x], "y", "weight", "row_key")
    if not s.search:
        return logistic_model(fit_logistic(rows, x, [(None, s.logistic_c)])[0], x)
    values = [c["C"] for c in _choices(LOGISTIC, s)]
    folded = with_folds(rows, "classification", SEARCH_FOLDS, SEED + 23)
    fits = fit_logistic(folded, x, [(f, c) for c in values for f in (None, *range(SEARCH_FOLDS))])
    said = {c: F.lit(None).cast("double") for c in values}
    for fit in fits:
        if fit.fold is not None:
            said[fit.c] = F.when(F.col("fold") == fit.fold, _says(fit, x)).otherwise(said[fit.c])
    counts = confusion_counts(to_long(folded, {str(c): v for c, v in said.items()}, ["fold", "y"], "setting", "prediction"), by=["setting", "fold"])
    means = {r["setting"]: r["m"] for r in class_metrics(counts, ["setting", "fold"]).groupBy("setting").agg(F.avg("F1_weighted").alias("m")).collect()}
    best = max(values, key=lambda c: (means.get(str(c), 0.0), -values.index(c)))
    return logistic_model(next(f for f in fits if f.fold is None and f.c == best), x)


def _says(fit: LogisticFit, x: list[str]) -> Column:
    return (linear_expression(x, fit.intercept, np.array(fit.coefficients)) > 0).cast("double")


def logistic_model(fit: LogisticFit, x: list[str]) -> Fitted:
    score = 1 / (1 + F.exp(-linear_expression(x, fit.intercept, np.array(fit.coefficients))))
    return Fitted(LOGISTIC, lambda df: df.withColumns({"prediction": _says(fit, x), "score": score}), {"C": fit.c}, fit)


def fit_mllib(name: str, task: str, train: DataFrame, x: list[str], s: Settings, n_classes: int,
              n_rows: int) -> Fitted:
    if name in TREES:
        return fit_trees(name, task, train, x, s, n_classes, n_rows)
    if n_classes == 2:
        return fit_two_classes(train, x, s)
    stage = _logistic(s, n_rows)
    vectors = assembled(train, x).select("features", "y", "weight", "row_key")
    if s.search:
        model, parameters = _search(name, task, stage, vectors, s, n_classes, n_rows)
    else:
        model, parameters = stage.fit(vectors), _configured(name, s)
    return Fitted(name, _applier(model, x, task == "classification" and n_classes == 2), parameters, model)


def _applier(model, x: list[str], scored: bool):
    def apply(df: DataFrame) -> DataFrame:
        kept = df.columns
        out = model.transform(assembled(df, x))
        extra: list[Column] = [F.col("prediction")]
        if scored and "probability" in out.columns:
            extra.append(vector_to_array("probability")[1].alias("score"))
        return out.select(*kept, *extra)
    return apply


# --- search -------------------------------------------------------------------------------------

def search_grid(name: str, s: Settings) -> dict[str, list] | None:
    """Narrow search: the configured value of each knob and its neighbours."""
    configured = _configured(name, s)
    if name == FOREST:
        trees = s.forest_trees
        near = {"n_estimators": [max(50, trees // 2), trees, 2 * trees], "max_depth": [s.forest_depth, *NEAR_DEPTHS]}
    elif name in NEAR:
        near = {knob: [low, configured[knob], high] for knob, (low, high) in NEAR[name].items()}
    else:
        return None
    return {knob: list(dict.fromkeys(values)) for knob, values in near.items()}


def search_space(name: str, s: Settings) -> dict[str, list] | None:
    """Broad search: wide ranges that also hold the configured values, to be drawn from."""
    if name not in WIDE:
        return None
    configured = _configured(name, s)
    return {knob: list(dict.fromkeys([configured[knob], *values])) if knob in configured else list(values)
            for knob, values in WIDE[name].items()}


def _configured(name: str, s: Settings) -> dict[str, object]:
    return {FOREST: {"n_estimators": s.forest_trees, "max_depth": s.forest_depth},
            BOOSTING: {"learning_rate": s.boosting_rate, "max_iter": s.boosting_rounds},
            LOGISTIC: {"C": s.logistic_c}}.get(name, {})


def draws(space: dict[str, list], n: int = SEARCH_DRAWS, seed: int = SEED) -> list[dict[str, object]]:
    """Distinct random settings, all of them if there are no more than n."""
    every = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return every if len(every) <= n else random.Random(seed).sample(every, n)


def _choices(name: str, s: Settings) -> list[dict[str, object]]:
    return draws(search_space(name, s)) if s.broad_search else draws(search_grid(name, s), n=10_000)


def _evaluator(task: str):
    return (RegressionEvaluator(labelCol="y", metricName="r2") if task == "regression" else
            MulticlassClassificationEvaluator(labelCol="y", metricName="f1"))


def _search(name, task, stage, vectors, s, n_classes, n_rows):
    """Three-fold search by the primary metric of the comparison."""
    choices = _choices(name, s)
    search = CrossValidator(estimator=stage, evaluator=_evaluator(task), numFolds=SEARCH_FOLDS,
                            estimatorParamMaps=[{stage.regParam: 1.0 / (c["C"] * max(n_rows, 1))} for c in choices],
                            foldCol="search_fold", parallelism=s.parallelism, seed=SEED)
    found = search.fit(with_folds(vectors, task, SEARCH_FOLDS, SEED + 23).withColumnRenamed("fold", "search_fold"))
    best = choices[int(np.argmax(found.avgMetrics))]
    return found.bestModel, best


def fit_all(names: list[str], task: str, train: DataFrame, x: list[str], s: Settings, n_classes: int,
            n_rows: int) -> list[Fitted]:
    linear = fit_linear_family(train, x, [n for n in names if n in (LINEAR, RIDGE, LASSO)], s)
    others = in_parallel([partial(fit_mllib, n, task, train, x, s, n_classes, n_rows) for n in names
                          if n not in (LINEAR, RIDGE, LASSO)], s.parallelism)
    done = {f.name: f for f in [*linear, *others]}
    return [done[n] for n in names]
