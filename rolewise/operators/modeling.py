"""Model comparison: prepare, baseline, fit or cross-validate, choose, explain."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.tables import in_parallel, staged
from .association import tests_frame, wilcoxon
from .baseline import Baseline, logit_baseline, ols_baseline
from .evaluate import (CLASS_METRICS, PRIMARY, REGRESSION_METRICS, class_metrics, confusion_counts,
                       confusion_matrix, regression_metrics, roc_auc)
from .importance import permutation_importance, shallow_tree
from .logistic import fit_logistic
from .models import (BOOSTING, LASSO, LINEAR, LOGISTIC, RIDGE, TREES, Fitted, Settings, candidates, cross_validate_linear,
                     fit_all, fit_boosted_folds, logistic_model)
from .prep import FOLDS, MAX_FEATURES, SEED, TEST_SHARE, ModelFrame, prepare, with_folds

COMPARISON_SCHEMA = ("model string, metric string, value double, fold int, is_best boolean, "
                     "hyperparameters string")
SUMMARY_SCHEMA = ("task string, target string, n_train long, n_test long, n_features_before int, "
                  "n_features_after int, dropped_low_variance string, is_imbalanced boolean, "
                  "class_weight_applied boolean, feature_selection_applied boolean, cv_folds int, "
                  "search_applied boolean, broad_search_applied boolean, best_model string, "
                  "runner_up string, target_encoded string")


@dataclass
class ModelRun:
    frame: ModelFrame
    baseline: Baseline
    scores: dict[str, dict[str, float]]
    fold_scores: dict[str, dict[int, dict[str, float]]]
    best: str
    runner_up: str | None
    fitted: Fitted
    summary: DataFrame
    comparison: DataFrame
    predictions: DataFrame
    importance: DataFrame
    confusion: DataFrame | None = None
    tree: DataFrame | None = None
    best_vs_runner_up: DataFrame | None = None


def score(predicted: DataFrame, task: str, n_classes: int) -> dict[str, float]:
    """All metrics of one prediction frame: a handful of numbers."""
    if task == "regression":
        row = regression_metrics(predicted).first()
        return {m: row[m] for m in REGRESSION_METRICS}
    row = class_metrics(confusion_counts(predicted)).first()
    out = {m: row[m] for m in CLASS_METRICS}
    if n_classes == 2 and "score" in predicted.columns:
        out["ROC_AUC"] = roc_auc(predicted).first()["ROC_AUC"]
    return out


def score_all(fits: list[Fitted], rows: DataFrame, task: str, n_classes: int) -> dict[str, dict[str, float]]:
    """All metrics of several models on the same rows: each model predicts them once, and the metrics of all come from the same scans."""
    two = task == "classification" and n_classes == 2
    said = staged(reduce(DataFrame.unionByName, [f.apply(rows).select(F.lit(f.name).alias("model"), "y", "prediction", *(["score"] if two else [])) for f in fits]))
    if task == "regression":
        out = {r["model"]: {m: r[m] for m in REGRESSION_METRICS} for r in regression_metrics(said, by=["model"]).collect()}
    else:
        out = {r["model"]: {m: r[m] for m in CLASS_METRICS} for r in class_metrics(confusion_counts(said, by=["model"]), ["model"]).collect()}
    if two:
        areas = {r["model"]: r["ROC_AUC"] for r in roc_auc(said, by=["model"]).collect()}
        out = {n: {**s, "ROC_AUC": areas.get(n)} for n, s in out.items()}
    said.unpersist()
    return out


def cross_validate(frame: ModelFrame, names: list[str], settings: Settings, n_folds: int
                   ) -> dict[str, dict[int, dict[str, float]]]:
    """Metrics per model and fold over all rows; weights are kept in every fold."""
    out: dict[str, dict[int, dict[str, float]]] = {}
    linear = [n for n in names if n in (LINEAR, RIDGE, LASSO)]
    if linear:
        for r in cross_validate_linear(frame.table, frame.x, linear, settings, n_folds).collect():
            out.setdefault(r["model"], {})[r["fold"]] = {m: r[m] for m in REGRESSION_METRICS}
    others = [n for n in names if n not in linear]
    shared: dict[int, list[Fitted]] = {f: [] for f in range(n_folds)}
    n_rows = frame.n_train + frame.n_test
    if LOGISTIC in others and len(frame.labels) == 2:          # the fits of all folds from the same scans
        others.remove(LOGISTIC)
        for f in fit_logistic(frame.table, frame.x, [(f, settings.logistic_c) for f in range(n_folds)]):
            shared[f.fold].append(logistic_model(f, frame.x))
    if BOOSTING in others and not settings.search:             # likewise
        others.remove(BOOSTING)
        for f, fit in fit_boosted_folds(frame.task, frame.table, frame.x, settings, len(frame.labels), n_rows - n_rows // n_folds, n_folds).items():
            shared[f].append(fit)

    def one_fold(fold: int) -> dict[str, dict[str, float]]:
        train = frame.table.filter(F.col("fold") != fold)
        held_out = frame.table.filter(F.col("fold") == fold)
        fits = fit_all(others, frame.task, train, frame.x, settings, len(frame.labels), n_rows - n_rows // n_folds)
        fits += shared[fold]
        return score_all(fits, held_out, frame.task, len(frame.labels))

    found = in_parallel([partial(one_fold, f) for f in range(n_folds)] if others or shared[0] else [], 2)
    for fold, scores in enumerate(found):
        for name, s in scores.items():
            out.setdefault(name, {})[fold] = s
    return out


def _mean_scores(folds: dict[int, dict[str, float]]) -> dict[str, float]:
    metrics = next(iter(folds.values()))
    values = {m: [s[m] for s in folds.values() if s[m] is not None] for m in metrics}
    return {m: sum(v) / len(v) if v else None for m, v in values.items()}


def _usable_folds(wanted: int, frame: ModelFrame) -> int:
    """Fold count, at most the smallest class but two at least; 0 means the plain split."""
    if wanted < 2:
        return 0
    return max(2, min(wanted, frame.min_class)) if frame.task == "classification" else wanted


def run_models(df: DataFrame, target: str, features: list[str], task: str,
               test_share: float = TEST_SHARE, names: list[str] | None = None,
               handle_imbalance: bool = True, feature_selection: bool = True, cv_folds: int = 0,
               settings: Settings | None = None, encode: list[str] = (), keys: list[str] | None = None,
               max_features: int = MAX_FEATURES, seed: int = SEED) -> ModelRun:
    """Compare the candidates for a task and explain the winner."""
    settings = settings or Settings()
    spark = df.sparkSession
    frame = prepare(df, target, features, task, test_share, seed, keys, handle_imbalance,
                    feature_selection, list(encode), max_features, max(cv_folds, FOLDS))
    folds = _usable_folds(cv_folds, frame)
    if folds and folds != max(cv_folds, FOLDS):
        frame.table = with_folds(frame.table.drop("fold"), task, folds, seed)
    n_classes = len(frame.labels)
    if task == "regression":
        baseline = ols_baseline(frame)
    elif n_classes == 2:
        baseline = logit_baseline(frame)
    else:
        baseline = Baseline("skipped", note="the baseline covers two classes only")

    if folds:              # no search inside folds, to bound the number of fits
        settings = Settings(**{**vars(settings), "search": False, "broad_search": False})
    wanted, primary = candidates(task, names), PRIMARY[task]
    fold_scores: dict[str, dict[int, dict[str, float]]] = {}
    fits: dict[str, Fitted] = {}
    if folds:
        fold_scores = cross_validate(frame, wanted, settings, folds)
        scores = {n: _mean_scores(fold_scores[n]) for n in wanted}
    else:
        fits = {f.name: f for f in fit_all(wanted, task, frame.train, frame.x, settings, n_classes,
                                           frame.n_train)}
        scores = {n: score(f.apply(frame.test), task, n_classes) for n, f in fits.items()}
    ranked = sorted(wanted, key=lambda n: -(scores[n][primary] if scores[n][primary] is not None
                                            else float("-inf")))
    best = ranked[0]
    runner_up = ranked[1] if folds and len(ranked) > 1 else None
    if best not in fits:                                        # refit the winner on the split
        fits = {f.name: f for f in fit_all([best], task, frame.train, frame.x, settings, n_classes,
                                           frame.n_train)}
    fitted = fits[best]
    predicted = fitted.apply(frame.test)
    confusion = None
    if task == "classification":
        codes = spark.createDataFrame([(float(i),) for i in range(n_classes)], "label double")
        names_of = spark.createDataFrame(list(enumerate(frame.labels)), "code int, name string")
        confusion = (confusion_matrix(predicted, codes)
                     .join(F.broadcast(names_of.toDF("a", "actual_label")), F.col("actual") == F.col("a"))
                     .join(F.broadcast(names_of.toDF("p", "predicted_label")), F.col("predicted") == F.col("p"))
                     .select(F.col("actual_label").alias("actual"),
                             F.col("predicted_label").alias("predicted"), "n"))
    importance = permutation_importance(fitted, frame.test, frame.x, frame.names, task, frame.n_test)
    tree = None
    if best in TREES:
        tree = shallow_tree(frame.train, frame.x, frame.names, task, frame.n_train)
    test = None
    if runner_up:
        pairs = [(fold_scores[best][f][primary], fold_scores[runner_up][f][primary])
                 for f in fold_scores[best] if f in fold_scores[runner_up]]
        found = wilcoxon(*zip(*pairs)) if pairs else None
        label = f"{best} vs {runner_up}"
        test = tests_frame(spark, [(label, "Wilcoxon signed-rank", *found)] if found else [])
    summary = _summary(spark, frame, target, feature_selection, folds, settings, best, runner_up)
    comparison = _comparison(spark, scores, fold_scores, best, fits)
    return ModelRun(frame, baseline, scores, fold_scores, best, runner_up, fitted, summary, comparison,
                    predicted, importance, confusion, tree, test)


def _comparison(spark: SparkSession, scores, fold_scores, best, fits) -> DataFrame:
    rows = []
    for n, metrics in scores.items():
        parameters = str(fits[n].parameters) if n in fits else None
        rows += [(n, m, v, None, n == best, parameters) for m, v in metrics.items()]
        rows += [(n, m, v, f, n == best, None) for f, s in fold_scores.get(n, {}).items()
                 for m, v in s.items()]
    return spark.createDataFrame(rows, COMPARISON_SCHEMA)


def _summary(spark, frame, target, feature_selection, folds, settings, best, runner_up) -> DataFrame:
    return spark.createDataFrame([(
        frame.task, target, frame.n_train, frame.n_test, frame.n_before, len(frame.names),
        ",".join(frame.low_variance), frame.is_imbalanced, frame.weighted, feature_selection, folds,
        settings.search, settings.search and settings.broad_search, best, runner_up,
        ",".join(frame.encoded))], SUMMARY_SCHEMA)
