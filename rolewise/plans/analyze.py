"""The analysis chain over one table and an optional target column."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, functions as F

from ..operators import charts
from ..operators.association import association_suite
from ..operators.clean import clean
from ..operators.features import TEXT_COLUMNS, Features, engineer
from ..operators.modeling import ModelRun, run_models
from ..operators.models import Settings
from ..operators.prep import TEST_SHARE, split_rows
from ..operators.profile import (NumericProfile, class_balance, correlation_matrix, missing_shares,
                                 numeric_frame, numeric_profiles, profile_columns, redundant_pairs,
                                 table_profile, top_values)
from ..operators.roles import Roles, infer_roles
from ..operators.segments import Segments, find_segments
from ..operators.timeseries import analyze_series, intervention
from ..functions.words import STOP_WORDS


@dataclass
class Analysis:
    """Result tables by name, and the driver-side facts they were decided by."""

    dataset_name: str
    roles: Roles
    profiles: dict[str, NumericProfile]
    cleaned: DataFrame
    features: Features
    tables: dict[str, DataFrame] = field(default_factory=dict)
    segments: Segments | None = None
    models: ModelRun | None = None


def analyze(df: DataFrame, target: str | None = None, dataset_name: str = "dataset",
            numeric_impute_strategy: str = "median", test_size: float = TEST_SHARE,
            model_names: list[str] | None = None, vectorize_text: bool = True,
            handle_imbalance: bool = True, feature_selection: bool = True, cv_folds: int = 0,
            cap_outliers: bool = False, ridge_alpha_range: tuple[float, float] = (1e-3, 1e3),
            lasso_alpha_range: tuple[float, float] = (1e-3, 1e2), logreg_C: float = 1.0,
            rf_n_estimators: int = 200, rf_max_depth: int | None = None,
            gb_learning_rate: float = 0.1, gb_max_iter: int = 100,
            hyperparameter_search: bool = False, broad_hyperparameter_search: bool = False,
            high_cardinality_encoding: str = "frequency", intervention_date: str | None = None,
            overrides: dict[str, str] | None = None, keys: list[str] | None = None,
            series_keys: list[str] = (), stop_words: tuple[str, ...] = STOP_WORDS,
            text_columns: int = TEXT_COLUMNS, log_features: bool = True, fit_on_train: bool = False,
            segment_restarts: int = 10) -> Analysis:
    """Roles, profile, cleaning, features, segments, tests, models, series and chart data.

    Only names, thresholds and aggregates reach the driver; every result is a DataFrame.  Stages
    whose gate does not pass start no job and leave no table.
    """
    spark = df.sparkSession
    roles = infer_roles(df, target, overrides)
    profiles = numeric_profiles(df, profile_columns(roles), roles.n_rows)
    cleaned, cleaning_log = clean(df, roles, profiles, numeric_impute_strategy, cap_outliers, log_features)
    n_clean = roles.n_rows - (roles.stats[target].n_missing if target in roles.stats else 0)
    split = split_rows(cleaned, target, roles.task, test_size, keys=keys) if roles.task else cleaned
    made = engineer(split, roles, vectorize_text, high_cardinality_encoding, stop_words,
                    split.filter("_is_train") if fit_on_train and roles.task else None, text_columns, n_clean)
    marks = ["_row_key", "_is_train"]                       # of the split: for the models, no features
    features = replace(made, table=made.table.drop(*marks), columns=[c for c in made.columns if c not in marks])
    out = Analysis(dataset_name, roles, profiles, cleaned, features)
    tables = out.tables
    tables.update(_profile_tables(df, roles, profiles))
    tables["cleaning_log"], tables["feature_log"] = cleaning_log, features.log_frame()

    out.segments = find_segments(cleaned, roles.numeric, keys, restarts=segment_restarts, n_rows=n_clean)
    if out.segments:
        tables["clusters"] = out.segments.labelled
        tables["cluster_sizes"] = out.segments.sizes()
        tables["cluster_search"] = out.segments.search_frame()
    if roles.task == "classification":
        tables["association_tests"] = association_suite(cleaned, roles)

    if roles.task:
        settings = Settings(ridge_alpha_range, lasso_alpha_range, logreg_C, rf_n_estimators, rf_max_depth,
                            gb_learning_rate, gb_max_iter, hyperparameter_search, broad_hyperparameter_search)
        out.models = run_models(made.table, target, features.columns, roles.task, test_size, model_names,
                                handle_imbalance, feature_selection, cv_folds, settings, features.deferred)
        tables.update(_model_tables(out.models))
    tables.update(_chart_tables(df, out, n_clean))

    if roles.task == "regression" and roles.datetimes:
        tables.update(analyze_series(cleaned, roles.datetimes[0], target, series_keys))
        shift = intervention(cleaned, roles.datetimes[0], target, intervention_date, series_keys) \
            if intervention_date else None
        if shift:
            tables["intervention"], tables["intervention_fitted"] = shift
    return out


def _profile_tables(df: DataFrame, roles: Roles, profiles: dict[str, NumericProfile]) -> dict[str, DataFrame]:
    spark = df.sparkSession
    out = {"column_profile": roles.profile(spark), "role_table": roles.table(spark),
           "table_profile": table_profile(df.select(*[c for c in df.columns if roles.roles[c] != "unsupported"])),
           "missingness": missing_shares(df),
           "numeric_profile": numeric_frame(spark, profiles),
           "top_values": top_values(df, roles.low + roles.high),
           "redundant_pairs": redundant_pairs(df, roles.numeric)}
    if roles.task == "classification":
        out["class_balance"] = class_balance(df, roles.target)
    return out


def _model_tables(run: ModelRun) -> dict[str, DataFrame]:
    spark = run.summary.sparkSession
    out = {"model_summary": run.summary, "model_comparison": run.comparison,
           "feature_importance": run.importance,
           "baseline_stats": run.baseline.stats_frame(spark),
           "baseline_coefficients": run.baseline.coefficients(spark)}
    optional = {"confusion": run.confusion, "tree_nodes": run.tree,
                "best_vs_runner_up": run.best_vs_runner_up, "residual_normality": run.baseline.normality}
    out.update({n: t for n, t in optional.items() if t is not None})
    return out


def _chart_tables(df: DataFrame, a: Analysis, n_rows: int) -> dict[str, DataFrame]:
    roles, out = a.roles, {"chart_missingness": charts.chart_missingness(df)}
    if roles.numeric:
        out["chart_histogram"] = charts.histogram(a.cleaned, roles.numeric)
    regression = roles.task == "regression"
    correlated = roles.numeric + ([roles.target] if regression else [])
    if len(correlated) >= 2:
        out["correlation_matrix"] = correlation_matrix(a.cleaned, correlated)
    if regression and roles.low:
        out["target_by_category"] = charts.target_by_category(a.cleaned, roles.target, roles.low[0])
    if roles.has_geo:
        has_cluster = "geo_cluster" in a.features.columns
        out["geo_grid"] = charts.geo_grid(
            a.features.table, roles.lat, roles.lon, cluster="geo_cluster" if has_cluster else None,
            target=roles.target, target_is_class=not regression)
    if a.segments:
        projected = charts.pca(a.segments.labelled, [f"z_{c}" for c in a.segments.columns],
                               ["row_key", "cluster"])
        if projected:
            out["cluster_pca"], out["cluster_pca_variance"] = projected
    if a.models:
        projected = charts.pca(a.models.frame.table, a.models.frame.x, ["row_key", "y"])
        if projected:
            out["feature_pca"], out["feature_pca_variance"] = projected
        if a.models.baseline.residuals is not None:
            out["residual_bins"] = charts.residual_bins(a.models.baseline.residuals)
            out["qq_points"] = charts.qq_points(a.models.baseline.residuals, n_rows=a.models.frame.n_train)
    return out
