"""Model queries: preparation, baseline, candidates, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep
from ..operators.baseline import breusch_pagan, logit_baseline, ols, vif_pruning, vif_table
from ..operators.evaluate import (class_metrics, confusion_counts, confusion_matrix, regression_metrics, roc_auc,
                                  select_best)
from ..operators.logistic import fit_logistic
from ..operators.importance import permutation_importance, shallow_tree
from ..operators.modeling import cross_validate, run_models, score
from ..operators.models import (BOOSTING, FOREST, LASSO, LINEAR, LOGISTIC, RIDGE, Settings, cross_validate_linear,
                                fit_all, fit_linear_family)
from ..plans.analyze import analyze
from .associations import _SCORES, scores
from .common import (LINE_NUMERIC, REVENUE, register, revenue, rounded, table, union_sql, unit_of, unit_sql)

QUERIES: dict = {}
SQL: dict[str, str] = {}

_DEFAULTS = Settings()

# --- preparation --------------------------------------------------------------------------------


@register(QUERIES, SQL, "label_encode", """
SELECT source AS label, row_number() OVER (ORDER BY source) - 1 AS code, count(*) AS n FROM documents GROUP BY source""")
def codes(spark, folder):
    return prep.label_codes(table(spark, folder, "documents"), "source")


@register(QUERIES, SQL, "label_encode_wide", """
SELECT label, row_number() OVER (ORDER BY label) - 1 AS code, n FROM (SELECT l_orderkey::VARCHAR AS label, count(*) AS n FROM lineitem GROUP BY 1)""")
def wide_codes(spark, folder):
    """Codes of order keys as text: a label for every order."""
    return prep.label_codes(table(spark, folder, "lineitem"), "l_orderkey")


@register(QUERIES, SQL, "train_test_split", f"SELECT o_orderkey, {unit_sql('o_orderkey')} >= 0.2 AS is_train FROM orders")
def split(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey")
    return prep.train_test_split(df, unit=unit_of("o_orderkey"))


def _stratified_sql(source: str, key: str, target: str) -> str:
    return f"""SELECT '{target}' AS target, {key} AS key, cell > coalesce(cut, last, -1) AS is_train FROM (
 SELECT *, min(CASE WHEN upto < n AND upto >= greatest(1, round(n * 0.2)) THEN cell END) OVER (PARTITION BY c) AS cut,
  max(CASE WHEN upto < n THEN cell END) OVER (PARTITION BY c) AS last FROM (
  SELECT *, count(*) OVER (PARTITION BY c) AS n, count(*) OVER (PARTITION BY c ORDER BY cell) AS upto
  FROM (SELECT {key}, {target} AS c, CAST(floor({unit_sql(key)} * 1048576) AS BIGINT) AS cell FROM {source})))"""


@register(QUERIES, SQL, "stratified_split", union_sql([_stratified_sql("labels", "doc_id", "quality"),
                                                       _stratified_sql("orders", "o_orderkey", "o_orderpriority")]))
def stratified(spark, folder):
    parts = [prep.stratified_split(table(spark, folder, t).select(k, c), c, unit=unit_of(k)).select(
        F.lit(c).alias("target"), F.col(k).alias("key"), "is_train")
        for t, k, c in (("labels", "doc_id", "quality"), ("orders", "o_orderkey", "o_orderpriority"))]
    return parts[0].unionByName(parts[1])


@register(QUERIES, SQL, "variance_filter", union_sql([
    f"SELECT '{c}' AS feature, round(var_samp({e}), 4) AS variance, var_samp({e}) > 1e-8 AS kept FROM lineitem"
    for c, e in (("l_quantity", "l_quantity"), ("l_discount", "l_discount"), ("tiny", "l_tax * 1e-6"), ("fixed", "3.0"))]))
def variance(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_quantity", "l_discount", (F.col("l_tax") * 1e-6).alias("tiny"), F.lit(3.0).alias("fixed"))
    found = prep.variances(df, df.columns)
    return rounded(spark.createDataFrame([(c, v, v > prep.MIN_VARIANCE) for c, v in found.items()],
                                         "feature string, variance double, kept boolean"), 4)


_MIXED = "(SELECT *, l_extendedprice + 2000 * l_quantity AS mixed FROM lineitem)"


@register(QUERIES, SQL, "f_regression", union_sql([
    f"SELECT '{c}' AS feature, round(r, 6) AS r, round(r * r / (1 - r * r) * (n - 2), 2) AS f FROM "
    f"(SELECT corr({c}, l_extendedprice) AS r, count(*) AS n FROM {_MIXED})" for c in ("l_quantity", "l_discount", "l_tax", "mixed")]))
def f_scores(spark, folder):
    df = table(spark, folder, "lineitem").withColumn("mixed", F.col("l_extendedprice") + 2000 * F.col("l_quantity"))
    return rounded(prep.f_regression(df, ["l_quantity", "l_discount", "l_tax", "mixed"], "l_extendedprice"), f=2)


@register(QUERIES, SQL, "class_weights", union_sql([f"""
SELECT '{c}' AS target, CAST(label AS VARCHAR) AS label, n, round(total / (k * n)::DOUBLE, 6) AS weight, round(ratio, 6) AS imbalance_ratio, ratio >= 1.5 AS is_imbalanced
FROM (SELECT {c} AS label, count(*) AS n FROM {t} GROUP BY 1), (SELECT sum(n) AS total, count(*) AS k, max(n) / min(n)::DOUBLE AS ratio
 FROM (SELECT {c}, count(*) AS n FROM {t} GROUP BY 1))""" for t, c in (("labels", "quality"), ("lineitem", "l_returnflag"))]))
def weights(spark, folder):
    parts = [prep.class_weights(table(spark, folder, t), c).withColumn("label", F.col("label").cast("string"))
             .withColumn("target", F.lit(c)) for t, c in (("labels", "quality"), ("lineitem", "l_returnflag"))]
    return rounded(parts[0].unionByName(parts[1]))


_RANKED = ("l_extendedprice", "l_discount", "l_quantity", "l_tax", "l_linenumber")


@register(QUERIES, SQL, "top_corr_features", "SELECT feature, row_number() OVER (ORDER BY abs(r) DESC, feature) AS rank FROM ("
          + union_sql([f"SELECT '{c}' AS feature, corr({c}, revenue) AS r FROM {REVENUE}" for c in _RANKED])
          + ") ORDER BY 2 LIMIT 2")
def top_features(spark, folder):
    best = prep.top_correlated(revenue(spark, folder), list(_RANKED), "revenue", 2)
    return spark.createDataFrame([(c, i + 1) for i, c in enumerate(best)], "feature string, rank long")


# --- baseline -----------------------------------------------------------------------------------

_VIF = ("l_extendedprice", "l_discount", "revenue")


def _vif_sql(a: str, b: str, c: str) -> str:
    return (f"SELECT '{a}' AS feature, round(1 / (1 - (x * x + y * y - 2 * x * y * z) / (1 - z * z)), 4) AS vif FROM "
            f"(SELECT corr({a}, {b}) AS x, corr({a}, {c}) AS y, corr({b}, {c}) AS z FROM {REVENUE})")


@register(QUERIES, SQL, "vif", union_sql([_vif_sql(_VIF[i], _VIF[(i + 1) % 3], _VIF[(i + 2) % 3]) for i in range(3)]))
def inflation(spark, folder):
    return rounded(vif_table(revenue(spark, folder), list(_VIF)), 4)


@register(QUERIES, SQL, "vif_prune")
def pruning(spark, folder):
    return vif_pruning(revenue(spark, folder), [*LINE_NUMERIC, "revenue"])


_BY_WORDS = ("(SELECT doc_id, n_chars::DOUBLE AS y, len(string_split(text, ' '))::DOUBLE AS x FROM documents)")


def by_words(spark, folder):
    """Characters against words of each document."""
    return table(spark, folder, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("y"), F.size(F.split("text", " ", -1)).cast("double").alias("x"))


def _ols_frame(spark, fit, names):
    rows = [("const", fit.intercept), *zip(fit.names, [float(b) for b in fit.coef])]
    return spark.createDataFrame([(t, float(b), fit.r2, fit.n) for t, b in rows],
                                 "term string, coef double, r2 double, n long")


@register(QUERIES, SQL, "ols_simple", f"""
SELECT term, round(CASE term WHEN 'const' THEN a ELSE b END, 4) AS coef, round(r2, 4) AS r2, n FROM (SELECT regr_intercept(y, x) AS a,
 regr_slope(y, x) AS b, regr_r2(y, x) AS r2, count(*) AS n FROM {_BY_WORDS}), (VALUES ('const'), ('x')) AS t(term)""")
def simple(spark, folder):
    return rounded(_ols_frame(spark, ols(by_words(spark, folder), ["x"], "y"), ["x"]), 4)


def _two_feature_sql(where: str = "true") -> str:
    """Intercept a and slopes b1, b2 of revenue on price and discount by the normal equations."""
    return f"""(SELECT my - b1 * m1 - b2 * m2 AS a, b1, b2, my, vy, c1, c2, n FROM (
 SELECT (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2, * FROM (
 SELECT avg(revenue) AS my, avg(l_extendedprice) AS m1, avg(l_discount) AS m2, var_pop(l_extendedprice) AS v1, var_pop(l_discount) AS v2,
  covar_pop(l_extendedprice, l_discount) AS c12, covar_pop(l_extendedprice, revenue) AS c1, covar_pop(l_discount, revenue) AS c2,
  var_pop(revenue) AS vy, count(*) AS n FROM {REVENUE} WHERE {where})))"""


@register(QUERIES, SQL, "ols_multi", f"""
SELECT term, round(CASE term WHEN 'const' THEN a WHEN 'l_extendedprice' THEN b1 ELSE b2 END, 4) AS coef,
 round((b1 * c1 + b2 * c2) / vy, 4) AS r2, n FROM {_two_feature_sql()}, (VALUES ('const'), ('l_extendedprice'), ('l_discount')) AS t(term)""")
def multi(spark, folder):
    x = ["l_extendedprice", "l_discount"]
    return rounded(_ols_frame(spark, ols(revenue(spark, folder), x, "revenue"), x), 4)


@register(QUERIES, SQL, "breusch_pagan", f"""
SELECT round(count(*) * regr_r2(e * e, x), 4) AS statistic, round(avg(e), 4) + 0.0 AS residual_mean FROM (SELECT x, y - a - b * x AS e FROM {_BY_WORDS},
 (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM {_BY_WORDS}))""")
def bp(spark, folder):
    df = by_words(spark, folder)
    stat, _, mean = breusch_pagan(df, ["x"], "y", ols(df, ["x"], "y"))
    return rounded(spark.createDataFrame([(float(stat), float(mean))], "statistic double, residual_mean double"), 4)


@register(QUERIES, SQL, "residuals", f"""
SELECT doc_id, round(a + b * x, 4) AS fitted, round(y - a - b * x, 4) + 0.0 AS residual FROM {_BY_WORDS},
 (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM {_BY_WORDS})""")
def residuals(spark, folder):
    df = by_words(spark, folder)
    rule = ols(df, ["x"], "y").expression(["x"])
    return rounded(df.select("doc_id", rule.alias("fitted"), (F.col("y") - rule).alias("residual")), 4)


def _quality(spark, folder):
    """Labelled documents with simple text measures."""
    docs = table(spark, folder, "documents").select(
        "doc_id", "n_chars", F.size(F.split("text", " ", -1)).alias("n_words"),
        F.length(F.regexp_replace("text", r"[^.!?]", "")).alias("n_stops"), "lang")
    return docs.join(table(spark, folder, "labels"), "doc_id")


@register(QUERIES, SQL, "logit_baseline")
def logit(spark, folder):
    frame = prep.prepare(_quality(spark, folder), "quality", ["n_chars", "n_words", "n_stops"], "classification",
                         keys=["doc_id"])
    return logit_baseline(frame).coefficients(spark)


# --- candidates ---------------------------------------------------------------------------------

_X = ["l_extendedprice", "l_discount"]


def _split_lines(spark, folder):
    df = revenue(spark, folder)
    unit = F.pmod(F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729, F.lit(100003)) / F.lit(100003.0)
    return df.select("l_orderkey", "l_linenumber", *_X, F.col("revenue").alias("y"), (unit >= 0.2).alias("is_train"),
                     F.pmod(F.col("l_orderkey"), F.lit(5)).cast("int").alias("fold"),
                     F.xxhash64("l_orderkey", "l_linenumber").alias("row_key"))


_LINE_UNIT = "((l_orderkey * 7919 + l_linenumber * 104729) % 100003) / 100003.0"


@register(QUERIES, SQL, "model_linear", f"""
SELECT 'Linear Regression' AS model, round(avg(abs(e)), 3) AS "MAE", round(sqrt(avg(e * e)), 3) AS "RMSE",
 round(1 - sum(e * e) / (var_pop(revenue) * count(*)), 6) AS "R2" FROM (SELECT revenue, revenue - a - b1 * l_extendedprice - b2 * l_discount AS e
 FROM {REVENUE}, {_two_feature_sql(_LINE_UNIT + " >= 0.2")} WHERE {_LINE_UNIT} < 0.2)""")
def linear(spark, folder):
    df = _split_lines(spark, folder)
    model = fit_linear_family(df.filter("is_train"), _X, [LINEAR], _DEFAULTS)[0]
    out = regression_metrics(model.apply(df.filter("not is_train"))).withColumn("model", F.lit(LINEAR))
    return rounded(out, 3, R2=6)


def _cv_sql() -> str:
    return union_sql([f"""
SELECT 'Linear Regression' AS model, {f}::BIGINT AS fold, round(avg(abs(e)), 3) AS "MAE", round(sqrt(avg(e * e)), 3) AS "RMSE",
 round(1 - sum(e * e) / (var_pop(revenue) * count(*)), 6) AS "R2" FROM (SELECT revenue, revenue - a - b1 * l_extendedprice - b2 * l_discount AS e
 FROM {REVENUE}, {_two_feature_sql(f"l_orderkey % 5 <> {f}")} WHERE l_orderkey % 5 = {f})""" for f in range(5)])


@register(QUERIES, SQL, "cv_linear", _cv_sql())
def cv(spark, folder):
    return rounded(cross_validate_linear(_split_lines(spark, folder), _X, [LINEAR], _DEFAULTS, 5), 3, R2=6)


@register(QUERIES, SQL, "cv_penalised")
def cv_penalised(spark, folder):
    """Ridge and Lasso with their penalty searches inside every fold."""
    return cross_validate_linear(_split_lines(spark, folder), _X, [RIDGE, LASSO], _DEFAULTS, 5)


@register(QUERIES, SQL, "cv_folds", """
SELECT (l_orderkey % 5)::BIGINT AS fold, count(*) AS n, round(avg(l_extendedprice * (1 - l_discount)), 4) AS y_mean FROM lineitem GROUP BY 1""")
def folds(spark, folder):
    return rounded(_split_lines(spark, folder).groupBy("fold").agg(F.count("*").alias("n"), F.avg("y").alias("y_mean")), 4)


def _candidate(spark, folder, name: str, task: str):
    if task == "regression":
        frame = prep.prepare(revenue(spark, folder), "revenue", [*LINE_NUMERIC, "l_linenumber"], task,
                             keys=["l_orderkey", "l_linenumber"])
    else:
        frame = prep.prepare(_quality(spark, folder), "quality", ["n_chars", "n_words", "n_stops"], task, keys=["doc_id"])
    model = fit_all([name], task, frame.train, frame.x, _DEFAULTS, len(frame.labels), frame.n_train)[0]
    found = score(model.apply(frame.test), task, len(frame.labels))
    return spark.createDataFrame([(name, m, v, str(model.parameters)) for m, v in found.items()],
                                 "model string, metric string, value double, hyperparameters string")


def _register_candidates():
    for key, name, task in (("model_ridge", RIDGE, "regression"), ("model_lasso", LASSO, "regression"),
                            ("model_rf_reg", FOREST, "regression"), ("model_gbt_reg", BOOSTING, "regression"),
                            ("model_logistic", LOGISTIC, "classification"), ("model_rf_clf", FOREST, "classification"),
                            ("model_gbt_clf", BOOSTING, "classification")):
        QUERIES[key] = lambda spark, folder, name=name, task=task: _candidate(spark, folder, name, task)


_register_candidates()


@register(QUERIES, SQL, "model_gbt_multiclass")
def multiclass(spark, folder):
    """Boosting for the three order states, one model for all."""
    df = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    frame = prep.prepare(df, "o_orderstatus", ["o_custkey", "o_totalprice"], "classification", keys=["o_orderkey"])
    model = fit_all([BOOSTING], frame.task, frame.train, frame.x, _DEFAULTS, len(frame.labels), frame.n_train)[0]
    return class_metrics(confusion_counts(model.apply(frame.test)))


@register(QUERIES, SQL, "gbt_steps", """
SELECT step, count(*) AS n, 31::BIGINT AS n_leaves, (step * step) % 29 + step / 2 AS prediction
FROM (SELECT (l_orderkey % 248) // 8 AS step FROM lineitem) GROUP BY step""")
def steps(spark, folder):
    """31 planted steps: one round at rate 1 is a tree of 31 leaves that gives each step its level."""
    step = F.floor(F.col("l_orderkey") % 248 / 8).cast("long")
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") % 248).cast("double").alias("x"), step.alias("step"), (step * step % 29 + step / 2).alias("y"), F.lit(1.0).alias("weight"),
        F.xxhash64("l_orderkey", "l_linenumber").alias("row_key"))
    model = fit_all([BOOSTING], "regression", rows, ["x"], Settings(boosting_rate=1.0, boosting_rounds=1), 0, rows.count())[0]
    leaves = model.model.rounds[0][0].n_leaves
    return rounded(model.apply(rows).groupBy("step").agg(F.count("*").alias("n"), F.lit(leaves).cast("long").alias("n_leaves"), F.max("prediction").alias("prediction")))


@register(QUERIES, SQL, "forest_stairs", """
SELECT step, count(*) AS n, TRUE AS beyond_15, round(pow(3.0, step), 3) AS prediction FROM (SELECT l_orderkey % 20 AS step FROM lineitem) GROUP BY step""")
def stairs(spark, folder):
    """20 planted steps, each three times the last: best splits take one step off at a time, so every tree is deeper than 15."""
    step = F.col("l_orderkey") % 20
    rows = table(spark, folder, "lineitem").select(
        step.cast("double").alias("x"), step.alias("step"), F.pow(F.lit(3.0), step).alias("y"), F.lit(1.0).alias("weight"),
        F.xxhash64("l_orderkey", "l_linenumber").alias("row_key"))
    model = fit_all([FOREST], "regression", rows, ["x"], Settings(forest_trees=8), 0, rows.count())[0]
    return rounded(model.apply(rows).groupBy("step").agg(F.count("*").alias("n"), F.lit(model.model.depth > 15).alias("beyond_15"),
                                                         F.max("prediction").alias("prediction")), 3)


@register(QUERIES, SQL, "logistic_odds", """
SELECT left_out, round(ln(p0 / (1 - p0)), 4) AS intercept, round(ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)), 4) AS coef FROM (
 SELECT f AS left_out, avg(y) FILTER (WHERE x = 0) AS p0, avg(y) FILTER (WHERE x = 1) AS p1 FROM (
  SELECT l_orderkey % 5 AS fold, (l_linenumber > 2)::INT AS x, ((l_quantity + 7 * l_linenumber) % 10 < 4)::INT AS y FROM lineitem), range(-1, 5) t(f) WHERE fold <> f GROUP BY f)""")
def odds(spark, folder):
    """Logistic fits of one feature of two values, all rows (-1) and each of five folds left out: log odds in closed form."""
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") % 5).cast("int").alias("fold"), (F.col("l_linenumber") > 2).cast("double").alias("x"),
        ((F.col("l_quantity") + 7 * F.col("l_linenumber")) % 10 < 4).cast("double").alias("y"), F.lit(1.0).alias("weight"))
    fits = fit_logistic(rows, ["x"], [(f, 1e12) for f in (None, *range(5))])
    return rounded(spark.createDataFrame([(-1 if f.fold is None else f.fold, f.intercept, f.coefficients[0]) for f in fits],
                                         "left_out long, intercept double, coef double"), 4)


# --- evaluation ---------------------------------------------------------------------------------


@register(QUERIES, SQL, "regression_metrics", """
SELECT l_returnflag, round(avg(abs(e)), 3) AS "MAE", round(sqrt(avg(e * e)), 3) AS "RMSE", round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS "R2"
FROM (SELECT l_returnflag, l_extendedprice AS y, l_extendedprice - 2000 * l_quantity AS e FROM lineitem) GROUP BY 1""")
def reg_metrics(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("y"), (2000 * F.col("l_quantity")).alias("prediction"))
    return rounded(regression_metrics(df, by=["l_returnflag"]), 3, R2=6)


_PREDICTED = ("(SELECT l_returnflag AS actual, CASE WHEN l_linenumber % 3 = 0 THEN 'A' WHEN l_quantity > 25 THEN 'N' ELSE l_returnflag END AS predicted "
              "FROM lineitem)")


def _predicted(spark, folder):
    guess = (F.when(F.col("l_linenumber") % 3 == 0, "A").when(F.col("l_quantity") > 25, "N").otherwise(F.col("l_returnflag")))
    return table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("y"), guess.alias("prediction"))


@register(QUERIES, SQL, "classification_metrics", f"""
WITH c AS (SELECT unnest([actual, predicted]) AS c, unnest([1, 0]) AS a, unnest([0, 1]) AS p, unnest([(actual = predicted)::INT, 0]) AS h FROM {_PREDICTED}),
k AS (SELECT c, sum(a) AS support, sum(p) AS said, sum(h) AS hits FROM c GROUP BY c)
SELECT round(sum(hits) / sum(support)::DOUBLE, 6) AS "Accuracy", round(sum(2.0 * hits / (support + said) * support) / sum(support), 6) AS "F1_weighted",
 round(avg(hits / support::DOUBLE) FILTER (WHERE support > 0), 6) AS "Balanced_Accuracy" FROM k""")
def clf_metrics(spark, folder):
    return rounded(class_metrics(confusion_counts(_predicted(spark, folder))))


@register(QUERIES, SQL, "roc_auc", """
SELECT round((sum(CASE WHEN pos THEN r ELSE 0 END) - np * (np + 1) / 2.0) / (np::DOUBLE * nn), 6) AS "ROC_AUC", np AS n_pos, nn AS n_neg FROM (
 SELECT l_returnflag = 'R' AS pos, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM
  (SELECT l_returnflag, l_quantity + CASE WHEN l_returnflag = 'R' THEN 5 ELSE 0 END AS s FROM lineitem)),
 (SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS np, count(*) FILTER (WHERE l_returnflag <> 'R') AS nn FROM lineitem) GROUP BY np, nn""")
def auc(spark, folder):
    positive = (F.col("l_returnflag") == "R").cast("int")
    return rounded(roc_auc(table(spark, folder, "lineitem"), positive, F.col("l_quantity") + positive * 5))


@register(QUERIES, SQL, "confusion_matrix", f"""
SELECT a.l AS actual, p.l AS predicted, count(c.actual) AS n FROM (VALUES ('A'), ('N'), ('R')) AS a(l) CROSS JOIN (VALUES ('A'), ('N'), ('R')) AS p(l)
LEFT JOIN {_PREDICTED} c ON c.actual = a.l AND c.predicted = p.l GROUP BY 1, 2""")
def confusion(spark, folder):
    labels = table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("label")).distinct()
    return confusion_matrix(_predicted(spark, folder), labels)


@register(QUERIES, SQL, "select_best", f"""
SELECT model, round(score, 6) AS score, rank FROM (SELECT model, avg(value) AS score, row_number() OVER (ORDER BY avg(value) DESC, model) AS rank
FROM {_SCORES} GROUP BY model) WHERE rank <= 2""")
def best(spark, folder):
    return rounded(select_best(scores(spark, folder).groupBy("model").agg(F.avg("value").alias("score"))))


@register(QUERIES, SQL, "grid_search")
def grid(spark, folder):
    frame = prep.prepare(_quality(spark, folder), "quality", ["n_chars", "n_words"], "classification", keys=["doc_id"])
    model = fit_all([LOGISTIC], frame.task, frame.train, frame.x, Settings(search=True), len(frame.labels), frame.n_train)[0]
    return spark.createDataFrame([(model.name, str(model.parameters))], "model string, hyperparameters string")


@register(QUERIES, SQL, "random_search")
def draws(spark, folder):
    frame = prep.prepare(_quality(spark, folder), "quality", ["n_chars", "n_words"], "classification", keys=["doc_id"])
    model = fit_all([LOGISTIC], frame.task, frame.train, frame.x, Settings(search=True, broad_search=True),
                    len(frame.labels), frame.n_train)[0]
    return spark.createDataFrame([(model.name, str(model.parameters))], "model string, hyperparameters string")


@register(QUERIES, SQL, "cross_validate")
def folds_of_all(spark, folder):
    """Five folds of logistic regression and forest on the labelled documents."""
    frame = prep.prepare(_quality(spark, folder), "quality", ["n_chars", "n_words"], "classification", keys=["doc_id"])
    found = cross_validate(frame, [LOGISTIC, FOREST], _DEFAULTS, 5)
    return spark.createDataFrame([(m, f, k, v) for m, by in found.items() for f, s in by.items() for k, v in s.items()],
                                 "model string, fold int, metric string, value double")


@register(QUERIES, SQL, "cv_comparison")
def compared_by_folds(spark, folder):
    """All classifiers compared over five folds: means and folds of each, the winner, and its paired test against the runner-up."""
    run = run_models(_quality(spark, folder), "quality", ["n_chars", "n_words", "n_stops"], "classification", cv_folds=5, settings=_DEFAULTS,
                     keys=["doc_id"])
    scores = run.comparison.select("model", "metric", "value", "fold", "is_best")
    test = run.best_vs_runner_up
    return scores.unionByName(test.select(F.col(test.columns[0]).alias("model"), F.lit("p").alias("metric"), F.col("p_value").alias("value"),
                                          F.lit(None).cast("int").alias("fold"), F.lit(True).alias("is_best")))


@register(QUERIES, SQL, "target_encoded_model")
def encoded_model(spark, folder):
    """Revenue of a line item from its line status and return flag by out-of-fold target means, and the numeric columns."""
    run = run_models(revenue(spark, folder), "revenue", ["l_linestatus", "l_returnflag", "l_quantity", "l_discount"], "regression",
                     names=[LINEAR, RIDGE, LASSO], encode=["l_linestatus", "l_returnflag"], settings=_DEFAULTS, keys=["l_orderkey", "l_linenumber"])
    return run.comparison.withColumn("target_encoded", F.lit(",".join(run.frame.encoded)))


@register(QUERIES, SQL, "permutation_importance")
def importance(spark, folder):
    frame = prep.prepare(revenue(spark, folder), "revenue", list(LINE_NUMERIC), "regression", keys=["l_orderkey", "l_linenumber"])
    model = fit_linear_family(frame.train, frame.x, [LINEAR], _DEFAULTS)[0]
    return permutation_importance(model, frame.test, frame.x, frame.names, frame.task, frame.n_test)


_GROWN = "o_totalprice * (1 + (o_orderkey % 10) / 20.0)"


@register(QUERIES, SQL, "permutation_shift", f"""
WITH o AS (SELECT o_totalprice AS x, {_GROWN} AS y, row_number() OVER (ORDER BY {unit_sql('o_orderkey')}, o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, var_pop(y) * count(*) AS total, regr_r2(y, x) AS r2 FROM o),
s AS (SELECT o.*, r, CAST(1 + floor((n - 1) * (((r + 1) * 0.6180339887498949e0) % 1e0)) AS BIGINT) AS ahead FROM o, range(5) t(r)),
p AS (SELECT s.r, any_value(m.r2) - 1 + sum((s.y - a - b * d.x) ** 2) / any_value(total) AS loss FROM m, s JOIN o d ON d.pos = (s.pos + s.ahead) % s.n GROUP BY s.r)
SELECT 'o_totalprice' AS feature, round(avg(loss), 5) AS importance, round(stddev_pop(loss), 5) AS std FROM p""")
def importance_by_position(spark, folder):
    """Importance of the price of an order for a value grown from it, rows in an arithmetic order that SQL can repeat."""
    df = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("row_key"), F.col("o_totalprice").alias("x0"), F.expr(_GROWN).cast("double").alias("y"),
        F.lit(0).alias("fold"))
    model = fit_linear_family(df, ["x0"], [LINEAR], _DEFAULTS)[0]
    return rounded(permutation_importance(model, df, ["x0"], ["o_totalprice"], "regression", df.count(), order=unit_of("row_key")), 5)


@register(QUERIES, SQL, "shallow_tree")
def tree(spark, folder):
    frame = prep.prepare(revenue(spark, folder), "revenue", list(LINE_NUMERIC), "regression", keys=["l_orderkey", "l_linenumber"])
    return shallow_tree(frame.train, frame.x, frame.names, frame.task, frame.n_train)


@register(QUERIES, SQL, "analyze_events")
def whole_chain(spark, folder):
    """The whole chain for the value of an event: every result table with its row count."""
    result = analyze(table(spark, folder, "events"), "value", keys=["event_id"],
                     series_keys=["event_type"], intervention_date="2024-01-16")
    return spark.createDataFrame([(n, t.count(), len(t.columns)) for n, t in result.tables.items()],
                                 "name string, n_rows long, n_cols int")


@register(QUERIES, SQL, "model_comparison")
def comparison(spark, folder):
    """The whole comparison of five regressors for the revenue of a line item."""
    return run_models(revenue(spark, folder), "revenue", list(LINE_NUMERIC), "regression", settings=_DEFAULTS,
                      keys=["l_orderkey", "l_linenumber"]).comparison
