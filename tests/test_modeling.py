import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rolewise.catalog import modelling as catalog
from rolewise.operators import models as m
from rolewise.operators.baseline import breusch_pagan, ols, vif_pruning, vif_table
from rolewise.operators.clean import clean
from rolewise.operators.evaluate import class_metrics, confusion_counts, confusion_matrix, roc_auc
from rolewise.operators.features import engineer
from rolewise.operators.importance import donor_rows, read_tree
from rolewise.functions.columns import row_hash
from rolewise.operators.linear import alpha_grid, feature_grams, lasso_cv, ridge_loo, solve_lasso, total
from rolewise.operators.modeling import run_models, score
from rolewise.operators.prep import label_codes, prepare, stratified_split, with_folds
from rolewise.operators.roles import infer_roles

FAST = m.Settings(forest_trees=10, forest_depth=6, boosting_rounds=8)


def prepared(df, target, **options):
    roles = infer_roles(df, target)
    made = engineer(clean(df, roles)[0], roles)
    return run_models(made.table, target, made.columns, roles.task, settings=FAST, **options)


def test_regression(regression, spark):
    run = prepared(regression, "target")
    assert set(run.scores) == set(m.REGRESSORS)
    assert all(set(s) == {"MAE", "RMSE", "R2"} for s in run.scores.values())
    assert run.scores[run.best]["R2"] > 0.5 and run.best in m.REGRESSORS
    assert run.baseline.kind == "ols" and run.baseline.stats["r2"] > 0.9
    assert run.importance.first()["importance"] > 0.1
    assert run.confusion is None
    row = run.summary.first()
    assert row["n_train"] + row["n_test"] == 300 and not row["is_imbalanced"]


def test_classification(classification):
    run = prepared(classification, "label")
    assert set(run.scores) == set(m.CLASSIFIERS)
    assert all("ROC_AUC" in s for s in run.scores.values())
    assert run.scores["Logistic Regression"]["ROC_AUC"] > 0.7
    assert run.baseline.kind == "logit"
    cells = run.confusion.collect()
    assert len(cells) == 4 and sum(r["n"] for r in cells) == run.summary.first()["n_test"]


def test_cross_validation(regression):
    run = prepared(regression, "target", cv_folds=4, names=["Linear Regression", "Lasso (CV)"])
    assert run.summary.first()["cv_folds"] == 4
    assert set(run.fold_scores["Lasso (CV)"]) == {0, 1, 2, 3}
    mean = np.mean([s["R2"] for s in run.fold_scores["Lasso (CV)"].values()])
    assert run.scores["Lasso (CV)"]["R2"] == pytest.approx(mean)
    assert run.runner_up in ("Linear Regression", "Lasso (CV)") and run.runner_up != run.best
    assert run.best_vs_runner_up.first()["test_name"] == "Wilcoxon signed-rank"


def test_imbalance_and_multiclass(make, rng):
    n = 300
    df = make(x1=rng.normal(size=n), y=rng.normal(size=n), label=[0] * 270 + [1] * 30)
    run = run_models(df, "label", ["x1", "y"], "classification", settings=FAST, names=["Logistic Regression"])
    assert run.frame.is_imbalanced and run.frame.weighted
    assert run.frame.train.filter("y = 1").first()["weight"] > 4
    off = run_models(df, "label", ["x1", "y"], "classification", settings=FAST, names=["Logistic Regression"],
                     handle_imbalance=False)
    assert not off.frame.weighted and off.frame.is_imbalanced
    three = make(x=np.repeat([0.0, 5.0, 10.0], 60) + rng.normal(size=180), k=np.repeat(["a", "b", "c"], 60))
    found = run_models(three, "k", ["x"], "classification", settings=m.Settings(forest_trees=5, boosting_rounds=3))
    assert found.baseline.kind == "skipped" and found.scores[found.best]["Accuracy"] > 0.9
    assert "ROC_AUC" not in found.scores["Random Forest"]


def test_xor_needs_trees(make, rng):
    x1, x2 = rng.uniform(-1, 1, 400), rng.uniform(-1, 1, 400)
    run = run_models(make(x1=x1, x2=x2, label=((x1 > 0) != (x2 > 0)).astype(int)), "label", ["x1", "x2"],
                     "classification", settings=FAST)
    assert run.best in m.TREES
    tree = run.tree.toPandas()
    assert tree["depth"].max() <= 3 and set(tree["feature"].dropna()) <= {"x1", "x2"}
    assert tree.loc[tree.is_leaf, "n"].sum() == run.frame.n_train and tree["share"].iloc[0] == 1.0


def test_wide_table_is_cut(make, rng):
    n = 300
    noise = {f"noise_{i}": rng.normal(size=n) for i in range(80)}
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    df = make(x1=x1, x2=x2, **noise, flat=np.ones(n), target=3 * x1 - 2 * x2 + rng.normal(size=n))
    run = run_models(df, "target", [c for c in df.columns if c != "target"], "regression", settings=FAST,
                     names=["Ridge (CV)"])
    assert len(run.frame.names) == 50 and {"x1", "x2"} <= set(run.frame.names)
    assert run.frame.low_variance == ["flat"] and run.scores["Ridge (CV)"]["R2"] > 0.5
    assert set(run.baseline.coefficients(df.sparkSession).toPandas()["term"]) >= {"const", "x1", "x2"}


def test_target_encoding(make, rng):
    cat = rng.choice(list("ABCDE"), 300)
    y = pd.Series(cat).map(dict(zip("ABCDE", (0, 5, 10, 15, 20)))).to_numpy() + rng.normal(size=300)
    df = make(cat=cat, noise=rng.normal(size=300), target=y)
    run = run_models(df, "target", ["cat", "noise"], "regression", settings=FAST, names=["Linear Regression"], encode=["cat"])
    assert run.scores["Linear Regression"]["R2"] > 0.5 and run.frame.encoded == ["cat"]


def test_candidate_filter():
    assert m.candidates("regression", ["Lasso (CV)", "nothing"]) == ["Lasso (CV)"]
    assert m.candidates("classification", ["nothing"]) == list(m.CLASSIFIERS)
    assert len(m.available_models()) == 6


def test_search_spaces():
    s = m.Settings()
    assert m.search_grid("Random Forest", s) == {"n_estimators": [100, 200, 400], "max_depth": [None, 8, 16]}
    assert m.search_grid("Logistic Regression", s) == {"C": [0.1, 1.0, 10.0]}
    assert m.search_grid("Ridge (CV)", s) is None and m.search_space("Lasso (CV)", s) is None
    space = m.search_space("Gradient Boosting", s)
    assert len(m.draws(space)) == 10 and m.draws(space) == m.draws(space)
    assert 0.1 in space["learning_rate"] and space["max_leaf_nodes"] == [15, 31, 63]


def test_grid_search_picks_from_the_grid(classification):
    frame = prepare(classification, "label", ["x1", "x2"], "classification")
    fit = m.fit_all(["Logistic Regression"], "classification", frame.train, frame.x, m.Settings(search=True), 2, frame.n_train)[0]
    assert fit.parameters["C"] in (0.1, 1.0, 10.0)


# --- closed forms -------------------------------------------------------------------------------

@pytest.fixture
def plane(make, rng):
    n = 250
    x = rng.normal(size=(n, 3)) * [1, 10, 0.1] + [0, 50, -3]
    return make(a=x[:, 0], b=x[:, 1], c=x[:, 2], y=2 + x @ [1.0, 0.5, -4.0] + rng.normal(size=n) * (1 + np.abs(x[:, 0])))


def test_ols_and_breusch_pagan(plane):
    fit = ols(plane, ["a", "b", "c"], "y")
    p = plane.toPandas()
    x = np.column_stack([np.ones(len(p)), p[["a", "b", "c"]]])
    beta = np.linalg.lstsq(x, p.y, rcond=None)[0]
    assert [fit.intercept, *fit.coef] == pytest.approx(list(beta), rel=1e-8)
    e = p.y - x @ beta
    cov = np.linalg.inv(x.T @ x) * (e @ e) / (len(p) - 4)
    assert list(fit.errors) == pytest.approx(list(np.sqrt(np.diag(cov))), rel=1e-7)
    lm, pv, mean = breusch_pagan(plane, ["a", "b", "c"], "y", fit)
    aux = e ** 2 - x @ np.linalg.lstsq(x, e ** 2, rcond=None)[0]
    want = len(p) * (1 - (aux @ aux) / ((e ** 2 - (e ** 2).mean()) ** 2).sum())
    assert lm == pytest.approx(want, rel=1e-6) and abs(mean) < 1e-8 and pv < 1


def test_vif(make, rng):
    a, b = rng.normal(size=300), rng.normal(size=300)
    df = make(a=a, b=b, twin=a + 0.01 * rng.normal(size=300), total=a + b, flat=np.ones(300))
    found = {r["feature"]: r["vif"] for r in vif_table(df, ["a", "b", "twin"]).collect()}
    want = np.diag(np.linalg.inv(np.corrcoef(np.column_stack([a, b, df.toPandas()["twin"]]).T)))
    assert [found["a"], found["b"], found["twin"]] == pytest.approx(list(want), rel=1e-6)
    pruned = vif_pruning(df, ["a", "b", "twin", "total", "flat"]).toPandas().set_index("feature")
    assert not pruned.kept["flat"] and pruned.kept.sum() == 2


def test_ridge_leave_one_out_is_exact(plane):
    x, alphas = ["a", "b", "c"], alpha_grid((1e-2, 1e2))[::8]
    c = total(feature_grams(plane, x, "y")).centred()
    got = ridge_loo(plane, x, {-1: c}, alphas)[-1]
    p = plane.toPandas()
    z = (p[x] - p[x].mean()) / p[x].std(ddof=0)
    z, y = z.to_numpy(), p.y.to_numpy()
    for alpha, sse in zip(alphas, got):
        errors = []
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            mean = z[keep].mean(0)
            zc = z[keep] - mean
            b = np.linalg.solve(zc.T @ zc + alpha * np.eye(3), zc.T @ (y[keep] - y[keep].mean()))
            errors.append(y[i] - y[keep].mean() - (z[i] - mean) @ b)
        assert sse == pytest.approx(np.sum(np.square(errors)), rel=1e-8)


def test_lasso_conditions(plane):
    df = plane.withColumn("fold", F.pmod(F.xxhash64("a"), F.lit(5)))
    grams = feature_grams(df, ["a", "b", "c"], "y", "fold")
    alpha, errors = lasso_cv(grams, alpha_grid((1e-3, 1e2)))
    c = total(grams).centred()
    beta = solve_lasso(c, 0.3)
    gradient = (c.zy - c.zz @ beta) / c.n
    for b, g in zip(beta, gradient):        # optimality of coordinate descent
        assert abs(g - 0.3 * np.sign(b)) < 1e-6 if b else abs(g) <= 0.3 + 1e-6
    fold = df.toPandas()
    held = fold.fold == 2
    intercept, coef = total({g: v for g, v in grams.items() if g != 2}).centred().original(
        solve_lasso(total({g: v for g, v in grams.items() if g != 2}).centred(), 0.3))
    want = ((fold.y - intercept - fold[["a", "b", "c"]] @ coef)[held] ** 2).sum()
    assert grams[2].squared_error(intercept, coef) == pytest.approx(want)
    assert 1e-3 <= alpha <= 1e2 and len(errors) == 25


def test_logistic_scaling_equals_newton(make, rng):
    """Objective: C * summed loss + half the squared norm on standardised features."""
    x = rng.normal(size=(200, 2)) * [1, 20]
    y = (rng.uniform(size=200) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    df = make(x0=x[:, 0], x1=x[:, 1], y=y, weight=np.ones(200), row_key=np.arange(200))
    fit = m.fit_mllib("Logistic Regression", "classification", df, ["x0", "x1"], m.Settings(logistic_c=0.5), 2, 200)
    z = np.column_stack([np.ones(200), x / x.std(0, ddof=1)])
    b = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ b))
        penalty = np.diag([0, 1, 1]) / 0.5
        b -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (p - y) + penalty @ b)
    assert list(fit.model.coefficients) == pytest.approx(list(b[1:] / x.std(0, ddof=1)), rel=1e-4)


def test_logit_baseline_equals_newton(classification):
    from rolewise.operators.baseline import logit_baseline
    frame = prepare(classification, "label", ["x1", "x2"], "classification")
    base = logit_baseline(frame)
    p = frame.train.toPandas()
    z, b = np.column_stack([np.ones(len(p)), p[["x0", "x1"]]]), np.zeros(3)
    for _ in range(50):
        mu = 1 / (1 + np.exp(-z @ b))
        hessian = z.T @ (z * (mu * (1 - mu))[:, None])
        b = b + np.linalg.solve(hessian, z.T @ (p.y - mu))
    assert [t[1] for t in base.terms] == pytest.approx(list(b), rel=1e-5)
    assert [t[2] for t in base.terms] == pytest.approx(list(np.sqrt(np.diag(np.linalg.inv(hessian)))), rel=1e-4)
    share = p.y.mean()
    fit = (p.y * np.log(mu) + (1 - p.y) * np.log(1 - mu)).sum()
    null = len(p) * (share * np.log(share) + (1 - share) * np.log(1 - share))
    assert base.stats["r2"] == pytest.approx(1 - fit / null, rel=1e-5)


def test_separated_classes_skip_the_logit(make):
    from rolewise.operators.baseline import logit_baseline
    frame = prepare(make(x=np.arange(200.0), label=[0] * 100 + [1] * 100), "label", ["x"], "classification")
    assert logit_baseline(frame).kind == "skipped"


def test_scores(make, rng):
    truth, guess = rng.integers(0, 3, 300), rng.integers(0, 3, 300)
    df = make(y=truth, prediction=guess)
    row = class_metrics(confusion_counts(df)).first()
    f1 = [2 * ((truth == k) & (guess == k)).sum() / ((truth == k).sum() + (guess == k).sum()) for k in range(3)]
    assert row["Accuracy"] == pytest.approx((truth == guess).mean())
    assert row["F1_weighted"] == pytest.approx(np.average(f1, weights=[(truth == k).sum() for k in range(3)]))
    assert confusion_matrix(df, make(label=[0, 1, 2, 7])).count() == 16
    score, label = rng.integers(0, 9, 300) / 9.0, rng.integers(0, 2, 300)
    a, b = score[label == 1], score[label == 0]
    want = ((a[:, None] > b[None]).mean() + 0.5 * (a[:, None] == b[None]).mean())
    assert roc_auc(make(y=label, score=score)).first()["ROC_AUC"] == pytest.approx(want)


def test_split_keeps_classes(make, rng):
    df = make(k=np.arange(5_000), c=["big"] * 4_900 + ["small"] * 97 + ["pair"] * 2 + ["one"])
    out = stratified_split(df, "c", keys=["k"]).toPandas()
    share = out.groupby("c").is_train.mean()
    assert abs(share["big"] - 0.8) < 0.02 and share["small"] == pytest.approx(78 / 97)
    assert share["pair"] == 0.5 and share["one"] == 1.0 and len(out) == 5_000


def test_split_keeps_every_one_of_many_small_classes(spark):
    df = spark.range(30_000).select(F.col("id").alias("k"), F.floor(F.col("id") / 2).alias("c"))
    sides = stratified_split(df, "c", keys=["k"]).groupBy("c").agg(F.countDistinct("is_train").alias("s"))
    assert sides.filter("s = 2").count() == sides.count() == 15_000


def test_split_of_copies_and_nulls(make):
    df = make(c=["a"] * 40 + [None] * 10, k=[1] * 30 + list(range(2, 22)))
    out = stratified_split(df, "c", keys=["k"]).toPandas()
    assert len(out) == 50 and out[out.k == 1].is_train.nunique() == 1
    assert out.groupby(out.c.fillna("")).is_train.nunique().tolist() == [2, 2]


@pytest.mark.parametrize("kind", ["classification", "regression"])
def test_features_are_learnt_from_training_rows_only(make, rng, monkeypatch, kind):
    """The split that encodings are learnt on is the split of the models, with the user's keys."""
    from rolewise.operators import modeling
    from rolewise.plans import analyze as plan

    n, seen = 400, {}
    city = rng.integers(0, 40, n)
    y = (city % 2 + (rng.uniform(size=n) < 0.2)).clip(0, 1) if kind == "classification" else city + rng.normal(size=n)
    df = make(id=np.arange(n) + 10_000, city=[f"c{c}" for c in city], x=rng.normal(size=n).round(3), y=y)
    real = plan.engineer, modeling.prepare
    monkeypatch.setattr(plan, "engineer", lambda *a: seen.update(learnt=a[5]) or real[0](*a))
    monkeypatch.setattr(modeling, "prepare", lambda *a: seen.setdefault("frame", real[1](*a)))
    out = plan.analyze(df, "y", fit_on_train=True, keys=["id"], model_names=["Linear Regression", "Logistic Regression"])
    learnt = {r[0] for r in seen["learnt"].select("_row_key").collect()}
    assert learnt == {r[0] for r in seen["frame"].train.select("row_key").collect()}
    assert seen["frame"].n_test == seen["frame"].test.count() > 40
    keyed = df.select(row_hash(df, ["id"], 42)).collect()
    assert learnt < {r[0] for r in keyed} and not {"_row_key", "_is_train"} & {*out.features.table.columns, *out.features.columns}


def test_folds_hold_every_class(spark):
    for seed in range(3):
        df = spark.range(505).select(F.xxhash64(F.lit(seed), "id").alias("row_key"), F.when(F.col("id") < 5, 1.0).otherwise(0.0).alias("y"))
        counts = with_folds(df, "classification", 5, seed).groupBy("y", "fold").count().toPandas()
        assert counts[counts.y == 1].set_index("fold")["count"].to_dict() == dict.fromkeys(range(5), 1)
        assert counts[counts.y == 0]["count"].between(98, 102).all()


def test_prepare_does_not_depend_on_partitioning(regression):
    a = prepare(regression.repartition(1), "target", ["x1", "x2"], "regression").table.toPandas()
    b = prepare(regression.repartition(7), "target", ["x1", "x2"], "regression").table.toPandas()
    pd.testing.assert_frame_equal(a.sort_values("row_key", ignore_index=True), b.sort_values("row_key", ignore_index=True))


def test_donors_are_a_permutation(spark):
    df = spark.range(20_000).select(F.col("id").alias("row_key"), F.lit(0.0).alias("y"), F.col("id").cast("double").alias("x0"))
    rows = donor_rows(df, ["x0"], 20_000, 2)
    for r in range(2):
        got = rows.filter(F.col("repeat") == r).select(F.col("_donor.x0").alias("v"), "x0").toPandas()
        assert len(got) == 20_000 and sorted(got.v) == sorted(got.x0) and (got.v != got.x0).mean() > 0.99


def test_donors_of_equal_keys(spark):
    """A third of the rows has one key: all give once, and copies are dealt to ranges like other rows."""
    df = spark.range(0, 9_000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("row_key"), F.lit(0.0).alias("y"),
                                            F.col("id").cast("double").alias("x0"))
    got = donor_rows(df, ["x0"], 400_000 * 8, 3).toPandas()
    for _, rows in got.groupby("repeat"):
        assert sorted(rows["_donor"].map(lambda d: d["x0"])) == sorted(rows["x0"]) == list(range(9_000))
    one = donor_rows(df.limit(1), ["x0"], 1, 2).collect()
    assert len(one) == 2 and all(r["_donor"]["x0"] == r["x0"] for r in one)
    assert donor_rows(df.limit(0), ["x0"], 0, 2).count() == 0


def test_tree_text():
    nodes = read_tree("DecisionTree\n  If (feature 1 <= 0.5)\n   Predict: 1.0\n  Else (feature 1 > 0.5)\n"
                      "   If (feature 0 <= -2.0)\n    Predict: 2.0\n   Else (feature 0 > -2.0)\n    Predict: 3.0\n")
    assert [n["prediction"] for n in nodes] == [None, 1.0, None, 2.0, 3.0]
    assert nodes[4]["path"] == [(0, False), (2, False)]


def test_label_codes(make):
    rows = label_codes(make(c=["b", "a", "b", None]), "c").collect()
    assert [(r["label"], r["code"], r["n"]) for r in rows] == [("a", 0, 1), ("b", 1, 2)]


def test_folds_compare_all_classifiers(classification, monkeypatch):
    """cv_comparison leaves no candidate out; fold scores are those of each model alone."""
    seen = {}

    def quick(df, target, features, task, **asked):
        seen["run"] = run_models(classification, "label", ["x1", "x2"], task, settings=m.Settings(forest_trees=5, boosting_rounds=4), **{
            k: v for k, v in asked.items() if k not in ("settings", "keys")})
        return seen["run"]

    monkeypatch.setattr(catalog, "run_models", quick)
    spark = classification.sparkSession
    rows = catalog.compared_by_folds(spark, "/root/testdata/sf0.001").collect()
    folds = {(r["model"], r["metric"]) for r in rows if r["fold"] == 4}
    assert folds == {(n, k) for n in m.CLASSIFIERS for k in ("Accuracy", "F1_weighted", "Balanced_Accuracy", "ROC_AUC")}
    frame, settings = seen["run"].frame, m.Settings(forest_trees=5, boosting_rounds=4)
    train, held_out = frame.table.filter("fold != 2"), frame.table.filter("fold = 2")
    for fit in m.fit_all(list(m.CLASSIFIERS), "classification", train, frame.x, settings, 2, train.count()):
        assert seen["run"].fold_scores[fit.name][2] == pytest.approx(score(fit.apply(held_out), "classification", 2), abs=1e-9)
