"""Forests: a tree against plain recursion, free depth, both phases and both ways of prediction, hot values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolewise.operators import forest as f
from rolewise.operators import models as m


def frame(spark, x, y, parts=5):
    rows = [(*map(float, r), float(t), 1.0, i) for i, (r, t) in enumerate(zip(x, y))]
    names = [f"x{j}" for j in range(len(x[0]))]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", y double, weight double, row_key long").repartition(parts), names


def predicted(model, df, names):
    rows = model.outputs(df, names).select("row_key", "_outputs").collect()
    return np.array([r["_outputs"] for r in sorted(rows, key=lambda r: r["row_key"])])


def plain(x, y, w, classes, min_leaf, rows=None, depth=None):
    """Value of each row by recursion with all splits tried."""
    rows = np.arange(len(y)) if rows is None else rows
    out = {}
    k = int(y.max()) + 1 if classes else 1
    hot = np.eye(k)[y.astype(int)] if classes else y[:, None]

    def part(r):
        return ((w[r, None] * hot[r]).sum(0) ** 2).sum() / w[r].sum()

    def go(r, left):
        best = None
        if len(np.unique(y[r])) > 1 and left != 0:
            for j in range(x.shape[1]):
                values = np.unique(x[r, j])
                for a in values[:-1]:
                    lo, hi = r[x[r, j] <= a], r[x[r, j] > a]
                    if min(len(lo), len(hi)) >= min_leaf and (best is None or part(lo) + part(hi) > best[0] + 1e-9):
                        best = (part(lo) + part(hi), lo, hi)
        if best is None:
            out.update(dict.fromkeys(r.tolist(), (w[r, None] * hot[r]).sum(0) / w[r].sum()))
        else:
            go(best[1], None if left is None else left - 1)
            go(best[2], None if left is None else left - 1)
    go(rows, depth)
    return np.array([out[i] for i in rows])


@pytest.mark.parametrize("classes,min_leaf,depth", [(False, 1, None), (False, 4, None), (True, 3, None), (False, 1, 3), (True, 1, None)])
def test_a_tree_against_plain_recursion(rng, classes, min_leaf, depth):
    x = rng.integers(0, 12, (150, 3)).astype(float)
    y = rng.integers(0, 3, 150).astype(float) if classes else rng.normal(size=150)
    w = rng.integers(1, 4, 150).astype(float)
    part = f.grow(x, y, w, classes, 3, min_leaf, depth, 5)
    out = np.zeros((150, 3 if classes else 1))
    part.add(x, out, np.arange(150))
    want = plain(x, y, w, classes, min_leaf, depth=depth)
    if classes and min_leaf == 1:           # equal gains may be split otherwise, but leaves are pure or equal in x
        _, group = np.unique(x, axis=0, return_inverse=True)
        want = np.array([(w[group == g, None] * np.eye(3)[y[group == g].astype(int)]).sum(0) / w[group == g].sum() for g in group.ravel()])
    assert np.allclose(out, want)


def test_staircase_of_depth_16_is_exact(spark):
    """Steps that grow threefold: best splits peel one step at a time, so a tree of depth 12 cannot reach them all."""
    x = [[i % 20] for i in range(1600)]
    df, names = frame(spark, x, [3.0 ** (v[0]) for v in x])
    for limit in (50_000, 100):                                 # one task a tree, histograms first
        model = f.fit_forest(df, names, "regression", 0, 1600, 4, fit_rows=limit)
        assert model.depth >= 16 and (model.passes == 0) == (limit > 1600)
        assert np.allclose(predicted(model, df, names)[:, 0], [3.0 ** (v[0]) for v in x], atol=1e-4)
    assert f.fit_forest(df, names, "regression", 0, 1600, 2, max_depth=3).depth == 3


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_phases_ways_of_prediction_and_partitioning_agree(spark, rng, task, monkeypatch):
    x = rng.integers(0, 50, (1200, 4)).astype(float)            # fewer values than bins: histograms are exact
    y = x[:, 0] * 2 + x[:, 1] ** 2 + rng.normal(size=1200) if task == "regression" else (x[:, 0] + x[:, 1] > 50) + (x[:, 2] > 40)
    df, names = frame(spark, x, y)
    k = 0 if task == "regression" else 3
    args = (names, task, k, 1200, 5, None, 2, "sqrt")
    whole = predicted(f.fit_forest(df, *args), df, names)
    halves = predicted(f.fit_forest(df.repartition(3), *args, fit_rows=150), df, names)
    apart = np.abs(whole - halves).max(axis=1) / np.abs(whole).max()
    assert np.median(apart) < 1e-9 and np.mean(apart > 1e-6) < 0.08       # limits lie between values of the column, not of the drawn rows
    monkeypatch.setattr(f, "TASK_BYTES", 0)
    model = f.fit_forest(df, *args, fit_rows=150)
    assert model._near is None and np.allclose(predicted(model, df, names), halves)


def test_hot_and_clumped_values_are_cut_anew(spark, rng):
    """A third of the rows on one value, a third within a billionth of another: bins of the column hold them together."""
    near = 5.0 + rng.integers(0, 300, 600) * 1e-12
    x = np.concatenate([np.full(600, 1.0), near, rng.uniform(1e9, 1e12, 600)])
    y = np.where(x == 1.0, 0.0, np.where(x < 10, np.round((x - 5.0) * 1e12) // 20, 40.0))
    df, names = frame(spark, x[:, None], y)
    model = f.fit_forest(df, names, "regression", 0, 1800, 3, fit_rows=50)
    assert all(not t.open for t in model.tops) and any(t.stop for t in model.tops)      # the hot value is a leaf of many rows
    assert np.abs(predicted(model, df, names)[:, 0] - y).mean() < 0.2


def test_steps_reach_single_values():
    for low, high in ((-1.0, 1.0), (0.0, 5e-324), (-1e300, -1.0), (1.0, np.nextafter(np.nextafter(1.0, 2), 2))):
        steps = f._steps(low, high)
        assert (np.diff(steps) > 0).all() and steps[0] == low and steps[-1] < high
    assert (f._double(f._ordered(np.array([-3.5, 0.0, 2.25]))) == [-3.5, 0.0, 2.25]).all()


def test_draws_have_mean_one():
    counts = f.draws(np.arange(200_000, dtype=np.uint64), 3, 42)
    assert abs(counts.mean() - 1) < 0.01 and abs(counts.var() - 1) < 0.02 and (counts != f.draws(np.arange(200_000, dtype=np.uint64), 4, 42)).any()


def test_models_and_search(spark, rng):
    x = rng.normal(size=(300, 2))
    for task, y, k in (("regression", x[:, 0] * 3, 0), ("classification", (x[:, 0] > 0).astype(int), 2)):
        df, names = frame(spark, x, y)
        fitted = m.fit_all([m.FOREST], task, df, names, m.Settings(forest_trees=20), k, 300)[0]
        assert fitted.parameters == {"n_estimators": 20, "max_depth": None}
        out = fitted.apply(df)
        assert ("score" in out.columns) == (k == 2) and out.filter(F.abs(F.col("prediction") - F.col("y")) < 1).count() > 280


@pytest.mark.parametrize("y", [[3.0] * 50, [1.0]])
def test_nothing_to_learn(spark, y):
    df, names = frame(spark, [[float(i)] for i in range(len(y))], y)
    assert np.allclose(predicted(f.fit_forest(df, names, "regression", 0, len(y), 4), df, names), y[0])
    assert np.allclose(predicted(f.fit_forest(df, names, "regression", 0, len(y), 4, fit_rows=10), df, names), y[0])


@pytest.mark.parametrize("n_codes", [0, 2, 3, 12])
def test_first_split_against_all_splits(rng, n_codes):
    """The gain of a stump is the best of all, for numbers and for classes on both sides of the limit of running weights by class."""
    from rolewise.operators.forest import FEW_CLASSES, grow
    x, w = rng.integers(0, 40, (500, 3)).astype(float), rng.integers(1, 4, 500).astype(float)
    y = rng.integers(0, n_codes, 500).astype(float) if n_codes else x[:, 1] ** 2 + rng.normal(size=500)
    assert n_codes <= 3 or n_codes > FEW_CLASSES

    def gain(left):
        sides = [(y[s], w[s]) for s in (left, ~left)]
        return sum((np.bincount(t.astype(int), v) ** 2).sum() / v.sum() if n_codes else (t * v).sum() ** 2 / v.sum() for t, v in sides)
    part = grow(x, y, w, n_codes > 0, 3, 4, 1, 7)
    tried = [x[:, j] <= t for j in range(3) for t in np.unique(x[:, j])[:-1]]
    best = max(gain(left) for left in tried if min(left.sum(), (~left).sum()) >= 4)
    assert np.isclose(gain(x[:, part.feature[0]] <= part.threshold[0]), best, rtol=1e-12)


@pytest.mark.parametrize("classes", [False, True])
def test_features_of_two_values_split_as_by_brute_force(classes, monkeypatch):
    """Features of two values need no order; the tree is the one that orders of all features give."""
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=400), np.where(rng.random(400) < 0.3, -1.5, 2.25), (rng.random(400) < 0.5) * 1.0, np.full(400, 7.0)])
    y = x[:, 0] + 3 * (x[:, 1] > 0) + rng.normal(size=400)
    y = (y > y.mean()) * 1.0 if classes else y
    w = rng.integers(1, 4, 400).astype(float)
    assert sorted(f._two_valued(x.T)) == [1, 2]
    found = f.grow(x, y, w, classes, 4, 5, 3, 7)
    monkeypatch.setattr(f, "_two_valued", lambda columns: {})
    want = f.grow(x, y, w, classes, 4, 5, 3, 7)
    for name in ("feature", "threshold", "left", "right", "offset", "output"):
        np.testing.assert_array_equal(getattr(found, name), getattr(want, name))
    np.testing.assert_allclose(found.share, want.share)
    cost = lambda s: (w[s] * (y[s] - np.average(y[s], weights=w[s])) ** 2).sum()
    cuts = [(j, v) for j in range(4) for v in np.unique(x[:, j])[:-1] if 5 <= (x[:, j] <= v).sum() <= 395]
    j, v = min(cuts, key=lambda c: cost(x[:, c[0]] <= c[1]) + cost(x[:, c[0]] > c[1]))
    assert found.feature[0] == j and ((x[:, j] <= found.threshold[0]) == (x[:, j] <= v)).all()
    assert 1 in found.feature and (found.threshold[found.feature == 1] == 0.375).all()


@pytest.mark.parametrize("m_features,classes", [(1, True), (2, True), (2, False)])
def test_features_that_fall_to_a_node(rng, m_features, classes):
    """Gains are asked for some features of a node only; the split is that of all gains cut to the allowed features, the next able one included."""
    x = rng.integers(0, 9, (160, 6)).astype(float)
    x[:, 1], x[:, 4] = 3.0, x[:, 4] > 4                          # one feature never splits, one has two values
    y = rng.integers(0, 3, 160).astype(float) if classes else rng.normal(size=160)
    w = rng.integers(1, 4, 160).astype(float)
    hot = np.eye(3)[y.astype(int)] if classes else y[:, None]
    part = f.grow(x, y, w, classes, m_features, 1, None, 77)
    stack, splits = [(0, np.arange(160), np.uint64(77))], 0
    while stack:
        node, rows, place = stack.pop()
        gains, cuts = np.full(6, -np.inf), [[] for _ in range(6)]
        for j in range(6) if len(np.unique(y[rows])) > 1 else ():
            values = np.unique(x[rows, j])
            found = [(sum(((w[r, None] * hot[r]).sum(0) ** 2).sum() / w[r].sum() for r in (rows[x[rows, j] <= a], rows[x[rows, j] > a])),
                      (a + b) / 2) for a, b in zip(values, values[1:])]
            gains[j] = max((g for g, _ in found), default=-np.inf)
            cuts[j] = [c for g, c in found if g > gains[j] - 1e-9]
        chosen = f._allowed(np.array([place], np.uint64), gains[:, None], m_features)[:, 0]
        j = part.feature[node]
        assert (j >= 0) == np.isfinite(chosen).any()
        if j >= 0:
            splits += 1
            assert chosen[j] >= chosen.max() - 1e-9 and part.threshold[node] == pytest.approx(min(cuts[j], key=lambda c: abs(c - part.threshold[node])))
            left = x[rows, j] <= part.threshold[node]
            stack += [(part.left[node], rows[left], f._child(place, 0)), (part.right[node], rows[~left], f._child(place, 1))]
    assert splits > 40
