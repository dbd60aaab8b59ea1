"""Boosting: the histogram passes against plain best-first growing, known targets, classes, early stopping."""

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolewise.operators import models as m
from rolewise.operators import boosting
from rolewise.operators.boosting import Grower, best_split, boost, boost_all, folded


def frame(spark, x, y, weight=None):
    rows = [(*map(float, r), float(t), float(w), i) for i, (r, t, w) in enumerate(zip(x, y, weight if weight is not None else np.ones(len(y))))]
    names = [f"x{j}" for j in range(len(x[0]))]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", y double, weight double, row_key long").repartition(5), names


def plain_tree(x, g, h, max_leaves, min_leaf):
    """Value of each row by a tree that splits the leaf of the largest gain, all splits tried on sorted values."""
    def best(rows):
        found = None
        for f in range(x.shape[1]):
            for t in np.unique(x[rows, f])[:-1]:
                left, right = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                if min(len(left), len(right)) < min_leaf:
                    continue
                gain = sum(g[r].sum() ** 2 / h[r].sum() for r in (left, right)) - g[rows].sum() ** 2 / h[rows].sum()
                if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                    found = (gain, left, right)
        return found
    leaves, heap = [], []
    def push(rows):
        split = best(rows)
        heapq.heappush(heap, (-split[0], len(heap) + len(leaves) * 1000, rows, split)) if split else leaves.append(rows)
    push(np.arange(len(g)))
    while heap and len(heap) + len(leaves) < max_leaves:
        _, _, _, (_, left, right) = heapq.heappop(heap)
        push(left), push(right)
    out = np.zeros(len(g))
    for rows in [*leaves, *[e[2] for e in heap]]:
        out[rows] = -g[rows].sum() / h[rows].sum()
    return out


@pytest.mark.parametrize("leaves", [4, 9])
def test_best_first_against_a_plain_tree(spark, rng, leaves):
    x = rng.integers(0, 30, (300, 3)).astype(float)
    y = np.where(x[:, 0] > 12, 5 * (x[:, 1] > 20) + 9 * (x[:, 2] > 3), 2 * (x[:, 1] > 4)) + rng.normal(0, 0.3, 300)
    w = rng.choice([1.0, 2.0], 300)
    df, names = frame(spark, x, y, w)
    model = boost(df, names, "regression", 0, 300, rate=0.5, n_rounds=3, max_leaves=leaves, min_leaf=5)
    score = np.full(300, (y * w).sum() / w.sum())
    for _ in range(3):
        score = score + 0.5 * plain_tree(x, (score - y) * w, w, leaves, 5)
    got = {r["row_key"]: r["s"] for r in df.select("row_key", model.raw(names)[0].alias("s")).collect()}
    assert np.allclose([got[i] for i in range(300)], score, atol=1e-9)
    assert all(t.n_leaves <= leaves for r in model.rounds for t in r) and model.passes <= 3 * (leaves - 1)


def test_planted_steps_have_31_leaves(spark):
    """31 steps of equal width: one tree with rate 1 fits them exactly."""
    x = [[i // 5] for i in range(31 * 40)]
    df, names = frame(spark, x, [(v[0] // 8) ** 2 % 29 + 0.5 * (v[0] // 8) for v in x])
    fitted = m.fit_all([m.BOOSTING], "regression", df, names, m.Settings(boosting_rate=1.0, boosting_rounds=1), 0, len(x))[0]
    assert fitted.parameters == {"learning_rate": 1.0, "max_iter": 1, "max_leaf_nodes": 31, "n_iter": 1}
    assert fitted.model.rounds[0][0].n_leaves == 31
    assert fitted.apply(df).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 1e-9


def test_binary_and_multinomial(spark, rng):
    x = rng.normal(size=(600, 2))
    three = np.where(x[:, 0] > 0.4, 2, np.where(x[:, 1] > 0, 1, 0))
    for y, k in ((three, 3), ((three > 0).astype(int), 2)):
        df, names = frame(spark, x, y)
        fitted = m.fit_all([m.BOOSTING], "classification", df, names, m.Settings(boosting_rounds=12), k, 600)[0]
        assert all(len(trees) == (k if k > 2 else 1) for trees in fitted.model.rounds) and len(fitted.model.rounds) == 12      # past a writing of the scores
        out = fitted.apply(df)
        assert out.filter(F.col("prediction") == F.col("y")).count() > 590 and ("score" in out.columns) == (k == 2)


def test_first_round_of_classes_in_closed_form(spark):
    """One feature of two values: after a round the outputs follow from the shares by hand."""
    x, y = [[i % 2] for i in range(120)], [0 if i % 2 == 0 and i % 10 else 2 if i % 3 == 0 else 1 for i in range(120)]
    df, names = frame(spark, x, y)
    model = boost(df, names, "classification", 3, 120, rate=0.1, n_rounds=1, min_leaf=1)
    share = np.bincount(y) / 120
    base = np.log(np.clip(share, 1e-12, 1)) - np.log(np.clip(share, 1e-12, 1)).mean()
    want = {}
    for v in (0, 1):
        rows = [t for (a,), t in zip(x, y) if a == v]
        inside = np.bincount(rows, minlength=3) / len(rows)
        want[v] = base + 0.1 * (inside - share) / np.maximum(share * (1 - share), 1e-300)
    got = {int(r["x0"]): r["s"] for r in df.select("x0", model.raw(names).alias("s")).distinct().collect()}
    for v in (0, 1):
        assert np.allclose(got[v], want[v])


def test_early_stopping(spark, rng):
    x, y = rng.normal(size=(3000, 2)), rng.normal(size=3000)
    df, names = frame(spark, x, y)
    model = boost(df, names, "regression", 0, 3000, n_rounds=60, early=True)
    assert len(model.rounds) < 60 and len(model.losses) == len(model.rounds) + 1
    assert min(model.losses[-10:]) >= model.losses[-11] - 1e-7


@pytest.mark.parametrize("y", [[3.0] * 50, [1.0]])
def test_nothing_to_learn(spark, y):
    df, names = frame(spark, [[float(i)] for i in range(len(y))], y)
    model = boost(df, names, "regression", 0, len(y))
    assert len(model.rounds) == 1 and [round(r[0], 9) for r in df.select(model.raw(names)[0]).distinct().collect()] == [y[0]]


def test_search_over_boosting(spark, rng):
    x = rng.normal(size=(240, 2))
    df, names = frame(spark, x, x[:, 0] * 2 + (x[:, 1] > 0))
    found = m.fit_all([m.BOOSTING], "regression", df, names, m.Settings(search=True, boosting_rounds=4), 0, 240)[0].parameters
    assert found["learning_rate"] in (0.03, 0.1, 0.3) and found["max_iter"] in (4, 50, 200)


def test_ties_take_the_first_split():
    sums = np.zeros((2, 256, 3))
    sums[:, 0], sums[:, 7] = (-4, 4, 4), (4, 4, 4)
    assert best_split(sums, 1)[1:] == (0, 0) and best_split(sums, 5) is None
    for leaves, want in ((2, ({0: (1, 2)}, [])), (3, ({}, [0]))):            # the last split needs no look at its children
        grower = Grower(leaves, 1, None)
        grower.receive({0: sums})
        assert grower.replay() == want


@pytest.mark.parametrize("task,k", [("regression", 0), ("classification", 2), ("classification", 3)])
def test_rows_of_equal_bins_are_folded(spark, rng, task, k):
    """Copies fold into one row of their weight, and the model is that of one row a value with the copies as weights."""
    x = np.repeat(rng.integers(0, 6, (40, 2)), 5, axis=0).astype(float)
    y = (x[:, 0] + 2 * x[:, 1]) % (k or 11) if k else x[:, 0] * 3 + rng.normal(size=200)
    df, names = frame(spark, x, y)
    binned = df.select(F.encode(F.concat("x0", "x1"), "utf-8").alias("bins"), "y", "weight", F.lit(False).alias("valid"))
    rows = folded(binned, "squared" if not k else "softmax").toPandas()
    assert len(rows) == len({tuple(r) for r in x}) and rows["n"].sum() == 200 and np.isclose((rows["y"] * rows["weight"]).sum(), y.sum())
    within = sum(((y[(x == v).all(axis=1)] - y[(x == v).all(axis=1)].mean()) ** 2).sum() for v in np.unique(x, axis=0)) / 2
    assert np.isclose(rows["off"].sum(), 0.0 if k else within)
    cells = {(*r, t if k else 0.0): [] for r, t in zip(x, y)}
    for r, t in zip(x, y):
        cells[(*r, t if k else 0.0)].append(t)
    few, _ = frame(spark, [c[:2] for c in cells], [np.mean(v) for v in cells.values()], [len(v) for v in cells.values()])
    models = [boost(d, names, task, k, 200, n_rounds=3, max_leaves=4, min_leaf=1) for d in (df, few)]
    a, b = ({(r["x0"], r["x1"]): r["s"] for r in df.select("x0", "x1", m.raw(names).alias("s")).distinct().collect()} for m in models)
    assert all(np.allclose(a[c], b[c]) for c in a)


@pytest.mark.parametrize("task,k", [("regression", 0), ("classification", 2), ("classification", 3)])
def test_fits_side_by_side_equal_fits_alone(spark, rng, monkeypatch, task, k):
    """Folds that share passes, folds made by a task each, and fits one by one give the same trees and losses."""
    x = rng.normal(size=(900, 3)).round(1)
    y = x[:, 0] * 2 + x[:, 1] ** 2 if task == "regression" else (x[:, 0] + rng.normal(0, 0.5, 900) > 0) + (x[:, 1] > 1) * (k > 2)
    df, names = frame(spark, x, y)
    trains = [df.filter(F.col("row_key") % 3 != f) for f in range(2)] + [df.filter("row_key < 60")]       # the last one rests first
    setting = {"n_rounds": 12, "rate": 0.5, "max_leaves": 6, "early": True}
    in_tasks = boost_all(trains, names, task, k, 600, **setting)
    monkeypatch.setattr(boosting, "TASK_CELLS", 0)
    monkeypatch.setattr(boosting, "PIECE_ROWS", 100)
    shared = boost_all(trains, names, task, k, 600, **setting)
    alone = [boost(train, names, task, k, 600, **setting) for train in trains]
    assert alone[0].passes == shared[0].passes > 10
    for a, b, c in zip(in_tasks, shared, alone):
        assert len(a.rounds) == len(b.rounds) == len(c.rounds) > 0 and len(a.losses) == len(b.losses) == len(c.losses)
        for other in (b, c):
            assert np.allclose(a.losses, other.losses)
            for t, u in zip(sum(a.rounds, []), sum(other.rounds, [])):
                assert (t.feature == u.feature).all() and np.allclose(t.threshold, u.threshold) and np.allclose(t.value, u.value)
