import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rolewise.operators.association import (_exact_u, anova, association_suite, chi_square, chi_square_statistics,
                                            mann_whitney, mann_whitney_statistics, shapiro_tests, wilcoxon)
from rolewise.operators.charts import pca
from rolewise.catalog import segments
from rolewise.operators import kmeans
from rolewise.operators.kmeans import _sums_of, fit_sweep
from rolewise.operators.roles import infer_roles
from rolewise.operators.segments import find_segments, silhouette_scores, squared_silhouettes


@pytest.fixture
def blobs(make, rng):
    centres = np.array([[0, 0], [10, 10], [-10, 10]])
    points = np.repeat(centres, 40, axis=0) + rng.normal(0, 0.5, (120, 2))
    return make(x=points[:, 0], y=points[:, 1], flat=[5] * 120)


def test_three_blobs(blobs):
    found = find_segments(blobs, ["x", "y", "flat"], ks=(2, 3, 4, 5), restarts=4)
    assert found.k == 3 and found.silhouette > 0.5 and found.columns == ["x", "y"]
    assert sorted(r["n"] for r in found.sizes().collect()) == [40, 40, 40]


def test_gates(blobs, make):
    assert find_segments(blobs, ["x"]) is None
    assert find_segments(blobs, ["x", "flat"]) is None
    assert find_segments(make(a=[1.0, 2.0], b=[3.0, 4.0]), ["a", "b"]) is None


def test_sweep_reaches_the_best_cost(blobs):
    fit = fit_sweep(blobs, ["x", "y"], [3], restarts=5)[3]
    points = blobs.select("x", "y").toPandas().to_numpy()
    want = sum(((g - g.mean(0)) ** 2).sum() for g in np.split(points, 3))
    assert fit.cost == pytest.approx(want, rel=1e-6)


def test_fit_uses_every_row(make, rng):
    """The starting sample is bounded, the fit is not: means are those of all rows."""
    x = np.concatenate([rng.normal(0, 1, 20_000), rng.normal(50, 1, 10_000)])
    fit = fit_sweep(make(x=x, y=x), ["x", "y"], [2], restarts=2)[2]
    assert sorted(c[0] for c in fit.centres) == pytest.approx([x[:20_000].mean(), x[20_000:].mean()], rel=1e-9, abs=1e-9)


def test_silhouette_brute_force(make, rng):
    points, labels = rng.normal(size=(60, 3)), rng.integers(0, 4, 60)
    labels[0] = 9
    df = make(a=points[:, 0], b=points[:, 1], c=points[:, 2], l=labels)
    apart = np.linalg.norm(points[:, None] - points[None], axis=2)
    scores = []
    for i in range(60):
        own = (labels == labels[i]) & (np.arange(60) != i)
        if not own.any():
            scores.append(0.0)
            continue
        a = apart[i, own].mean()
        b = min(apart[i, labels == k].mean() for k in set(labels) - {labels[i]})
        scores.append((b - a) / max(a, b))
    assert silhouette_scores(df, ["a", "b", "c"], ["l"])["l"] == pytest.approx(np.mean(scores))


def test_pca_variance(make, rng):
    data = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4))
    rows, shares = pca(make(**{f"c{i}": data[:, i] for i in range(4)}), [f"c{i}" for i in range(4)])
    want = np.sort(np.linalg.eigvalsh(np.corrcoef(data.T)))[::-1]
    assert [r[1] for r in shares.orderBy("component").collect()] == pytest.approx(list(want[:2] / 4))
    projected = rows.toPandas()
    assert projected["pc1"].var(ddof=0) == pytest.approx(want[0])


def test_chi_square_planted(make, rng):
    group = rng.choice(["A", "B"], 400)
    label = (rng.uniform(size=400) < np.where(group == "A", 0.9, 0.1)).astype(int)
    df = make(group=group, unrelated=rng.choice(["X", "Y", "Z"], 400), many=[f"v{i % 30}" for i in range(400)], label=label)
    found = {r["feature"]: r for r in chi_square(df, ["group", "unrelated", "many"], "label").collect()}
    assert found["group"]["significant"] and not found["unrelated"]["significant"] and "many" not in found


@pytest.mark.parametrize("table", [[[10, 0], [0, 12]], [[5, 0], [7, 9]], [[3, 4], [5, 6]], [[1, 0, 4], [2, 6, 0]]])
def test_chi_square_with_empty_cells(make, table):
    cells = [(f"r{i}", f"c{j}") for i, row in enumerate(table) for j, n in enumerate(row) for _ in range(n)]
    df = make(f=[c[0] for c in cells], y=[c[1] for c in cells])
    o = np.array(table, dtype=float)
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    gap = np.abs(o - e)
    if o.shape == (2, 2):
        gap = gap - np.minimum(0.5, gap)
    assert chi_square_statistics(df, ["f"], "y").first()["statistic"] == pytest.approx((gap ** 2 / e).sum())


def test_anova(make, rng):
    label = np.repeat(["low", "mid", "high"], 30)
    df = make(signal=np.repeat([0.0, 2.0, 4.0], 30) + rng.normal(size=90), noise=rng.normal(size=90), label=label)
    found = {r["feature"]: r for r in anova(df, ["signal", "noise"], "label").collect()}
    assert found["signal"]["significant"] and found["signal"]["p_value"] < 1e-6
    assert anova(df.filter("label <> 'mid'"), ["signal"], "label").count() == 0


def test_mann_whitney_brute_force_with_hot_ties(make, rng):
    x = np.where(rng.uniform(size=300) < 0.35, 4.0, rng.integers(0, 40, 300))
    y = rng.choice(["a", "b"], 300)
    row = mann_whitney_statistics(make(x=x, y=y), ["x"], "y", ("a", "b")).first()
    first, second = x[y == "a"], x[y == "b"]
    want = (first[:, None] > second[None]).sum() + 0.5 * (first[:, None] == second[None]).sum()
    assert row["u1"] == want
    assert row["ties"] == sum(c ** 3 - c for c in pd.Series(x).value_counts())


def test_mann_whitney_gates_and_signal(make, rng):
    label = np.repeat([0, 1], 100)
    df = make(signal=label * 1.5 + rng.normal(size=200), noise=rng.normal(size=200), label=label, three=np.arange(200) % 3)
    found = {r["feature"]: r for r in mann_whitney(df, ["signal", "noise"], "label").collect()}
    assert found["signal"]["significant"]
    assert mann_whitney(df, ["signal"], "three").count() == 0


def test_exact_u():
    assert _exact_u(9, 3, 3) == pytest.approx(0.1)
    assert _exact_u(25, 5, 5) == pytest.approx(2 / 252)
    assert _exact_u(8, 2, 4) == pytest.approx(2 / 15)


def test_suite_is_for_classification_only(classification):
    roles = infer_roles(classification, "label")
    names = {r["test_name"] for r in association_suite(classification, roles).collect()}
    assert names == {"Chi-square", "Mann-Whitney U"}
    assert association_suite(classification, infer_roles(classification, "x1")).count() == 0


def test_shapiro(make, rng):
    rows = {r["feature"]: r for r in shapiro_tests(make(a=rng.exponential(size=500), b=rng.normal(size=500)), ["a", "b"]).collect()}
    assert rows["a"]["significant"] and rows["a"]["p_value"] < 1e-6 and rows["b"]["statistic"] > 0.98
    assert shapiro_tests(make(a=[1.0, 2.0]), ["a"]).count() == 0


def test_wilcoxon():
    assert wilcoxon([0.9, 0.8, 0.7, 0.85, 0.95], [0.8, 0.7, 0.6, 0.8, 0.9]) == (0.0, 0.0625)
    assert wilcoxon([1.0, 2.0], [1.0, 2.0]) is None


def test_statistics_do_not_depend_on_partitioning(classification):
    one = mann_whitney(classification.repartition(1), ["x1", "x2"], "label").collect()
    many = mann_whitney(classification.repartition(9), ["x1", "x2"], "label").collect()
    assert one == many
    assert classification.agg(F.count("x1")).first()[0] == 300


def test_squared_silhouettes_against_all_pairs(make, rng):
    n = 150
    x = rng.normal(size=(n, 3)) + 1e4
    labels, single = rng.integers(0, 4, n), np.zeros(n, dtype=int)
    x[:, 0] += labels
    labels[0] = 9                                            # a cluster of one
    square = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    scores = []
    for i in range(n):
        own = labels == labels[i]
        a = square[i, own].sum() / max(own.sum() - 1, 1)
        b = min(square[i, labels == other].mean() for other in set(labels) if other != labels[i])
        scores.append((b - a) / max(a, b) if own.sum() > 1 else 0.0)
    df = make(a=x[:, 0], b=x[:, 1], c=x[:, 2], l=labels, s=single).repartition(5)
    found = squared_silhouettes(df, ["a", "b", "c"], ["l", "s"])
    assert found["l"] == pytest.approx(np.mean(scores)) and found["s"] is None
    assert squared_silhouettes(df.limit(0), ["a"], ["l"]) == {"l": None}


def test_cost_is_that_of_the_returned_centres(make, rng):
    x = rng.normal(size=(400, 2)) + rng.integers(0, 3, (400, 1)) * 6
    fits = fit_sweep(make(a=x[:, 0], b=x[:, 1]), ["a", "b"], [2, 3, 5], restarts=3)
    for k, fit in fits.items():
        apart = ((x[:, None, :] - np.array(fit.centres)[None]) ** 2).sum(2).min(1)
        assert len(fit.centres) == k and fit.cost == pytest.approx(apart.sum()) and fit.converged in (True, False)
    assert fits[3].converged


def test_kmeans_sums_match_brute_force_in_little_memory():
    """Sums, counts and costs of all runs, the first of equal centres on a tie, with distances of a lot of rows at a time."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(50_000, 3)), 1)
    runs = [np.array([[0.0, 0, 0], [0.0, 0, 0], [1.03, 1.07, 0.91]])] + [rng.normal(size=(k, 3)) for k in (2, 2, 5, 8) for _ in range(10)]
    sums = np.zeros((sum(map(len, runs)), 5))
    tracemalloc.start()
    _sums_of(np.ascontiguousarray(x.T), runs, sums)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20                                       # all distances at once take 70 MB
    at = 0
    for centres in runs:
        apart = ((x[:, None, :] - centres[None]) ** 2).sum(2)
        near = apart.argmin(1)
        for c in range(len(centres)):
            mine = near == c
            assert sums[at + c, -2] == mine.sum()
            np.testing.assert_allclose(sums[at + c, :3], x[mine].sum(0), atol=1e-8)
            np.testing.assert_allclose(sums[at + c, -1], apart[mine, c].sum(), rtol=1e-9, atol=1e-8)
        at += len(centres)


def test_sweep_brings_every_restart_to_rest_from_all_rows(make, rng, monkeypatch):
    """Ten restarts per k: each starts from rows of the table and ends where another Lloyd step leaves it; no sample, no race."""
    x = rng.uniform(size=(3_000, 2))
    runs = {}
    lloyd = kmeans._lloyd

    def kept(blocks, given, tolerance):
        runs["start"] = [run.copy() for run in given]
        moving = lloyd(blocks, given, tolerance)
        runs["end"], runs["moving"], runs["tolerance"] = given, moving, tolerance
        return moving

    monkeypatch.setattr(kmeans, "_lloyd", kept)
    fits = fit_sweep(make(a=x[:, 0], b=x[:, 1]).repartition(3), ["a", "b"], [2, 3, 5], scored=True)
    rows = set(map(tuple, x.tolist()))
    assert sorted(map(len, runs["end"])) == [2] * 10 + [3] * 10 + [5] * 10 and not runs["moving"]
    assert all(tuple(centre) in rows for run in runs["start"] for centre in run.tolist())
    assert runs["tolerance"] == pytest.approx(1e-4 * x.var(0).mean())
    costs = {}
    for run in runs["end"]:
        apart = ((x[:, None, :] - run[None]) ** 2).sum(2)
        moved = np.array([x[apart.argmin(1) == c].mean(0) for c in range(len(run))])
        assert ((moved - run) ** 2).sum() < 2 * runs["tolerance"]
        costs.setdefault(len(run), []).append(apart.min(1).sum())
    assert {k: f.cost for k, f in fits.items()} == pytest.approx({k: min(c) for k, c in costs.items()})


def test_sweep_silhouettes_score_all_rows(make, rng):
    x = rng.normal(size=(7_000, 2)) + rng.integers(0, 3, (7_000, 1)) * 6
    df = make(a=x[:, 0], b=x[:, 1])
    fits = fit_sweep(df, ["a", "b"], [2, 3, 4], restarts=3, scored=True)
    labelled = df.select("a", "b", *[kmeans.assign(["a", "b"], f.centres).alias(f"k{k}") for k, f in fits.items()])
    want = squared_silhouettes(labelled, ["a", "b"], ["k2", "k3", "k4"])
    assert {f"k{k}": f.silhouette for k, f in fits.items()} == pytest.approx(want)


def test_starts_are_drawn_by_squared_distance(spark):
    """A draw among 0 (30 rows), 1 (20 rows) and 3 (10 rows), from a first centre at 0: 20 to 90 for 1 and 3."""
    rows = np.repeat([0.0, 1.0, 3.0], [30, 20, 10])
    blocks = spark.sparkContext.parallelize([rows[None, :25], rows[None, 25:40], rows[None, 40:]], 3)
    found = [start.ravel().tolist() for seed in range(8) for start in kmeans._starts(blocks, 1, 1, 100, seed)]
    assert np.unique(found, return_counts=True)[1] / 800 == pytest.approx([0.5, 1 / 3, 1 / 6], abs=0.06)
    pairs = [tuple(start.ravel()) for seed in range(8) for start in kmeans._starts(blocks, 1, 2, 100, seed)]
    second = [b for a, b in pairs if a == 0.0]                     # the better of two draws: 3 unless both are 1
    assert 0.0 not in second and second.count(1.0) / len(second) == pytest.approx((20 / 110) ** 2, abs=0.04)


def test_sweep_names_cost_and_silhouette(spark):
    rows = segments.sweep(spark, "/root/testdata/sf0.001").collect()
    assert [r["k"] for r in rows] == list(range(2, 9)) and all(-1 <= r["silhouette"] <= 1 for r in rows)
    assert all(a["cost"] > b["cost"] for a, b in zip(rows, rows[1:]))
