import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rolewise.functions import pvalues, quantiles
from rolewise.functions.quantiles import exact_quantiles, grouped_quantiles, grouped_ranks
from rolewise.functions.ranks import running_counts, running_sums
from rolewise.functions.shapiro import shapiro_wilk
from rolewise.functions import tables
from rolewise.functions.tables import hash_sample, lookup


@pytest.mark.parametrize("got, want", [
    (pvalues.chi2_sf(3.841458820694124, 1), 0.05), (pvalues.chi2_sf(40.0, 10), 1.694474288e-5),
    (pvalues.f_sf(4.964602743730711, 1, 10), 0.05), (pvalues.t_two_sided(2.2281388519649385, 10), 0.05),
    (pvalues.normal_sf(1.959963984540054), 0.025), (pvalues.normal_quantile(0.975), 1.959963984540054)])
def test_tail_probabilities(got, want):
    assert got == pytest.approx(want, rel=1e-6)


def test_tails_against_the_jvm(spark):
    jvm = spark._jvm.org.apache.commons.math3.distribution
    for x, k in ((0.5, 3), (7.0, 3), (60.0, 20), (150.0, 20)):
        want = 1 - jvm.ChiSquaredDistribution(float(k)).cumulativeProbability(x)
        assert pvalues.chi2_sf(x, k) == pytest.approx(want, rel=1e-7, abs=1e-13)
    for x, a, b in ((0.3, 2, 7), (1.0, 5, 40), (4.5, 3, 200), (9.0, 1, 5000)):
        want = 1 - jvm.FDistribution(float(a), float(b)).cumulativeProbability(x)
        assert pvalues.f_sf(x, a, b) == pytest.approx(want, rel=1e-7, abs=1e-13)


def test_shapiro_published_example():
    w, p = shapiro_wilk(np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236.0]))
    assert w == pytest.approx(0.79, abs=0.002) and p == pytest.approx(0.0067, abs=2e-4)
    assert shapiro_wilk(np.array([1.0, 2.0])) is None


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("probs", [PROBS, [i / 40 for i in range(41)]])
def test_quantiles_beyond_the_direct_limit(make, rng, probs):
    """A third of the rows share one value; narrowing and ranking are exact all the same."""
    n = 30_000
    hot = np.where(np.arange(n) % 3 == 0, 7.0, rng.normal(size=n) * 100)
    gaps = np.where(np.arange(n) % 10 == 0, np.nan, rng.integers(0, 50, n).astype(float))
    frame = pd.DataFrame({"hot": hot, "gaps": gaps, "flat": 3.0, "none": np.nan})
    df = make(**frame).repartition(5)
    cols = {c: F.nanvl(F.col(c), F.lit(None)) for c in frame}
    found = exact_quantiles(df, cols, probs, direct_cells=0)
    for c in ("hot", "gaps", "flat"):
        assert found[c] == pytest.approx(frame[c].quantile(probs).tolist(), rel=1e-12)
    assert found["none"] == [None] * len(probs)


def test_quantiles_with_infinities(make, rng, monkeypatch):
    passes, narrow = [], quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: passes.append(1) or narrow(*a))
    x = np.concatenate([rng.normal(size=20_000), [np.inf, -np.inf], np.repeat(0.25, 5_000)])
    found = exact_quantiles(make(x=x), {"x": F.col("x")}, PROBS, direct_cells=0)["x"]
    assert len(passes) <= 5 and found[0] == -math.inf and found[-1] == math.inf
    assert found[1:-1] == pytest.approx(np.quantile(x, PROBS[1:-1]).tolist(), rel=1e-12)


def test_quantiles_with_far_outliers(make, rng):
    x = np.concatenate([rng.normal(size=20_000) * 1e-3, [1e300, -1e300, 1e308, -1.7e308], np.repeat(0.25, 9_000)])
    found = exact_quantiles(make(x=x), {"x": F.col("x")}, PROBS, direct_cells=0)["x"]
    want = np.sort(x)
    for p, v in zip(PROBS, found):
        rank = p * (len(x) - 1)
        lo, hi = want[int(np.floor(rank))], want[int(np.ceil(rank))]
        assert v == pytest.approx(lo + (hi - lo) * (rank - np.floor(rank)), rel=1e-12)


@pytest.mark.parametrize("n_ranges", [8, 700])
def test_running_counts(spark, rng, n_ranges):
    frame = pd.DataFrame({"g": rng.choice(["a", "b"], 5_000), "value": rng.integers(0, 900, 5_000).astype(float)})
    frame = frame.groupby(["g", "value"]).size().rename("n").reset_index()
    got = running_counts(spark.createDataFrame(frame), ["g"], "value", {"n": "before"}, n_ranges).toPandas()
    want = frame.sort_values(["g", "value"])
    want["before"] = want.groupby("g")["n"].cumsum() - want["n"]
    merged = want.merge(got, on=["g", "value"])
    assert len(merged) == len(want) == len(got)
    assert (merged["before_x"] == merged["before_y"]).all()


def test_hash_sample_is_exact_and_stable(spark):
    df = spark.range(10_000).withColumn("v", F.col("id") * 2)
    first = {r["id"] for r in hash_sample(df, 500, ["id"]).collect()}
    second = {r["id"] for r in hash_sample(df.repartition(13), 500, ["id"]).collect()}
    assert len(first) == 500 and first == second
    assert hash_sample(df.filter("id < 20"), 500).count() == 20
    same = spark.range(3_000).select(F.lit(1).alias("k"))
    assert hash_sample(same, 100).count() == 100


@pytest.mark.parametrize("limit", [200_000, 10])
def test_lookup_with_hot_and_missing_keys(spark, monkeypatch, limit):
    """Past the broadcast limit, hot keys, cold keys and rows without a key all keep their rows."""
    monkeypatch.setattr(tables, "BROADCAST_ROWS", limit)
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
                                    .otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("k"))
    counts = df.filter("k is not null").groupBy("k").agg(F.count("*").alias("_n"))
    table = counts.withColumn("size", F.col("_n") * 10)
    out = lookup(df, table, ["k"], "_n", counts.count(), 30_000)
    assert out.count() == 30_000
    by_key = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count("*").alias("n")).collect()}
    bad = [r for r in out.select("k", "size").distinct().collect()
           if r["size"] != (by_key[r["k"]] * 10 if r["k"] is not None else None)]
    assert not bad


def test_kolmogorov_like_uniform_hash(spark):
    from rolewise.functions.columns import row_hash, unit_interval
    u = spark.range(20_000).select(unit_interval(row_hash(spark.range(1))).alias("u")).toPandas()["u"]
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01 and not math.isnan(u.std())


def test_grouped_quantiles_with_hot_group(spark, make, rng):
    n = 3_000
    group = np.where(np.arange(n) % 3 == 0, "hot", [f"g{i % 500}" for i in range(n)])
    value = np.where(np.arange(n) % 7 == 0, 5.0, rng.normal(size=n).round(2))
    df = make(g=group, v=value).union(spark.createDataFrame([(None, 1.0), ("only nulls", None)], "g string, v double"))
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for pieces, size in ((1, 100), (7, 40)):
        ranked = grouped_ranks(df.repartition(pieces), F.col("g"), F.col("v"), size)
        found = {r["group"]: r for r in grouped_quantiles(ranked, probs).collect()}
        frame = pd.DataFrame({"g": group, "v": value})
        assert set(found) == set(group)
        for g, values in frame.groupby("g")["v"]:
            assert found[g]["n"] == len(values)
            assert [found[g][f"q{i}"] for i in range(len(probs))] == pytest.approx(list(np.quantile(values, probs)))
    assert grouped_quantiles(grouped_ranks(df.limit(0), F.col("g"), F.col("v")), probs).count() == 0


def test_running_sums_over_groups_and_texts(spark, rng):
    rows = spark.range(2_000).select(F.when(F.col("id") % 2 == 0, "a").otherwise(F.concat(F.lit("b"), (F.col("id") % 100).cast("string"))).alias("g"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("t"), (F.col("id") % 5).alias("w"))
    pandas = rows.toPandas().sort_values(["g", "t"])
    pandas["below"] = pandas.groupby("g")["w"].cumsum() - pandas["w"]
    pandas["total_w"] = pandas.groupby("g")["w"].transform("sum")
    got = running_sums(rows, ["g"], ["t"], {"w": "below"}, 2_000, 150).toPandas().sort_values(["g", "t"])
    assert got[["below", "total_w"]].to_numpy().tolist() == pandas[["below", "total_w"]].to_numpy().tolist()
