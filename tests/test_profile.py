import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rolewise.functions.gram import pairwise
from rolewise.operators import profile
from rolewise.operators.profile import (class_balance, correlation_matrix, correlations, missing_shares,
                                        numeric_profiles, redundant_pairs, table_profile, top_values)


def test_numeric_profile_matches_pandas(make, rng):
    x = np.concatenate([rng.gamma(1, 10, 500), [500.0, 600.0]])
    x[3] = np.nan
    found = numeric_profiles(make(x=x), ["x"])["x"]
    s = pd.Series(x).dropna()
    q1, q3 = s.quantile([0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    for mine, want in ((found.mean, s.mean()), (found.std, s.std()), (found.median, s.median()), (found.skew, s.skew()),
                       (found.lower, lo), (found.upper, hi)):
        assert mine == pytest.approx(want, rel=1e-9)
    assert found.n_outliers == int(((s < lo) | (s > hi)).sum()) and found.is_skewed


def test_no_spread_means_no_outliers(make):
    found = numeric_profiles(make(x=[5.0] * 50 + [900.0]), ["x"])["x"]
    assert found.n_outliers == 0 and found.lower is None


def test_missing_and_shape(make):
    df = make(a=[1.0, None, 3.0, 3.0], b=["x", None, "z", "z"], c=[1, 1, 1, 1])
    assert {r["name"]: r["pct_missing"] for r in missing_shares(df).collect()} == {"a": 0.25, "b": 0.25}
    assert tuple(table_profile(df).first()) == (4, 3, 1)


def test_duplicates_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, "a"), ("x" * 100, None), ("x" * 100, None)], "p string, q string")
    assert table_profile(df).first()["duplicate_rows"] == 2


def test_top_values_break_ties_by_value(make):
    df = make(c=["b", "a", "c", "c"] + [None])
    assert [(r["value"], r["n"]) for r in top_values(df, ["c"], 2).orderBy("rank").collect()] == [("c", 2), ("a", 1)]


def test_top_values_rank_is_limited_before_the_shuffle(make):
    plan = top_values(make(c=["a"] * 5), ["c"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_class_balance(make):
    rows = {r["label"]: r for r in class_balance(make(y=[0] * 270 + [1] * 30), "y").collect()}
    assert rows["0"]["is_majority"] and rows["1"]["is_minority"]
    assert rows["0"]["imbalance_ratio"] == 9 and rows["0"]["is_imbalanced"]
    assert class_balance(make(y=[1] * 5), "y").count() == 0


def test_redundant_pair(make, rng):
    x = rng.normal(size=200)
    df = make(x1=x, x1_twin=2 * x + rng.normal(0, 0.01, 200), x2=rng.normal(size=200))
    assert [(r["col_a"], r["col_b"]) for r in redundant_pairs(df, df.columns).collect()] == [("x1", "x1_twin")]


def test_wide_correlations_equal_pandas_with_gaps(make, rng):
    data = rng.normal(size=(300, 15)) + rng.normal(size=(300, 1))
    data[rng.uniform(size=data.shape) < 0.1] = np.nan
    frame = pd.DataFrame(data, columns=[f"c{i}" for i in range(15)])
    frame["flat"] = 1.0
    found = correlations(make(**frame), list(frame.columns))
    want = frame.corr()
    for (a, b), r in found.items():
        if np.isnan(want.loc[a, b]):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-9)
    assert correlation_matrix(make(**frame), ["c0", "c1"]).count() == 4


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert numeric_profiles(df, ["x"]) == {}
    assert tuple(table_profile(df).first()) == (0, 1, 0)
    assert df.agg(F.count("x")).first()[0] == 0


def test_wide_pairs_by_blocks(spark, rng, monkeypatch):
    """Several blocks and passes, gaps of every column, a constant and an empty one, against pandas."""
    x = rng.normal(size=(300, 23)) + 1e6
    x[:, 5] = x[:, 2] * 2 + rng.normal(size=300) * 0.01
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7], x[:, 8] = 4.0, np.nan
    names = [f"c{i}" for i in range(23)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in names)).repartition(4)
    want = pd.DataFrame(x, columns=names).corr()
    finish = profile._correlation_batch(names)
    packed = df.select(F.array(*names).alias("x"))
    for block, lot in ((4, 5), (30, 64)):
        got = pairwise(packed, 23, finish, profile.PAIRS_SCHEMA, block, lot).collect()
        assert len(got) == 23 * 22 // 2 and all(int(r["col_a"][1:]) < int(r["col_b"][1:]) for r in got)
        for r in got:
            w = want.loc[r["col_a"], r["col_b"]]
            assert r["correlation"] is None if np.isnan(w) else abs(r["correlation"] - w) < 1e-6
    assert [tuple(r)[:2] for r in profile.redundant_pairs(df, names).collect()] == [("c2", "c5")]


def test_two_thousand_columns_stay_in_tasks(spark):
    """Two million pairs as rows of Spark tasks; planted copies of a column are the only redundant ones."""
    names = [f"c{i}" for i in range(2000)]
    mixed = [F.sin(F.col("id") * F.lit(0.37 + 0.013 * (i % 1000)) + i % 1000).alias(n) for i, n in enumerate(names)]
    got = profile.correlation_pairs(spark.range(0, 200, 1, 2).select(*mixed), names)
    assert got.count() == 2000 * 1999 // 2
    assert got.filter("correlation > 0.999999999 and col_a = concat('c', cast(substr(col_b, 2) as int) - 1000)").count() == 1000
