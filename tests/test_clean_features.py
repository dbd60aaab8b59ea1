import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rolewise.operators.clean import clean
from rolewise.operators.features import (add_geo, engineer, expand_datetime, frequency_encode, level_codes, one_hot, one_hot_sparse,
                                         target_encode, term_table, tfidf)
from rolewise.operators.roles import infer_roles


def test_clean_leaves_no_gap(make):
    df = make(x=[1.0, None, 3.0, 10.0] * 10, c=["a", None, "a", "b"] * 10, y=[1.0, 2.0, None, 4.0] * 10)
    out, log = clean(df, infer_roles(df, "y"))
    assert out.count() == 30
    assert out.filter("x is null or c is null or y is null").count() == 0
    entries = {(r["column"], r["action"]): r["value"] for r in log.collect()}
    assert entries["x", "impute"] == "3.0" and entries["c", "mode"] == "a"


def test_mean_strategy_and_bad_strategy(make):
    df = make(x=[1.0, None, 4.0] * 10)
    roles = infer_roles(df)
    assert clean(df, roles, strategy="mean")[0].filter("x = 2.5").count() == 10
    with pytest.raises(ValueError):
        clean(df, roles, strategy="mode")


def test_cap(make, rng):
    x = np.concatenate([rng.normal(50, 5, 195), rng.uniform(480, 520, 5)])
    df = make(x=x)
    roles = infer_roles(df)
    assert clean(df, roles)[0].agg(F.max("x")).first()[0] > 400
    capped, log = clean(df, roles, cap_outliers=True)
    upper = log.filter("action = 'cap'").first()["upper"]
    assert capped.agg(F.max("x")).first()[0] <= upper < 400


def test_log_only_for_skewed_and_non_negative(make, rng):
    gamma = rng.gamma(0.5, 10, 300)
    df = make(skewed=gamma, shifted=gamma - 5, even=rng.normal(size=300) ** 3 * 0 + rng.uniform(size=300))
    columns = clean(df, infer_roles(df))[0].columns
    assert "skewed_log" in columns and "shifted_log" not in columns and "even_log" not in columns


def test_all_missing(spark):
    df = spark.createDataFrame([(None, None, float(i)) for i in range(30)], "x double, s string, z double")
    roles = infer_roles(df, overrides={"x": "numeric", "s": "categorical_low"})
    row = clean(df, roles)[0].first()
    assert row["x"] == 0.0 and row["s"] == "Unknown"


def test_one_hot_names_and_values(make):
    out, log = one_hot(make(k=[1, 2, 3], c=["a b", "a.b", None]), ["c"])
    assert out.columns == ["k", "c_a_b", "c_a_b_2"]
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    assert [r[3] for r in log] == ["a b", "a.b"]


def test_frequency(make):
    df = make(k=[0, 1, 2, 3], c=["a", "a", "b", None])
    assert [r["c_freq"] for r in frequency_encode(df, "c").orderBy("k").collect()] == pytest.approx([2 / 3, 2 / 3, 1 / 3, 0])
    seen = frequency_encode(df, "c", fit_on=df.filter("c = 'a'"))
    assert [r["c_freq"] for r in seen.orderBy("k").collect()] == [1, 1, 0, 0]


def test_out_of_fold_means(spark, make, rng):
    n = 500
    frame = pd.DataFrame({"k": np.arange(n), "c": rng.choice(list("abcde"), n), "y": rng.normal(size=n)})
    frame.loc[0, "c"] = "alone"
    df = spark.createDataFrame(frame)
    out = target_encode(df, ["c"], "y", fold=F.col("k") % 5, is_train=F.col("k") % 4 != 0).toPandas().sort_values("k")
    train = frame[frame.k % 4 != 0]
    for i in (1, 2, 3, 77, 401):
        others = train[(train.c == frame.c[i]) & (train.k % 5 != i % 5)]
        assert out["c"].iloc[i] == pytest.approx(others.y.mean())
    assert out["c"].iloc[4] == pytest.approx(train[train.c == frame.c[4]].y.mean())
    assert out["c"].iloc[0] == pytest.approx(train.y.mean())


def test_datetime_parts(spark):
    df = spark.createDataFrame([("2024-03-02",), ("2024-03-04",), (None,), ("2024-03-05",)], "d string")
    out, names = expand_datetime(df, "d")
    rows = out.collect()
    assert len(names) == 9 and "d" not in out.columns
    assert rows[0]["d_dayofweek"] == 5 and rows[0]["d_is_weekend"] == 1
    assert rows[2]["d_day"] == 4 and rows[2]["d_is_weekend"] == 0
    assert rows[0]["d_month_sin"] == pytest.approx(np.sin(2 * np.pi * 3 / 12))


def test_geo(make, rng):
    spots = rng.choice([-30.0, 30.0], 400)
    df = make(lat=spots + rng.normal(size=400), lon=spots + rng.normal(size=400)).withColumn(
        "lat", F.when(F.rand(1) > 0.1, F.col("lat")))
    out, centres = add_geo(df, "lat", "lon", 400, restarts=3)
    assert len(centres) == 8
    assert out.filter("lat is null and geo_cluster <> -1").count() == 0
    assert out.filter("geo_dist_to_centroid is null").count() == 0
    small = df.limit(5)
    assert add_geo(small, "lat", "lon", 5) == (small, None)


def test_tfidf_against_numpy(spark):
    texts = ["Red fish blue fish", "red Ünion the fish", "green Ünion", "", None] * 4
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    rows = term_table(df, "t").collect()
    found = {r["term"]: r for r in rows}
    assert set(found) == {"red", "fish", "blue", "ünion", "green"}
    assert (found["fish"]["n_total"], found["fish"]["n_docs"]) == (12, 8)
    assert found["fish"]["idf"] == pytest.approx(np.log(21 / 9) + 1)
    out, log = tfidf(df, "t", [(r["term"], r["idf"]) for r in rows])
    first = out.orderBy("k").first()
    w = {"red": found["red"]["idf"], "fish": 2 * found["fish"]["idf"], "blue": found["blue"]["idf"]}
    norm = np.sqrt(sum(v * v for v in w.values()))
    by_term = {term: column for _, _, column, term in log}
    assert first[by_term["fish"]] == pytest.approx(w["fish"] / norm)
    assert out.filter("k = 3").first()[by_term["red"]] == 0.0


def test_term_limit_and_min_docs(spark):
    df = spark.createDataFrame([(f"common w{i}a w{i}b",) for i in range(30)], "t string")
    assert [r["term"] for r in term_table(df, "t").collect()] == ["common"]


def test_engineer(mixed):
    roles = infer_roles(mixed, "price")
    cleaned, _ = clean(mixed, roles)
    made = engineer(cleaned, roles)
    assert "row_id" not in made.columns and "constant_col" not in made.columns and "notes" not in made.columns
    assert {"city_Oslo", "geo_cluster", "geo_dist_to_centroid", "signup_date_month_sin", "lat", "lon"} <= set(made.columns)
    assert any(c.startswith("notes_tfidf_") for c in made.columns)
    assert made.table.count() == 200
    off = engineer(cleaned, roles, vectorize_text=False)
    assert not any("tfidf" in c for c in off.columns)


def test_high_cardinality_choice(make, rng):
    df = make(code=[f"C{i % 30}" for i in range(200)], target=rng.normal(size=200))
    with_target, without = infer_roles(df, "target"), infer_roles(df)
    assert "code_freq" in engineer(df, with_target).columns
    deferred = engineer(df, with_target, encoding="target")
    assert deferred.deferred == ["code"] and "code" in deferred.columns
    assert "code_freq" in engineer(df, without, encoding="target").columns
    with pytest.raises(ValueError):
        engineer(df, without, encoding="hash")


def test_codes_of_100000_labels_without_a_list(spark):
    df = spark.range(130_000).select(F.when(F.col("id") < 30_000, "hot").when(F.col("id") != 30_000, F.concat(F.lit("v"), F.col("id"))).alias("c"))
    codes = level_codes(df, "c", range_rows=9_000)
    assert codes.select("code").distinct().count() == codes.count() == 100_000
    ordered = [r["label"] for r in codes.filter("code < 50").orderBy("code").collect()]
    assert ordered == sorted(ordered) and ordered[0] == "hot"
    assert codes.filter("label = 'hot'").first()["n"] == 30_000 and codes.agg(F.max("code")).first()[0] == 99_999


def test_one_hot_sparse(make):
    out, found = one_hot_sparse(make(k=[1, 2, 3, 4], c=["b", "a", None, "b"]).withColumn("none", F.lit(None).cast("string")), ["c", "none"])
    rows = {r["k"]: r for r in out.collect()}
    assert [list(rows[k]["c_levels"].toArray()) for k in (1, 2, 3, 4)] == [[0, 1], [1, 0], [0, 0], [0, 1]]
    assert [rows[k]["c_code"] for k in (1, 2, 3, 4)] == [1, 0, None, 1] and "none_levels" not in out.columns
    assert [tuple(r) for r in found["c"].orderBy("code").collect()] == [("a", 0, 1), ("b", 1, 2)]
    assert found["none"].count() == 0
