import csv
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest

import rolewise
from rolewise.functions.arima import Order, adf_test, fit_arima, forecast_arima, holt, partial_autocorrelations
from rolewise.functions.normal import normal_quantile_sql
from rolewise.operators import charts, timeseries as ts
from rolewise.plans import job
from rolewise.sources.reader import csv_facts, load_table, sample_rows
from rolewise.sources.records import splits
from rolewise.sources.sink import write_tables


def days(n, start="2022-01-01", freq="D"):
    return pd.date_range(start, periods=n, freq=freq).strftime("%Y-%m-%d")


def test_trend(make, rng):
    df = make(date=days(100), sales=100 + 0.5 * np.arange(100) + rng.normal(0, 2, 100))
    out = ts.analyze_series(df, "date", "sales")
    row = out["ts_summary"].first()
    assert row["n_obs"] == 100 and row["trend_r2"] > 0.9 and row["method"] in ("arima", "sarima")
    assert row["aic"] is not None and row["p"] in (0, 1, 2)
    forecast = out["ts_forecast"].orderBy("step").collect()
    assert len(forecast) == 12 and str(forecast[0]["day"]) == "2022-04-11"
    assert 145 < forecast[0]["value"] < 157


def test_intraday_rows_become_days(make, rng):
    stamps = pd.date_range("2024-01-01", periods=2_000, freq="28min48s")
    day = (stamps - stamps[0]).days
    df = make(pickup=stamps, fare=10 + 0.2 * day + rng.normal(size=2_000))
    row = ts.analyze_series(df, "pickup", "fare")["ts_summary"].first()
    assert row["n_obs"] == 40 and row["trend_r2"] > 0.5


def test_weekly_pattern_is_found(make, rng):
    stamps = pd.date_range("2022-01-01", periods=90)
    df = make(date=days(90), sales=50 + 20 * stamps.dayofweek + rng.normal(size=90))
    row = ts.analyze_series(df, "date", "sales")["ts_summary"].first()
    assert row["method"] == "sarima" and row["seasonal"]


def test_many_series_and_fallback(make, rng):
    n = 60
    df = make(date=list(days(n)) * 3 + ["2022-01-01"], k=["a"] * n + ["b"] * n + ["flat"] * n + ["short"],
              y=list(rng.normal(size=n)) + list(np.cumsum(rng.normal(size=n))) + [3.0] * n + [1.0])
    out = ts.analyze_series(df, "date", "y", ["k"])
    rows = {r["series"]: r for r in out["ts_summary"].collect()}
    assert set(rows) == {"a", "b", "flat"}
    assert rows["a"]["is_stationary"] and rows["a"]["d"] == 0 and not rows["b"]["is_stationary"]
    assert rows["flat"]["method"] == "exponential_smoothing" and rows["flat"]["note"]
    assert {r["value"] for r in out["ts_forecast"].filter("series = 'flat'").collect()} == {3.0}


def test_correlograms(make, rng):
    y = np.cumsum(rng.normal(size=80))
    series = ts.daily_series(make(date=days(80), y=y), "date", "y")
    acf = [r["acf"] for r in ts.acf(series).orderBy("lag").collect()]
    dev = y - y.mean()
    want = [1.0] + [(dev[:-k] @ dev[k:]) / (dev @ dev) for k in range(1, 25)]
    assert acf == pytest.approx(want)
    pacf = [r["pacf"] for r in ts.pacf(series).orderBy("lag").collect()]
    cov = np.array([dev @ dev / 80] + [(dev[:-k] @ dev[k:]) / (80 - k) for k in range(1, 25)])
    for k in (1, 2, 5):
        toeplitz = cov[np.abs(np.subtract.outer(np.arange(k), np.arange(k)))]
        assert pacf[k] == pytest.approx(np.linalg.solve(toeplitz, cov[1:k + 1])[-1])
    assert partial_autocorrelations(np.array([0.0, 0.0]))[1] == 0.0


@pytest.mark.parametrize("freq, want, step", [("D", "D", "2024-01-02"), ("W-SUN", "W", None), ("MS", "MS", None),
                                              ("ME", "ME", None), ("B", "B", None), ("2D", "2D", None)])
def test_frequency(make, freq, want, step):
    stamps = pd.date_range("2022-01-03", periods=40, freq=freq)
    series = ts.daily_series(make(date=stamps.strftime("%Y-%m-%d"), y=np.arange(40.0)), "date", "y")
    freqs = ts.series_freq(series)
    assert freqs.first()["freq"] == want
    future = [str(r["day"]) for r in ts.forecast_dates(freqs).orderBy("step").collect()]
    assert future == [str(d.date()) for d in pd.date_range(stamps[-1], periods=13, freq=freq)[1:]]


def test_irregular_days_count_as_daily(make):
    series = ts.daily_series(make(date=["2022-01-01", "2022-01-02", "2022-01-09", "2022-01-11"], y=[1.0] * 4), "date", "y")
    assert ts.series_freq(series).first()["freq"] == "D"
    assert [r["t"] for r in series.orderBy("day").collect()] == [0, 1, 2, 3]


def test_arima_recovers_parameters(rng):
    e = rng.normal(size=3_000)
    y = np.zeros(3_000)
    for t in range(1, 3_000):
        y[t] = 0.6 * y[t - 1] + e[t] + 0.3 * e[t - 1]
    fit = fit_arima(y + 5, Order(1, 0, 1), 0)
    assert fit["theta"][:2] == pytest.approx([0.6, 0.3], abs=0.06) and fit["theta"][2] == pytest.approx(5, abs=0.2)
    assert fit_arima(np.ones(50), Order(1, 1, 0), 1) is None
    drift = forecast_arima(np.arange(30.0), Order(0, 1, 0), np.zeros(0), 3)
    assert list(drift) == [29.0, 29.0, 29.0]


def test_adf_and_holt(rng):
    tau, p = adf_test(rng.normal(size=300))
    assert tau < -5 and p < 1e-4
    assert adf_test(np.cumsum(rng.normal(size=300)) + np.arange(300))[1] > 0.05
    assert adf_test(np.ones(40)) == (0.0, 1.0)
    assert holt(2.0 + 3.0 * np.arange(40), 3) == pytest.approx([122, 125, 128], rel=1e-3)


def test_intervention(make, rng):
    y = np.concatenate([rng.normal(50, 1, 50), rng.normal(80, 1, 50)])
    df = make(date=days(100), value=y)
    row = ts.intervention(df, "date", "value", "2022-02-20")[0].first()
    assert (row["n_pre"], row["n_post"]) == (50, 50) and row["significant_level_shift"] and row["level_shift"] > 10
    assert ts.intervention(df, "date", "value", "not a date") is None
    for cut in ("2030-01-01", "2020-01-01", "2022-01-03"):
        assert ts.intervention(df, "date", "value", cut)[0].count() == 0
    assert ts.intervention(df.limit(10), "date", "value", "2022-01-05")[0].count() == 0


# --- sources and the whole chain ------------------------------------------------------------------

@pytest.mark.parametrize("raw, name", [
    ("name,rating\nCafé Luna,5\n".encode(), "Café Luna"), ("name,rating\nCafé Luna,5\n".encode("utf-8-sig"), "Café Luna"),
    (b"name,rating\nSam\x92s Place,4\n", "Sam’s Place"), (b"name,rating\nodd \x81 byte \xe9,4\n", "odd \x81 byte é"),
    (b'name,rating\n"two\nlines, one ""field""",4\n', 'two\nlines, one "field"')])
def test_csv_bytes(spark, tmp_path, raw, name):
    path = tmp_path / "t.csv"
    path.write_bytes(raw)
    df = load_table(spark, str(path))
    assert df.columns == ["name", "rating"] and dict(df.dtypes)["rating"] == "bigint"
    assert df.first()["name"] == name


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_csv_records_over_splits(spark, tmp_path, rng, small_splits, end):
    """Against Python's csv module: quoted line breaks, escaped quotes, lone quotes, blank lines, a record longer than several splits."""
    parts = ["plain", "", "two\nlines", 'say "hi"', "a,b", "mixed\r\nbreaks\rhere", '"', "é" * 30, "\n\n", 'x"\n"y']
    rows = [[str(i), str(rng.choice(parts)) + str(rng.choice(parts)), f"v{i}"] for i in range(400)]
    rows[200][1] = "long\n" * 1200
    out = ["id,note,tail"]
    for i, note, tail in rows:
        quoted = '"' + note.replace('"', '""') + '"' if note else ""
        out.append(f'{i},{quoted},{tail}' + (' 5" pipe' if int(i) % 7 == 0 else ""))
        out += [""] * (int(i) % 50 == 3)
    path = tmp_path / "t.csv"
    path.write_bytes((end.join(out) + end * (end != "\r")).encode())
    with open(path, newline="", encoding="utf-8") as f:
        want = [r for r in csv.reader(f) if r][1:]
    df = load_table(spark, str(path))
    if end != "\r":                     # a file without line feeds is one piece
        assert splits(spark, str(path)).count() > 10
    assert df.columns == ["id", "note", "tail"]
    assert [[str(r["id"]), r["note"] or "", r["tail"]] for r in df.orderBy("id").collect()] == want


def test_lone_inch_mark_keeps_lines(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,size\n" + "".join(f"{i},{i}\" pipe\n" for i in range(101)))
    assert csv_facts(spark, str(path)) == {"encoding": "utf-8", "multi_line": False, "mixed": False}
    assert [r["size"] for r in load_table(spark, str(path)).orderBy("id").collect()] == [f'{i}" pipe' for i in range(101)]


def test_csv_charset_of_each_file(spark, tmp_path):
    for name, charset in (("a", "utf-8"), ("b", "cp1252"), ("c", "utf-8-sig")):
        (tmp_path / f"{name}.csv").write_bytes(f"id,text\n{ord(name)},Café’s\n".encode(charset))
    df = load_table(spark, str(tmp_path / "*.csv"))
    assert sorted(map(tuple, df.collect())) == [(97, "Café’s"), (98, "Café’s"), (99, "Café’s")]


def test_csv_without_rows(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text('a,"b\nc"\n')
    assert load_table(spark, str(tmp_path / "e.csv")).count() == 0
    df = load_table(spark, str(tmp_path / "h.csv"))
    assert df.columns == ["a", "b\nc"] and df.count() == 0


def test_csv_types_and_missing(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("i,d,b,s,m\n1,1.5,True,x,NA\n2,,False,2d,3\n3,1e3,True,null,\n")
    df = load_table(spark, str(path))
    assert dict(df.dtypes) == {"i": "bigint", "d": "double", "b": "boolean", "s": "string", "m": "bigint"}
    assert [r["s"] for r in df.orderBy("i").collect()] == ["x", "2d", None]


def test_formats(spark, tmp_path):
    with pytest.raises(ValueError):
        load_table(spark, "book.xlsx")
    spark.range(5).write.parquet(str(tmp_path / "d.parquet"))
    assert load_table(spark, str(tmp_path / "d.parquet")).count() == 5
    assert sample_rows(spark.range(100), 7).count() == 7


def test_analyze_writes_all_tables(spark, regression, tmp_path):
    df = regression.withColumnRenamed("x2", "y")
    out = rolewise.analyze(df, "target", model_names=["Linear Regression"], segment_restarts=2)
    assert {"column_profile", "numeric_profile", "cleaning_log", "feature_log", "model_comparison", "feature_importance",
            "baseline_stats", "residual_bins", "qq_points", "correlation_matrix"} <= set(out.tables)
    assert "ts_summary" not in out.tables and "association_tests" not in out.tables
    paths = write_tables(out.tables, str(tmp_path / "out"))
    assert all(spark.read.parquet(p).columns for p in paths)


def test_analyze_without_target(mixed):
    out = rolewise.analyze(mixed, segment_restarts=2)
    assert out.models is None and out.roles.task is None
    assert {"geo_grid", "clusters", "chart_histogram"} <= set(out.tables)


def test_job(spark, make, rng, tmp_path, capsys):
    n = 60
    make(order_date=days(n), region=["N", "S"] * 30, units=10 + np.arange(n) + rng.normal(size=n)).write.parquet(
        str(tmp_path / "in.parquet"))
    assert job.main(["run", str(tmp_path / "in.parquet"), "--target", "units", "--out", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out" / "ts_summary")).first()["n_obs"] == n
    assert "best model" in capsys.readouterr().out
    assert job.main(["run", str(tmp_path / "nothing.parquet")]) == 1


def test_composite_keys_stay_apart(spark):
    rows = [("a", None, 1.0), (None, "a", 2.0), ("a|b", "c", 3.0), ("a", "b|c", 4.0), ("\\N", None, 5.0)]
    df = spark.createDataFrame([("2024-01-01", *r) for r in rows], "day string, k1 string, k2 string, y double")
    out = ts.daily_series(df, "day", "y", ["k1", "k2"]).collect()
    assert sorted(r["y"] for r in out) == [1.0, 2.0, 3.0, 4.0, 5.0] and len({r["series"] for r in out}) == 5


def test_long_ids_keep_their_digits(spark, tmp_path):
    ids = ["9007199254740993123", "9007199254740993124", "90071992547409931250"]
    (tmp_path / "ids.csv").write_text("id,x\n" + "".join(f"{i},1\n" for i in ids))
    assert [str(r["id"]) for r in load_table(spark, str(tmp_path / "ids.csv")).orderBy("id").collect()] == ids


def test_normal_quantiles_as_sql(spark):
    p = [1e-300, 1e-20, 1e-9, 1e-4, 0.0749, 0.0751, 0.3, 0.5, 0.7, 0.9249, 0.9251, 1 - 1e-9, 1 - 1e-15]
    got = spark.createDataFrame([(x,) for x in p], "p double").selectExpr(f"{normal_quantile_sql('p')} AS x").collect()
    assert np.allclose([r["x"] for r in got], [NormalDist().inv_cdf(x) for x in p], rtol=1e-13, atol=1e-14)


def test_qq_line(make, rng):
    """Against numpy with ties, a null, and values that hold a third of the rows."""
    values = np.concatenate([rng.normal(3, 2, 300).round(1), np.full(150, 2.5)])
    row = charts.qq_line(make(residual=[*values, np.nan])).first()
    n, v = len(values), np.sort(values)
    p = (np.arange(1, n + 1) - 0.3175) / (n + 0.365)
    p[0], p[-1] = 1 - 0.5 ** (1 / n), 0.5 ** (1 / n)
    x = np.array([NormalDist().inv_cdf(a) for a in p])
    slope, intercept = np.polyfit(x, v, 1)
    assert row["n"] == n and np.allclose([row["slope"], row["intercept"], row["r"]], [slope, intercept, np.corrcoef(x, v)[0, 1]])
    assert charts.qq_line(make(residual=[1.0]).limit(0)).first()["n"] == 0


def test_density(make, rng):
    """Against direct sums; a constant column and one without values have no curve."""
    v = np.concatenate([rng.normal(0, 1, 400), rng.normal(6, 0.5, 200), np.full(100, 2.0)])
    df = make(a=[*v, np.nan], same=[1.0] * 701, none=[np.nan] * 701)
    got = charts.density(df, ["a", "same", "none"]).orderBy("point").collect()
    width = v.std(ddof=1) * 700 ** -0.2
    x = np.linspace(v.min(), v.max(), 200)
    want = np.exp(-0.5 * ((x[:, None] - v) / width) ** 2).sum(axis=1) / (700 * width * np.sqrt(2 * np.pi))
    assert {r["name"] for r in got} == {"a"} and np.allclose([r["x"] for r in got], x) and np.allclose([r["density"] for r in got], want, rtol=1e-5, atol=1e-9)


def test_intervention_against_least_squares(make, rng):
    frames = []
    for name, n in (("a", 60), ("b", 90)):
        y = rng.normal(20, 3, n) + 0.3 * np.arange(n) + np.where(np.arange(n) >= 31, 4 - 0.2 * np.arange(n), 0)
        frames.append(pd.DataFrame({"date": days(n), "value": y, "k": name}))
    df = make(**pd.concat(frames).to_dict("list"))
    summary, fitted = ts.intervention(df, "date", "value", str(pd.Timestamp(frames[0]["date"].iloc[31]).date()), ["k"])
    assert "FlatMapGroupsInPandas" not in summary._jdf.queryExecution().toString()
    found, lines = {r["series"]: r for r in summary.collect()}, fitted.toPandas()
    for frame in frames:
        t, y = np.arange(len(frame), dtype=float), frame["value"].to_numpy()
        post = (t >= 31).astype(float)
        x = np.column_stack([np.ones(len(t)), t, post, post * (t - 31)])
        beta = np.linalg.lstsq(x, y, rcond=None)[0]
        rest = y - x @ beta
        errors = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (rest @ rest) / (len(t) - 4))
        row = found[frame["k"].iloc[0]]
        assert (row["level_shift"], row["slope_change"]) == pytest.approx(tuple(beta[2:]))
        for value, i in (("level_shift_p", 2), ("slope_change_p", 3)):
            assert row[value] == pytest.approx(ts.pvalues.t_two_sided(beta[i] / errors[i], len(t) - 4), abs=1e-12, rel=1e-6)
        mine = lines[lines["series"] == frame["k"].iloc[0]].sort_values("day")["fitted"].to_numpy()
        assert mine == pytest.approx(x @ beta)
