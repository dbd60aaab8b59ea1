import datetime as dt

import pytest
from pyspark.sql import functions as F

from rolewise.operators.roles import column_stats, infer_roles


def test_every_role(mixed):
    roles = infer_roles(mixed, "price")
    assert roles.roles == {"row_id": "identifier", "price": "target", "rooms": "numeric", "city": "categorical_low",
                           "notes": "text", "constant_col": "constant", "signup_date": "datetime",
                           "lat": "geo_lat", "lon": "geo_lon"}
    assert roles.has_geo and roles.task == "regression"
    assert roles.features == ["rooms", "city", "notes", "lat", "lon"]


@pytest.mark.parametrize("parts", [1, 7])
def test_roles_do_not_depend_on_partitioning(mixed, parts):
    assert infer_roles(mixed.repartition(parts)).roles == infer_roles(mixed).roles


def test_column_order_does_not_matter(mixed):
    assert infer_roles(mixed.select(*reversed(mixed.columns))).roles == infer_roles(mixed).roles


def test_task(make):
    df = make(few=[i % 15 for i in range(100)], many=[i % 16 for i in range(100)], word=["a", "b"] * 50)
    assert infer_roles(df, "few").task == "classification"
    assert infer_roles(df, "many").task == "regression"
    assert infer_roles(df, "word").task == "classification"
    assert infer_roles(df).task is None


def test_triage_agrees_with_exact(mixed):
    assert infer_roles(mixed, distinct="triage").roles == infer_roles(mixed).roles
    with pytest.raises(ValueError):
        column_stats(mixed, "sometimes")


def test_overrides_and_unsupported(spark):
    df = spark.createDataFrame([(1, [1.0], "x"), (2, [2.0], "y")], "a int, v array<double>, s string")
    assert infer_roles(df).roles["v"] == "unsupported"
    assert infer_roles(df, overrides={"a": "identifier"}).roles["a"] == "identifier"


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,), (2.0,)], "x double")
    stats = column_stats(df)["x"]
    assert (stats.n_missing, stats.n_unique) == (2, 2)


def test_date_rate_and_name_hint(make):
    eighty = ["2024-01-%02d" % (i % 28 + 1) if i % 5 else f"word{i}" for i in range(100)]
    roles = infer_roles(make(created_date=eighty, mark=eighty))
    assert roles.roles["created_date"] == "datetime" and roles.roles["mark"] != "datetime"


def test_date_layouts(spark):
    from rolewise.functions.dates import parse_timestamp
    from pyspark.sql import types as T
    texts = ["2024-03-05", "2024/03/05", "03/05/2024", "5-Mar-2024", "5 Mar 2024", "Mar 5, 2024", "20240305",
             "2024-03-05T10:30:00", "2024-13-45", "no date", "12.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(F.to_date(parse_timestamp(F.col("t"), T.StringType()))).collect()]
    assert found == [dt.date(2024, 3, 5)] * 8 + [None] * 3


def test_edge_tables(spark):
    empty = spark.createDataFrame([], "a double, s string")
    roles = infer_roles(empty, "a")
    assert roles.n_rows == 0 and roles.roles["s"] == "constant"
    nulls = spark.createDataFrame([(None, "x")], "a double, s string")
    assert infer_roles(nulls).roles == {"a": "constant", "s": "constant"}
