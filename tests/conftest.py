import os
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Spark frame from columns."""
    return lambda **columns: spark.createDataFrame(pd.DataFrame(columns))


@pytest.fixture
def rng():
    return np.random.default_rng(7)


@pytest.fixture
def mixed(make, rng):
    n = 200
    return make(row_id=np.arange(n), price=rng.gamma(2, 50_000, n), rooms=rng.integers(1, 10, n),
                city=rng.choice(["Lyon", "Oslo", "Porto", "Turin"], n),
                notes=[f"free text about the flat number {i} with a long and unique description {i * i}" for i in range(n)],
                constant_col=["same"] * n, signup_date=pd.date_range("2022-01-01", periods=n).strftime("%Y-%m-%d"),
                lat=rng.uniform(32, 42, n), lon=rng.uniform(-118, -87, n))


@pytest.fixture
def regression(make, rng):
    n = 300
    x1, x2, cat = rng.normal(size=n), rng.normal(size=n), rng.choice(list("ABC"), n)
    y = 10 + 3 * x1 - 2 * x2 + pd.Series(cat).map({"A": 0, "B": 5, "C": -3}).to_numpy() + rng.normal(0, 0.5, n)
    x1[:15] = np.nan
    return make(x1=x1, x2=x2, category=cat, target=y)


@pytest.fixture
def classification(make, rng):
    n = 300
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    label = (rng.uniform(size=n) < 1 / (1 + np.exp(-(1.5 * x1 - x2)))).astype(int)
    return make(x1=x1, x2=x2, flag=rng.choice(["yes", "no"], n), label=label)
