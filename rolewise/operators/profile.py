"""Descriptive profile of the raw table."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.columns import as_double, distinct_key, field_types, present, q, to_long
from ..functions.gram import pairwise
from ..functions.quantiles import exact_quantiles
from .roles import Roles

# Fixed thresholds of the profile.
SKEW_MIN = 1.0
FENCE_WIDTH = 1.5
IMBALANCE_MIN = 1.5
REDUNDANT_MIN = 0.9
TOP_VALUES = 10
SQL_CORRELATION_COLUMNS = 12     # above this the pairs are made by blocks of columns
PAIRS_SCHEMA = "col_a string, col_b string, correlation double"

NUMERIC_SCHEMA = ("name string, n long, mean double, std double, min double, max double, "
                  "median double, skew double, is_skewed boolean, n_outliers long, "
                  "pct_outliers double, lower_fence double, upper_fence double")


@dataclass
class NumericProfile:
    name: str
    n: int
    mean: float | None
    std: float | None
    min: float | None
    max: float | None
    median: float | None
    skew: float | None
    lower: float | None = None
    upper: float | None = None
    n_outliers: int = 0

    @property
    def is_skewed(self) -> bool:
        return self.skew is not None and abs(self.skew) >= SKEW_MIN

    def row(self) -> tuple:
        return (self.name, self.n, self.mean, self.std, self.min, self.max, self.median, self.skew,
                self.is_skewed, self.n_outliers, self.n_outliers / self.n, self.lower, self.upper)


def fences(q1: float | None, q3: float | None) -> tuple[float, float] | None:
    """Outlier fences, none for a column without spread."""
    if q1 is None or q3 is None or q3 == q1:
        return None
    return q1 - FENCE_WIDTH * (q3 - q1), q3 + FENCE_WIDTH * (q3 - q1)


def corrected_skew(g1: float | None, n: int) -> float | None:
    if g1 is None or n < 3 or math.isnan(g1):
        return None
    return g1 * math.sqrt(n * (n - 1.0)) / (n - 2.0)


def table_profile(df: DataFrame) -> DataFrame:
    """Row count, column count and copies of rows after the first one."""
    types = field_types(df)
    keys = df.select(*[distinct_key(n, t).alias(f"k{i}") for i, (n, t) in enumerate(types.items())])
    groups = keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                      F.lit(len(types)).cast("long").alias("n_cols"),
                      F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def missing_shares(df: DataFrame) -> DataFrame:
    """Share of missing values for the columns that have any."""
    types = field_types(df)
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[
        F.count(present(n, t)).alias(f"c{i}") for i, (n, t) in enumerate(types.items())])
    long = to_long(counts, {n: F.col(f"c{i}") for i, n in enumerate(types)}, keep=["n"],
                   value="present")
    return (long.filter("present < n")
            .select("name", (F.col("n") - F.col("present")).alias("n_missing"),
                    ((F.col("n") - F.col("present")) / F.col("n")).alias("pct_missing")))


def numeric_profiles(df: DataFrame, names: list[str], n_rows: int | None = None
                     ) -> dict[str, NumericProfile]:
    """Moments, median, corrected skew and outlier counts; columns without values are left out."""
    types = field_types(df)
    cols = {n: as_double(n, types[n]) for n in dict.fromkeys(names)}
    if not cols:
        return {}
    row = df.agg(*[a for i, c in enumerate(cols.values()) for a in (
        F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
        F.min(c).alias(f"a{i}"), F.max(c).alias(f"z{i}"), F.skewness(c).alias(f"g{i}"))]).first()
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75], n_rows)
    out: dict[str, NumericProfile] = {}
    for i, n in enumerate(cols):
        if not row[f"n{i}"]:
            continue
        q1, q2, q3 = quartiles[n]
        lower, upper = fences(q1, q3) or (None, None)
        out[n] = NumericProfile(n, row[f"n{i}"], row[f"m{i}"], row[f"s{i}"], row[f"a{i}"],
                                row[f"z{i}"], q2, corrected_skew(row[f"g{i}"], row[f"n{i}"]),
                                lower, upper)
    fenced = [p for p in out.values() if p.lower is not None]
    if fenced:
        counts = df.agg(*[F.count(F.when((cols[p.name] < p.lower) | (cols[p.name] > p.upper), 1))
                          .alias(f"o{i}") for i, p in enumerate(fenced)]).first()
        for i, p in enumerate(fenced):
            p.n_outliers = counts[i]
    return out


def numeric_frame(spark: SparkSession, profiles: dict[str, NumericProfile]) -> DataFrame:
    return spark.createDataFrame([p.row() for p in profiles.values()], NUMERIC_SCHEMA)


def top_values(df: DataFrame, names: list[str], k: int = TOP_VALUES) -> DataFrame:
    """The k most frequent values per column, ties by value; counted before any ranking."""
    if not names:
        return df.sparkSession.createDataFrame([], "name string, value string, n long, rank int")
    counts = (to_long(df, {n: q(n).cast("string") for n in names}).filter("value is not null")
              .groupBy("name", "value").agg(F.count(F.lit(1)).alias("n")))
    order = Window.partitionBy("name").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return (df.filter(q(target).isNotNull()).groupBy(q(target).cast("string").alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Label counts with the majority, the minority and their ratio; empty below two classes."""
    counts = class_counts(df, target)
    ends = counts.agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("most"), F.min("n").alias("least"),
                      F.min_by("label", F.struct(-F.col("n"), "label")).alias("majority"),
                      F.max_by("label", F.struct(-F.col("n"), "label")).alias("minority"))
    end = ends.first()                     # one row
    if end["k"] < 2:
        counts = counts.limit(0)
    ratio = end["most"] / end["least"] if end["least"] else None
    return counts.select("label", "n", (F.col("label") == end["majority"]).alias("is_majority"),
                         (F.col("label") == end["minority"]).alias("is_minority"),
                         F.lit(ratio).cast("double").alias("imbalance_ratio"),
                         F.lit(bool(ratio and ratio >= IMBALANCE_MIN)).alias("is_imbalanced"))


def correlation_pairs(df: DataFrame, names: list[str]) -> DataFrame:
    """Pearson correlation of each pair of columns over the rows where both are present, the earlier column first.

    NULL where a column does not vary on these rows.  Beyond a few columns the pairs are made and kept in tasks, by blocks of columns."""
    types = field_types(df)
    names = list(dict.fromkeys(names))
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], PAIRS_SCHEMA)
    values = [as_double(n, types[n]) for n in names]
    if len(names) > SQL_CORRELATION_COLUMNS:
        return pairwise(df.select(F.array(*values).alias("x")), len(names), _correlation_batch(names), PAIRS_SCHEMA)
    flat = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    row = flat.agg(*[F.corr(f"v{i}", f"v{j}").alias(f"r{i}_{j}") for i, j in pairs]).first()
    found = [(names[i], names[j], row[f"r{i}_{j}"]) for i, j in pairs]
    return df.sparkSession.createDataFrame([(a, b, None if r is None or math.isnan(r) else r) for a, b, r in found], PAIRS_SCHEMA)


def _correlation_batch(names: list[str]):
    def finish(a: int, b: int, sums: np.ndarray) -> pa.RecordBatch:
        n, left, right, left_sq, right_sq, product = sums
        n = np.where(n > 0, n, np.nan)
        with np.errstate(invalid="ignore", divide="ignore"):
            spreads = [np.where(q - s * s / n > 1e-12 * q, q - s * s / n, np.nan) for s, q in ((left, left_sq), (right, right_sq))]
            r = np.clip((product - left * right / n) / np.sqrt(spreads[0] * spreads[1]), -1, 1)
        i, j = (np.triu_indices(len(r), 1) if a == b else np.indices(r.shape).reshape(2, -1))
        return pa.RecordBatch.from_arrays([pa.array([names[a + k] for k in i], pa.string()), pa.array([names[b + k] for k in j], pa.string()),
                                           pa.array(r[i, j], pa.float64(), from_pandas=True)], ["col_a", "col_b", "correlation"])
    return finish


def correlations(df: DataFrame, names: list[str]) -> dict[tuple[str, str], float | None]:
    """The pairs of a table of few columns on the driver."""
    return {(r["col_a"], r["col_b"]): r["correlation"] for r in correlation_pairs(df, names).collect()}


def redundant_pairs(df: DataFrame, names: list[str], threshold: float = REDUNDANT_MIN) -> DataFrame:
    return correlation_pairs(df, names).filter(F.abs("correlation") >= threshold).orderBy(F.desc(F.abs("correlation")))


def correlation_matrix(df: DataFrame, names: list[str]) -> DataFrame:
    """All ordered pairs, the diagonal being 1."""
    names = list(dict.fromkeys(names))
    pairs = correlation_pairs(df, names)
    both = pairs.select(F.explode(F.array(F.struct("col_a", "col_b", "correlation"), F.struct(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "correlation"))).alias("p")).select("p.*")
    return both.unionByName(df.sparkSession.createDataFrame([(n, n, 1.0) for n in names], PAIRS_SCHEMA))


def profile_columns(roles: Roles) -> list[str]:
    """Columns that get a numeric summary: the numeric ones and the target."""
    return roles.numeric + ([roles.target] if roles.target in roles.stats else [])
