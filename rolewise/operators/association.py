"""Association of columns with a classification target, and tests on residuals and scores."""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import pvalues
from ..functions.columns import as_double, field_types, present, q, to_long
from ..functions.ranks import running_counts
from ..functions.shapiro import shapiro_wilk
from ..functions.tables import hash_sample, in_parallel, spread
from .roles import Roles

ALPHA = 0.05
MAX_LEVELS = 20
SHAPIRO_ROWS = 5_000
EXACT_SIDE = 8                  # exact p-value when a side has at most this many rows and no ties
TEST_SCHEMA = ("feature string, test_name string, statistic double, p_value double, "
               "significant boolean")


def tests_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Result rows (feature, test, statistic, p), most significant first."""
    done = [(f, t, float(s), float(p), bool(p < ALPHA)) for f, t, s, p in rows
            if s is not None and p is not None and not math.isnan(s) and not math.isnan(p)]
    done.sort(key=lambda r: (r[3], r[0]))
    return spark.createDataFrame(done, TEST_SCHEMA)


# --- contingency ----------------------------------------------------------------------------

def contingency(df: DataFrame, names: list[str], target: str) -> DataFrame:
    """Counts per (feature, level, label) over rows where both are present."""
    labelled = df.select(*[q(n) for n in dict.fromkeys(names)], q(target).cast("string").alias("_label"))
    long = to_long(labelled, {n: q(n).cast("string") for n in names}, ["_label"], "feature", "level")
    return (long.filter("level is not null and _label is not null")
            .groupBy("feature", "level", F.col("_label").alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))


def chi_square_statistics(df: DataFrame, names: list[str], target: str) -> DataFrame:
    """Statistic and degrees of freedom per feature with 2 to 20 levels, Yates-corrected for 2 x 2.

    The level count is checked on the counted table before any window, so a feature with many
    levels is dropped and not gathered.
    """
    cells = contingency(df, names, target)
    rows = cells.groupBy("feature", "level").agg(F.sum("n").alias("row_n"))
    fits = (rows.groupBy("feature").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("row_n").alias("all_n"))
            .filter(F.col("n_rows").between(2, MAX_LEVELS) & (F.col("all_n") > 0)))
    cells = cells.join(F.broadcast(fits), "feature")      # one row per feature
    cols = cells.groupBy("feature", "label").agg(F.sum("n").alias("col_n"))
    sides = (cols.groupBy("feature").agg(F.count(F.lit(1)).alias("n_cols"), F.sum("col_n").alias("_n"))
             .filter("_n > 0").drop("_n"))
    # Every (level, label) cell counts, also empty ones: sum over cells of (o - e)^2 / e equals
    # the sum over observed cells plus the expected mass of the empty ones.
    joined = (cells.join(rows, ["feature", "level"]).join(cols, ["feature", "label"])
              .join(F.broadcast(sides), "feature"))
    expected = F.col("row_n") * F.col("col_n") / F.col("all_n")
    gap = F.abs(F.col("n") - expected)
    is_2x2 = (F.col("n_rows") == 2) & (F.col("n_cols") == 2)
    shrunk = F.when(is_2x2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
    sums = joined.groupBy("feature").agg(
        F.sum(shrunk * shrunk / expected).alias("seen"), F.sum(expected).alias("seen_mass"),
        F.max("all_n").alias("all_n"), F.max("n_rows").alias("r"), F.max("n_cols").alias("c"),
        F.count(F.lit(1)).alias("cells"), F.max(gap).alias("gap_max"))
    # In a 2 x 2 table all four gaps are equal, and two empty cells have the same expected count.
    empty_mass = F.greatest(F.col("all_n") - F.col("seen_mass"), F.lit(0.0))
    cut = F.col("gap_max") - F.least(F.lit(0.5), F.col("gap_max"))
    n_empty = F.lit(4) - F.col("cells")
    empty = F.when((F.col("r") == 2) & (F.col("c") == 2),
                   F.when(empty_mass > 0, n_empty * n_empty * cut * cut / empty_mass)
                   .otherwise(F.lit(0.0))).otherwise(empty_mass)
    full = F.col("cells") == F.col("r") * F.col("c")
    return (sums.filter("c >= 2")
            .select("feature", (F.col("seen") + F.when(full, F.lit(0.0)).otherwise(empty)).alias("statistic"),
                    ((F.col("r") - 1) * (F.col("c") - 1)).cast("long").alias("dof")))


def chi_square(df: DataFrame, names: list[str], target: str) -> DataFrame:
    if not names:
        return tests_frame(df.sparkSession, [])
    rows = chi_square_statistics(df, names, target).collect()          # one row per feature
    return tests_frame(df.sparkSession, [
        (r["feature"], "Chi-square", r["statistic"], pvalues.chi2_sf(r["statistic"], r["dof"]))
        for r in rows])


# --- numeric columns against three or more classes --------------------------------------------

def anova_statistics(df: DataFrame, names: list[str], target: str) -> DataFrame:
    """F statistic per column; classes with one row are left out.

    One aggregate by class carries all columns; the class means are then combined around the grand
    mean, which keeps the sums of squares well conditioned.
    """
    types = field_types(df)
    by_class = (df.filter(q(target).isNotNull()).groupBy(q(target).cast("string").alias("label"))
                .agg(*[a for i, n in enumerate(names) for a in _group_moments(as_double(n, types[n]), i)]))
    parts = to_long(by_class, {n: F.struct(F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("m"),
                                           F.col(f"v{i}").alias("v")) for i, n in enumerate(names)},
                    ["label"], "feature").select("feature", "value.*").filter("n >= 2")
    grand = parts.groupBy("feature").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("g"))
    sums = (parts.join(F.broadcast(grand), "feature")                 # one row per feature
            .groupBy("feature").agg(
                F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
                F.sum(F.col("n") * F.pow(F.col("m") - F.col("g"), 2)).alias("between"),
                F.sum((F.col("n") - 1) * F.col("v")).alias("within")))
    spread = F.col("within") / (F.col("n") - F.col("k"))
    return (sums.filter("k >= 2 and n > k")
            .select("feature", F.when(spread > 0, F.col("between") / (F.col("k") - 1) / spread)
                    .alias("statistic"), (F.col("k") - 1).cast("long").alias("dof_between"),
                    (F.col("n") - F.col("k")).cast("long").alias("dof_within")))


def _group_moments(col, i):
    return (F.count(col).alias(f"n{i}"), F.avg(col).alias(f"m{i}"), F.var_samp(col).alias(f"v{i}"))


def anova(df: DataFrame, names: list[str], target: str) -> DataFrame:
    """One-way ANOVA for targets with three or more classes; no rows otherwise."""
    if not names or df.agg(F.count_distinct(q(target))).first()[0] < 3:
        return tests_frame(df.sparkSession, [])
    rows = [r for r in anova_statistics(df, names, target).collect() if r["statistic"] is not None]
    return tests_frame(df.sparkSession, [
        (r["feature"], "ANOVA F-test", r["statistic"],
         pvalues.f_sf(r["statistic"], r["dof_between"], r["dof_within"])) for r in rows])


# --- numeric columns against two classes --------------------------------------------------------

def mann_whitney_statistics(df: DataFrame, names: list[str], target: str, labels: tuple[str, str],
                            n_rows: int | None = None) -> DataFrame:
    """U of the first label, class sizes and tie sum per column, exact at any size.

    Rows are first counted per (column, value), which folds ties; the running count of smaller
    values then gives U = sum over values of n1 * (smaller of class 2 + half the equal ones).
    """
    types = field_types(df)
    label = q(target).cast("string")
    base = df.filter(label.isin(*labels)).select(*[q(n) for n in names],
                                                 (label == labels[0]).cast("long").alias("_first"))
    base = base if n_rows is None else spread(base, n_rows)
    long = to_long(base, {n: as_double(n, types[n]) for n in names}, ["_first"], "feature")
    counts = (long.filter("value is not null").groupBy("feature", "value")
              .agg(F.sum("_first").alias("n1"), F.sum(1 - F.col("_first")).alias("n2")))
    ranked = running_counts(counts, ["feature"], "value", {"n2": "below2"})
    both = (F.col("n1") + F.col("n2")).cast("double")
    return ranked.groupBy("feature").agg(
        F.sum(F.col("n1") * (F.col("below2") + F.col("n2") / 2.0)).alias("u1"),
        F.sum("n1").alias("n1"), F.sum("n2").alias("n2"),
        F.sum(both * both * both - both).alias("ties"))


def mann_whitney_p(u1: float, n1: int, n2: int, ties: float) -> float:
    """Two-sided p: exact for a small side without ties, else normal with continuity and ties."""
    if ties == 0 and min(n1, n2) <= EXACT_SIDE and n1 * n2 <= 1_000_000:
        return _exact_u(max(u1, n1 * n2 - u1), n1, n2)
    n = n1 + n2
    variance = n1 * n2 / 12.0 * ((n + 1) - ties / (n * (n - 1.0)))
    if variance <= 0:
        return 1.0
    z = (max(u1, n1 * n2 - u1) - n1 * n2 / 2.0 - 0.5) / math.sqrt(variance)
    return min(1.0, 2.0 * pvalues.normal_sf(z))


def _exact_u(u: float, n1: int, n2: int) -> float:
    """Twice the share of arrangements with at least u, by symmetry those with at most n1 n2 - u.

    The arrangements are the coefficients of a Gaussian binomial: (1 - q^(n+i)) / (1 - q^i) over
    i = 1..m.  The lower tail needs its own coefficients only, so it keeps full precision.
    """
    m, n = min(n1, n2), max(n1, n2)
    last = m * n - math.ceil(u)
    ways = np.zeros(last + 1)
    ways[0] = 1.0
    for i in range(1, m + 1):
        if n + i <= last:
            ways[n + i:] -= ways[:-(n + i)].copy()
        for r in range(min(i, last + 1)):
            ways[r::i] = np.cumsum(ways[r::i])
    return min(1.0, 2.0 * float(ways.sum()) / math.comb(m + n, m))


def mann_whitney(df: DataFrame, names: list[str], target: str, n_rows: int | None = None) -> DataFrame:
    """Mann-Whitney U for targets with exactly two classes, U of the smaller label; else no rows."""
    labels = [r[0] for r in df.filter(q(target).isNotNull()).select(q(target).cast("string"))
              .distinct().limit(3).collect()]
    if not names or len(labels) != 2:
        return tests_frame(df.sparkSession, [])
    rows = mann_whitney_statistics(df, names, target, tuple(sorted(labels)), n_rows).collect()
    return tests_frame(df.sparkSession, [
        (r["feature"], "Mann-Whitney U", r["u1"], mann_whitney_p(r["u1"], r["n1"], r["n2"], r["ties"]))
        for r in rows if r["n1"] >= 2 and r["n2"] >= 2])


def association_suite(df: DataFrame, roles: Roles) -> DataFrame:
    """All tests of a classification run: chi-square, and ANOVA or Mann-Whitney, never both."""
    if roles.task != "classification":
        return tests_frame(df.sparkSession, [])
    parts = in_parallel([partial(chi_square, df, roles.low + roles.high, roles.target),
                         partial(anova, df, roles.numeric, roles.target),
                         partial(mann_whitney, df, roles.numeric, roles.target, roles.n_rows)])
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- residuals and scores -----------------------------------------------------------------------

def shapiro_tests(df: DataFrame, names: list[str], keys: list[str] | None = None,
                  n_rows: int | None = None) -> DataFrame:
    """Shapiro-Wilk per column on at most 5,000 rows drawn by key hash; none below three values."""
    types = field_types(df)
    sample = hash_sample(df.select(*[q(c) for c in dict.fromkeys([*(keys or []), *names])]),
                         SHAPIRO_ROWS, keys, n_rows=n_rows)
    long = to_long(sample, {n: as_double(n, types[n]) for n in names}, name="feature")

    def test(group: pd.DataFrame) -> pd.DataFrame:
        found = shapiro_wilk(group["value"].to_numpy(dtype=float))
        rows = [] if found is None else [(group["feature"].iloc[0], "Shapiro-Wilk", *found,
                                          found[1] < ALPHA)]
        return pd.DataFrame(rows, columns=["feature", "test_name", "statistic", "p_value", "significant"])

    return long.filter("value is not null").groupBy("feature").applyInPandas(test, TEST_SCHEMA)


def wilcoxon(first: list[float], second: list[float]) -> tuple[float, float] | None:
    """Signed-rank statistic and exact two-sided p of paired fold scores; the rank sums of all sign patterns are counted."""
    gaps = [a - b for a, b in zip(first, second) if a != b]
    if not gaps:
        return None
    ranks = pd.Series([abs(g) for g in gaps]).rank().to_numpy()
    plus = float(ranks[np.array(gaps) > 0].sum())
    w = min(plus, float(ranks.sum()) - plus)
    doubled = np.rint(2 * ranks).astype(int)             # ties have half ranks
    share = np.zeros(doubled.sum() + 1)                  # of all sign patterns, by twice their rank sum
    share[0] = 1.0
    for r in doubled:
        share /= 2
        share[r:] += share[:-r].copy()
    return w, min(1.0, 2.0 * float(share[:round(2 * w) + 1].sum()))


def wilcoxon_frame(scores: DataFrame, first: str, second: str) -> DataFrame:
    """Signed-rank test of two models in a table (model, fold, value); rank by |difference|."""
    paired = (scores.filter(F.col("model").isin(first, second)).groupBy("fold")
              .agg((F.max(F.when(F.col("model") == first, F.col("value")))
                    - F.max(F.when(F.col("model") == second, F.col("value")))).alias("gap")))
    gaps = [r["gap"] for r in paired.filter("gap is not null").collect()]     # one row per fold
    found = wilcoxon(gaps, [0.0] * len(gaps))
    name = f"{first} vs {second}"
    return tests_frame(scores.sparkSession, [(name, "Wilcoxon signed-rank", *found)] if found else [])
