"""Association queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.association import (anova_statistics, association_suite, chi_square_statistics, contingency,
                                     mann_whitney_statistics, shapiro_tests, wilcoxon_frame)
from ..operators.baseline import ols
from ..operators.roles import infer_roles
from .common import LINE_NUMERIC, register, revenue, rounded, table, union_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}

_LINE = "(SELECT *, CASE WHEN l_quantity > 25 THEN 'big' ELSE 'small' END AS size_flag FROM lineitem)"


@register(QUERIES, SQL, "crosstab", union_sql([
    f"SELECT '{c}' AS feature, {c} AS level, o_orderstatus AS label, count(*) AS n FROM orders GROUP BY ALL"
    for c in ("o_orderpriority",)]))
def crosstab(spark, folder):
    return contingency(table(spark, folder, "orders"), ["o_orderpriority"], "o_orderstatus")


def _chi_sql(source: str, c: str, target: str) -> str:
    return f"""
SELECT '{c}' AS feature, round(sum(CASE WHEN nr = 2 AND nc = 2 THEN (abs(o - e) - least(0.5, abs(o - e))) ** 2
   ELSE (o - e) ** 2 END / e), 6) AS statistic, (any_value(nr) - 1) * (any_value(nc) - 1) AS dof FROM (
 SELECT coalesce(t.n, 0) AS o, r.n * k.n / s.n::DOUBLE AS e, s.nr, s.nc FROM
  (SELECT {c} AS a, count(*) AS n FROM {source} GROUP BY 1) r CROSS JOIN (SELECT {target} AS b, count(*) AS n FROM {source} GROUP BY 1) k
  CROSS JOIN (SELECT count(*) AS n, count(DISTINCT {c}) AS nr, count(DISTINCT {target}) AS nc FROM {source}) s
  LEFT JOIN (SELECT {c} AS a, {target} AS b, count(*) AS n FROM {source} GROUP BY 1, 2) t ON t.a = r.a AND t.b = k.b)
HAVING any_value(nr) BETWEEN 2 AND 20"""


@register(QUERIES, SQL, "chi_square", union_sql([
    _chi_sql("orders", "o_orderpriority", "o_orderstatus"), _chi_sql(_LINE, "l_returnflag", "l_linestatus"),
    _chi_sql(_LINE, "size_flag", "l_linestatus"), _chi_sql("documents", "lang", "source")]))
def chi(spark, folder):
    line = table(spark, folder, "lineitem").withColumn(
        "size_flag", F.when(F.col("l_quantity") > 25, "big").otherwise("small"))
    parts = [chi_square_statistics(table(spark, folder, "orders"), ["o_orderpriority"], "o_orderstatus"),
             chi_square_statistics(line, ["l_returnflag", "size_flag"], "l_linestatus"),
             chi_square_statistics(table(spark, folder, "documents"), ["lang"], "source")]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def _anova_sql(source: str, c: str, target: str) -> str:
    return f"""
SELECT '{c}' AS feature, round((sum(n * (m - g) ** 2) / (count(*) - 1)) / (sum((n - 1) * v) / (sum(n) - count(*))), 6) AS statistic,
  count(*) - 1 AS dof_between, (sum(n) - count(*))::BIGINT AS dof_within FROM
 (SELECT {target}, count({c}) AS n, avg({c}) AS m, var_samp({c}) AS v FROM {source} GROUP BY 1 HAVING count({c}) >= 2),
 (SELECT avg({c}) AS g FROM {source})"""


@register(QUERIES, SQL, "anova_f", union_sql([_anova_sql("lineitem", c, "l_returnflag") for c in LINE_NUMERIC]
                                             + [_anova_sql("documents", "n_chars", "lang")]))
def anova(spark, folder):
    return rounded(anova_statistics(table(spark, folder, "lineitem"), list(LINE_NUMERIC), "l_returnflag").unionByName(
        anova_statistics(table(spark, folder, "documents"), ["n_chars"], "lang")))


def _u_sql(source: str, c: str, target: str, first: str) -> str:
    return f"""
SELECT '{c}' AS feature, sum(CASE WHEN a THEN r ELSE 0 END) - any_value(n1) * (any_value(n1) + 1) / 2.0 AS u1,
  any_value(n1) AS n1, any_value(n2) AS n2, any_value(ties) AS ties FROM (
 SELECT {target} = '{first}' AS a, rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r FROM {source}),
 (SELECT count(*) FILTER (WHERE {target} = '{first}') AS n1, count(*) FILTER (WHERE {target} <> '{first}') AS n2 FROM {source}),
 (SELECT sum(t * t * t - t) AS ties FROM (SELECT count(*)::DOUBLE AS t FROM {source} GROUP BY {c}))"""


@register(QUERIES, SQL, "mann_whitney_u", union_sql([_u_sql("lineitem", c, "l_linestatus", "F") for c in LINE_NUMERIC]))
def u(spark, folder):
    df = table(spark, folder, "lineitem")
    return mann_whitney_statistics(df, list(LINE_NUMERIC), "l_linestatus", ("F", "O"), df.count())


_SUITE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LINE_NUMERIC)


@register(QUERIES, SQL, "association_suite",
          "SELECT feature, 'Mann-Whitney U' AS test_name, round(u1, 4) AS statistic FROM ("
          + union_sql([_u_sql("lineitem", c, "l_linestatus", "F") for c in _SUITE])
          + ") UNION ALL SELECT feature, 'Chi-square', round(statistic, 4) FROM (" + _chi_sql("lineitem", "l_returnflag", "l_linestatus") + ")")
def suite(spark, folder):
    df = table(spark, folder, "lineitem")
    found = association_suite(df, infer_roles(df, "l_linestatus"))
    return rounded(found.select("feature", "test_name", "statistic"), 4)


@register(QUERIES, SQL, "shapiro_wilk")
def shapiro(spark, folder):
    """Normality of prices, discounts and of the residuals of a regression."""
    df = revenue(spark, folder)
    fit = ols(df, ["l_extendedprice"], "revenue")
    residual = F.col("revenue") - fit.expression(["l_extendedprice"])
    return shapiro_tests(df.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", residual.alias("residuals")),
                         ["l_extendedprice", "l_discount", "residuals"], ["l_orderkey", "l_linenumber"])


_SCORES = ("(SELECT o_orderpriority AS model, o_orderkey % 8 AS fold, avg(o_totalprice) AS value FROM orders "
           "GROUP BY ALL)")


def scores(spark, folder):
    """A score table from the orders: mean price per priority and key group."""
    return table(spark, folder, "orders").groupBy(
        F.col("o_orderpriority").alias("model"), (F.col("o_orderkey") % 8).alias("fold")).agg(
        F.avg("o_totalprice").alias("value"))


@register(QUERIES, SQL, "wilcoxon", f"""
WITH d AS (SELECT a.fold, a.value - b.value AS gap FROM {_SCORES} a JOIN {_SCORES} b USING (fold)
   WHERE a.model = '1-URGENT' AND b.model = '5-LOW' AND a.value <> b.value),
r AS (SELECT row_number() OVER (ORDER BY fold) - 1 AS i, gap, rank() OVER (ORDER BY abs(gap)) + (count(*) OVER (PARTITION BY abs(gap)) - 1) / 2.0 AS r FROM d),
w AS (SELECT least(sum(CASE WHEN gap > 0 THEN r ELSE 0 END), sum(CASE WHEN gap < 0 THEN r ELSE 0 END)) AS w FROM r),
s AS (SELECT m, sum(CASE WHEN (m >> i) & 1 = 1 THEN r ELSE 0 END) AS t FROM r, generate_series(0, 255) AS g(m) GROUP BY m)
SELECT '1-URGENT vs 5-LOW' AS feature, round((SELECT w FROM w), 6) AS statistic,
  round(least(1.0, 2.0 * count(*) FILTER (WHERE t <= (SELECT w FROM w) + 1e-9) / count(*)), 6) AS p_value FROM s""")
def signed_rank(spark, folder):
    return rounded(wilcoxon_frame(scores(spark, folder), "1-URGENT", "5-LOW").select("feature", "statistic", "p_value"))
