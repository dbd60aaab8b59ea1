"""Chart data queries."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions.normal import normal_quantile_sql
from ..operators import charts
from ..operators.baseline import ols
from .common import EVENTS_GAPS, LINE_NUMERIC, PLACES, REVENUE, events_gaps, places, register, revenue, rounded, table, union_sql
from .modelling import _BY_WORDS, by_words

QUERIES: dict = {}
SQL: dict[str, str] = {}


@register(QUERIES, SQL, "chart_missingness", f"""
SELECT name, round(pct, 6) AS pct FROM (
 SELECT 'event_type' AS name, 100.0 * (count(*) - count(event_type)) / count(*) AS pct FROM {EVENTS_GAPS}
 UNION ALL SELECT 'value', 100.0 * (count(*) - count(value)) / count(*) FROM {EVENTS_GAPS}) WHERE pct > 0""")
def missing(spark, folder):
    return rounded(charts.chart_missingness(events_gaps(spark, folder)))


def _hist_sql(c: str, source: str) -> str:
    return f"""SELECT '{c}' AS name, bin, round(lo + bin * (hi - lo) / 20, 4) AS low, round(lo + (bin + 1) * (hi - lo) / 20, 4) AS high, count(*) AS n
FROM (SELECT least(floor(({c} - lo) / (hi - lo) * 20), 19)::BIGINT AS bin, lo, hi FROM {source},
 (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM {source})) GROUP BY bin, lo, hi"""


@register(QUERIES, SQL, "histogram", union_sql([_hist_sql(c, "lineitem") for c in LINE_NUMERIC] + [_hist_sql("value", "events")]))
def hist(spark, folder):
    return rounded(charts.histogram(table(spark, folder, "lineitem"), list(LINE_NUMERIC)).unionByName(
        charts.histogram(table(spark, folder, "events"), ["value"])), 4)


def _density_sql(name, source):
    return f"""SELECT '{name}' AS name, i::INTEGER AS point, round(density * (z - a), 3) + 0.0 AS scaled FROM (
  SELECT i, any_value(a) AS a, any_value(z) AS z, sum(exp(-0.5 * ((a + i * (z - a) / 199 - v) / w) ** 2)) / any_value(n * w * sqrt(2 * pi())) AS density
  FROM (SELECT {name}::DOUBLE AS v FROM {source}), range(200) p(i),
    (SELECT min({name})::DOUBLE AS a, max({name})::DOUBLE AS z, count({name}) AS n, stddev_samp({name}) * count({name}) ** -0.2 AS w FROM {source})
  WHERE v IS NOT NULL GROUP BY i)"""


@register(QUERIES, SQL, "density", _density_sql("l_extendedprice", "lineitem") + " UNION ALL " + _density_sql("value", "events"))
def curve(spark, folder):
    """Density times the range of the column at 200 points."""
    both = charts.density(table(spark, folder, "lineitem"), ["l_extendedprice"]).unionByName(charts.density(table(spark, folder, "events"), ["value"]))
    width = F.max("x").over(Window.partitionBy("name")) - F.min("x").over(Window.partitionBy("name"))       # 200 rows each
    return rounded(both.select("name", "point", (F.col("density") * width).alias("scaled")), 3)


@register(QUERIES, SQL, "target_by_category", """
WITH q AS (SELECT event_type AS category, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
   quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
SELECT row_number() OVER (ORDER BY q.median DESC, q.category) AS position, q.category, any_value(q.n) AS n, round(any_value(q1), 4) AS q1,
 round(q.median, 4) AS median, round(any_value(q3), 4) AS q3,
 round(min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_low,
 round(max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
 count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM events e JOIN q ON q.category = e.event_type GROUP BY q.category, q.median""")
def boxes(spark, folder):
    return rounded(charts.target_by_category(table(spark, folder, "events"), "value", "event_type"), 4)


@register(QUERIES, SQL, "target_by_part", SQL["target_by_category"].replace(
    "FROM events", "FROM (SELECT l_partkey::VARCHAR AS event_type, l_extendedprice AS value FROM lineitem)"))
def boxes_by_part(spark, folder):
    """Prices by part: a level for every part."""
    return rounded(charts.target_by_category(table(spark, folder, "lineitem"), "l_extendedprice", "l_partkey"), 4)


@register(QUERIES, SQL, "geo_grid", f"""
SELECT floor(lat / 5)::BIGINT AS lat_cell, floor(lon / 5)::BIGINT AS lon_cell, count(*) AS n, round(avg(label), 6) AS target_mean
FROM {PLACES} GROUP BY 1, 2""")
def grid(spark, folder):
    return rounded(charts.geo_grid(places(spark, folder), "lat", "lon", 5.0, target="label"))


@register(QUERIES, SQL, "pca_variance", f"""
SELECT component::BIGINT AS component, round(CASE component WHEN 1 THEN (1 + abs(r)) / 2 ELSE (1 - abs(r)) / 2 END, 6) AS explained_variance
FROM (SELECT corr(l_extendedprice, revenue) AS r FROM {REVENUE}), generate_series(1, 2) AS g(component)""")
def variance(spark, folder):
    return rounded(charts.pca(revenue(spark, folder), ["l_extendedprice", "revenue"])[1])


@register(QUERIES, SQL, "pca_projection")
def projection(spark, folder):
    dims = [f"d{i}" for i in range(64)]
    df = table(spark, folder, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(d) for i, d in enumerate(dims)])
    return charts.pca(df, dims, ["vec_id", "label"])[0]


_RESIDUALS = f"""(SELECT a + b * x AS fitted, y - a - b * x AS residual FROM {_BY_WORDS},
 (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM {_BY_WORDS}))"""


def _residuals(spark, folder):
    df = by_words(spark, folder)
    rule = ols(df, ["x"], "y").expression(["x"])
    return df.select(rule.alias("fitted"), (F.col("y") - rule).alias("residual"))


@register(QUERIES, SQL, "residual_bins", f"""
SELECT least(floor((fitted - f0) / (f1 - f0) * 20), 19)::BIGINT AS fitted_bin, least(floor((residual - r0) / (r1 - r0) * 20), 19)::BIGINT AS residual_bin,
 count(*) AS n FROM {_RESIDUALS}, (SELECT min(fitted) AS f0, max(fitted) AS f1, min(residual) AS r0, max(residual) AS r1 FROM {_RESIDUALS})
GROUP BY 1, 2""")
def bins(spark, folder):
    return rounded(charts.residual_bins(_residuals(spark, folder)))


_PROBS = ", ".join(f"{i / 100}" for i in range(1, 100))


@register(QUERIES, SQL, "qq_points", f"""
SELECT p, round(v, 4) + 0.0 AS observed FROM (SELECT unnest([{_PROBS}]::DOUBLE[]) AS p,
  unnest(quantile_cont(residual, [{_PROBS}])) AS v FROM {_RESIDUALS})""")
def qq(spark, folder):
    return rounded(charts.qq_points(_residuals(spark, folder)).select("p", "observed"), 4)


@register(QUERIES, SQL, "qq_line", f"""
SELECT round(regr_slope(v, x), 4) AS slope, round(regr_intercept(v, x), 4) AS intercept, round(corr(v, x), 6) AS r, count(*) AS n FROM (
  SELECT v, {normal_quantile_sql('p')} AS x FROM (
    SELECT residual AS v, CASE WHEN i = n THEN 0.5e0 ** (1e0 / n) WHEN i = 1 THEN 1e0 - 0.5e0 ** (1e0 / n) ELSE (i - 0.3175e0) / (n + 0.365e0) END AS p
    FROM (SELECT residual, row_number() OVER (ORDER BY residual) AS i, count(*) OVER () AS n FROM {_RESIDUALS})))""")
def line(spark, folder):
    return rounded(charts.qq_line(_residuals(spark, folder)), 4, r=6)
