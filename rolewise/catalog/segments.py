"""Segment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import row_hash
from ..operators.kmeans import fit_sweep
from ..operators.segments import find_segments, silhouette_scores, squared_silhouettes, standardise, usable_columns
from .common import LINE_NUMERIC, register, rounded, table, union_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}

_SPREAD = {"o_custkey": "o_custkey", "o_totalprice": "CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_totalprice END",
           "fixed": "5.0"}


def _orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.lit(5.0).alias("fixed"))


@register(QUERIES, SQL, "usable_numeric", "SELECT * FROM (" + union_sql([
    f"SELECT '{n}' AS name, round(avg({e}), 4) AS mean, round(stddev_pop({e}), 4) AS std FROM orders" for n, e in _SPREAD.items()])
    + ") WHERE std > 0")
def usable(spark, folder):
    moments = usable_columns(_orders(spark, folder), list(_SPREAD))
    return rounded(spark.createDataFrame([(n, m, s) for n, (m, s) in moments.items()],
                                         "name string, mean double, std double"), 4)


@register(QUERIES, SQL, "standardise", "SELECT o_orderkey, " + ", ".join(
    f"round(({e} - (SELECT avg({e}) FROM orders)) / (SELECT stddev_pop({e}) FROM orders), 6) + 0.0 AS {n}"
    for n, e in _SPREAD.items() if n != "fixed") + " FROM orders")
def scaled(spark, folder):
    df = _orders(spark, folder)
    return rounded(standardise(df, usable_columns(df, list(_SPREAD)), ["o_orderkey"]))


@register(QUERIES, SQL, "silhouette", """
WITH d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, a.vec_id = b.vec_id AS self,
   list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS dist FROM embeddings a, embeddings b),
m AS (SELECT vec_id, la, lb, sum(dist) AS s, count(*) AS n FROM d GROUP BY ALL),
ab AS (SELECT vec_id, max(CASE WHEN la = lb THEN s / greatest(n - 1, 1) END) AS a,
   max(CASE WHEN la = lb THEN n END) AS own, min(CASE WHEN la <> lb THEN s / n END) AS b FROM m GROUP BY vec_id)
SELECT 'label' AS labelling, round(avg(CASE WHEN own > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette FROM ab""")
def silhouette(spark, folder):
    dims = [f"d{i}" for i in range(64)]
    df = table(spark, folder, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(d) for i, d in enumerate(dims)])
    score = silhouette_scores(df, dims, ["label"], keys=["vec_id"])["label"]
    return rounded(spark.createDataFrame([("label", score)], "labelling string, silhouette double"))


def _squared_sql(label: str) -> str:
    pts = f"(SELECT row_number() OVER () AS i, l_quantity::DOUBLE AS x, (l_discount * 100)::DOUBLE AS y, {label} AS l FROM lineitem)"
    return f"""SELECT '{label}' AS labelling, round(avg(CASE WHEN own > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette FROM (
  SELECT max(CASE WHEN p.l = c.l THEN d * n / greatest(n - 1, 1) END) AS a, max(CASE WHEN p.l = c.l THEN n END) AS own, min(CASE WHEN p.l <> c.l THEN d END) AS b FROM (
    SELECT p.*, c.l AS cl, c.n, (p.x - c.mx) ** 2 + (p.y - c.my) ** 2 + c.v AS d FROM {pts} p,
      (SELECT l, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) + var_pop(y) AS v FROM {pts} GROUP BY l) c) p
    JOIN (SELECT DISTINCT {label} AS l FROM lineitem) c ON c.l = p.cl GROUP BY p.i)"""


@register(QUERIES, SQL, "silhouette_squared", union_sql([_squared_sql("l_linenumber"), _squared_sql("(l_quantity >= 25)::INTEGER").replace(
    "'(l_quantity >= 25)::INTEGER'", "'large'")]))
def all_rows(spark, folder):
    """Two labellings of the line items, scored on all rows."""
    df = table(spark, folder, "lineitem").select("l_linenumber", F.col("l_quantity").cast("double").alias("x"), (
        F.col("l_discount") * 100).cast("double").alias("y"), (F.col("l_quantity") >= 25).cast("int").alias("large"))
    scores = squared_silhouettes(df, ["x", "y"], ["l_linenumber", "large"])
    return rounded(spark.createDataFrame(list(scores.items()), "labelling string, silhouette double"))


@register(QUERIES, SQL, "kmeans_sweep")
def sweep(spark, folder):
    """Cost and silhouette (all rows, squared distances) for k = 2..8 with ten restarts over the line items."""
    df = table(spark, folder, "lineitem").select(*LINE_NUMERIC)
    moments = usable_columns(df, list(LINE_NUMERIC))
    scaled = standardise(df, moments)
    fits = fit_sweep(scaled, list(moments), list(range(2, 9)), scored=True)
    return spark.createDataFrame([(k, f.cost, f.silhouette) for k, f in sorted(fits.items())], "k int, cost double, silhouette double")


@register(QUERIES, SQL, "cluster_sizes")
def sizes(spark, folder):
    """Segments of the events by silhouette: rows per segment."""
    return find_segments(table(spark, folder, "events"), ["user_id", "value"], ["event_id"]).sizes()
