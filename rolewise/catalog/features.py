"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import to_long
from ..functions.words import STOP_WORDS, TOKEN_PATTERN
from ..operators.clean import clean
from ..operators.features import (add_geo, engineer, expand_datetime, frequency_encode, one_hot, one_hot_sparse,
                                  target_encode, term_table, tfidf)
from ..operators.roles import infer_roles
from .common import PLACES, places, register, rounded, table

QUERIES: dict = {}
SQL: dict[str, str] = {}

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@register(QUERIES, SQL, "one_hot", "SELECT o_orderkey, " + ", ".join(
    [f"(o_orderstatus = '{s}')::BIGINT AS o_orderstatus_{s}" for s in "FOP"]
    + [f"(o_orderpriority = '{p}')::BIGINT AS \"o_orderpriority_{p.replace('-', '_').replace(' ', '_')}\"" for p in _PRIORITIES])
    + " FROM orders")
def dummies(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return rounded(one_hot(df, ["o_orderstatus", "o_orderpriority"])[0])


@register(QUERIES, SQL, "one_hot_sparse", """
SELECT c_name, sum(code) AS codes, sum(n) AS n FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN c_name END AS c_name FROM orders JOIN customer ON c_custkey = o_custkey) o
LEFT JOIN (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS code, 1 AS n FROM (
  SELECT DISTINCT c_name FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 9 <> 0)) USING (c_name) GROUP BY c_name""")
def sparse(spark, folder):
    """Customers' names of the orders as sparse levels: codes and ones of the vectors, summed for each name."""
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    df = orders.join(customers, "o_custkey").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("c_name")).alias("c_name"))
    out, _ = one_hot_sparse(df, ["c_name"])
    ones = F.size(F.regexp_extract_all(F.col("c_name_levels").cast("string"), F.lit(r"1\.0"), F.lit(0)))
    return out.groupBy("c_name").agg(F.sum("c_name_code").alias("codes"), F.sum(F.when(F.col("c_name_code").isNotNull(), ones)).cast("long").alias("n"))


@register(QUERIES, SQL, "frequency_encode", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE props END AS props FROM events),
f AS (SELECT props, count(*) / (SELECT count(props) FROM e)::DOUBLE AS share FROM e WHERE props IS NOT NULL GROUP BY props)
SELECT event_id, round(coalesce(share, 0.0), 6) AS props_freq FROM e LEFT JOIN f USING (props)""")
def frequency(spark, folder):
    df = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 11 != 0, F.col("props")).alias("props"))
    return rounded(frequency_encode(df, "props"))


@register(QUERIES, SQL, "target_encode_oof", """
WITH p AS (SELECT p_partkey, p_brand, p_retailprice AS y, p_partkey % 5 AS fold, p_partkey % 4 <> 0 AS train FROM part),
g AS (SELECT avg(y) AS m FROM p WHERE train),
cf AS (SELECT p_brand, fold, sum(y) AS s, count(*) AS c FROM p WHERE train GROUP BY ALL),
ct AS (SELECT p_brand, sum(s) AS s, sum(c) AS c FROM cf GROUP BY ALL)
SELECT p_partkey, round(CASE WHEN train THEN CASE WHEN ct.c - coalesce(cf.c, 0) > 0
   THEN (ct.s - coalesce(cf.s, 0)) / (ct.c - coalesce(cf.c, 0)) ELSE m END ELSE coalesce(ct.s / ct.c, m) END + 1e-8, 6) AS p_brand
FROM p CROSS JOIN g LEFT JOIN ct USING (p_brand) LEFT JOIN cf ON cf.p_brand = p.p_brand AND cf.fold = p.fold""")
def out_of_fold(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_brand", "p_retailprice")
    out = target_encode(df, ["p_brand"], "p_retailprice", fold=F.col("p_partkey") % 5,
                        is_train=F.col("p_partkey") % 4 != 0)
    # prices have cents, so means can end exactly between two rounded values: move off the tie
    return rounded(out.select("p_partkey", (F.col("p_brand") + 1e-8).alias("p_brand")))


_PARTS = ("year({d})::BIGINT AS d_year", "month({d})::BIGINT AS d_month", "day({d})::BIGINT AS d_day",
          "(isodow({d}) - 1)::BIGINT AS d_dayofweek", "(isodow({d}) >= 6)::BIGINT AS d_is_weekend")
_WAVES = [f"round({fn}(2 * pi() * {part} / {n}.0), 6) AS d_{name}_{fn}"
          for name, part, n in (("month", "month(o_orderdate)", 12), ("dayofweek", "(isodow(o_orderdate) - 1)", 7))
          for fn in ("sin", "cos")]


def _dates(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").alias("d"))


@register(QUERIES, SQL, "datetime_parts",
          "SELECT o_orderkey, " + ", ".join(p.format(d="o_orderdate") for p in _PARTS) + " FROM orders")
def parts(spark, folder):
    out, _ = expand_datetime(_dates(spark, folder), "d", fill=False)
    return rounded(out.select("o_orderkey", "d_year", "d_month", "d_day", "d_dayofweek", "d_is_weekend"))


@register(QUERIES, SQL, "datetime_cyclical", "SELECT o_orderkey, " + ", ".join(
    f"{w.split(' AS ')[0]} + 0.0 AS {w.split(' AS ')[1]}" for w in _WAVES) + " FROM orders")
def cyclical(spark, folder):
    out, names = expand_datetime(_dates(spark, folder), "d", fill=False)
    return rounded(out.select("o_orderkey", *[n for n in names if n.endswith(("_sin", "_cos"))]))


_FILLED = [("d_year", "year(d)"), ("d_month", "month(d)"), ("d_day", "day(d)"), ("d_dayofweek", "(isodow(d) - 1)"),
           ("d_month_sin", "sin(2 * pi() * month(d) / 12.0)"), ("d_dayofweek_cos", "cos(2 * pi() * (isodow(d) - 1) / 7.0)")]


@register(QUERIES, SQL, "datetime_fill", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END AS d FROM orders)
SELECT o_orderkey, """ + ", ".join(
    f"round(coalesce({e}, (SELECT quantile_cont(CAST({e} AS DOUBLE), 0.5) FROM o)), 6) + 0.0 AS {n}" for n, e in _FILLED)
    + ", coalesce((isodow(d) >= 6)::BIGINT, 0)::DOUBLE AS d_is_weekend FROM o")
def fill(spark, folder):
    df = _dates(spark, folder).withColumn("d", F.when(F.col("o_orderkey") % 10 != 0, F.col("d")))
    out, _ = expand_datetime(df, "d")
    return rounded(out.select("o_orderkey", *[n for n, _ in _FILLED], "d_is_weekend"))


_CENTRES = [[-20.0, -40.0], [-20.0, 0.0], [-20.0, 40.0], [0.0, -30.0], [0.0, 30.0], [20.0, -40.0], [20.0, 0.0], [20.0, 40.0]]
_CENTRE_SQL = "(VALUES " + ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(_CENTRES)) + ") AS c(i, clat, clon)"
_GAPPED = f"(SELECT vec_id, CASE WHEN vec_id % 13 = 0 THEN NULL ELSE lat END AS lat, lon FROM {PLACES})"


def _gapped(spark, folder):
    return places(spark, folder).select("vec_id", F.when(F.col("vec_id") % 13 != 0, F.col("lat")).alias("lat"), "lon")


@register(QUERIES, SQL, "geo_assign", f"""
SELECT vec_id, coalesce(k, -1)::BIGINT AS geo_cluster FROM {_GAPPED} p LEFT JOIN (
  SELECT vec_id, arg_min(i, ((lat - clat) ** 2 + (lon - clon) ** 2, i)) AS k FROM {_GAPPED}, {_CENTRE_SQL}
  WHERE lat IS NOT NULL GROUP BY vec_id) USING (vec_id)""")
def geo_assign(spark, folder):
    df = _gapped(spark, folder)
    out, _ = add_geo(df, "lat", "lon", df.count(), _CENTRES)
    return rounded(out.select("vec_id", "geo_cluster"))


@register(QUERIES, SQL, "geo_distance", f"""
WITH d AS (SELECT vec_id, min(sqrt((lat - clat) ** 2 + (lon - clon) ** 2)) AS dist FROM {_GAPPED}, {_CENTRE_SQL} GROUP BY vec_id)
SELECT vec_id, round(coalesce(dist, (SELECT quantile_cont(dist, 0.5) FROM d)), 6) AS geo_dist_to_centroid FROM d""")
def geo_distance(spark, folder):
    df = _gapped(spark, folder)
    out, _ = add_geo(df, "lat", "lon", df.count(), _CENTRES)
    return rounded(out.select("vec_id", "geo_dist_to_centroid"))


@register(QUERIES, SQL, "geo_clusters")
def geo_clusters(spark, folder):
    """Eight fitted places: size and mean distance."""
    df = places(spark, folder)
    out, _ = add_geo(df, "lat", "lon", df.count())
    return out.groupBy("geo_cluster").agg(F.count("*").alias("n"), F.avg("geo_dist_to_centroid").alias("mean_dist"))


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
_TERMS_SQL = f"""
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TOKEN_PATTERN}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
terms AS (SELECT term, sum(tf)::BIGINT AS n_total, count(*) AS n_docs,
  ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1.0 AS idf
  FROM tf WHERE term NOT IN ({_STOP_SQL}) GROUP BY term HAVING count(*) >= 2 ORDER BY n_total DESC, term LIMIT 20)"""


@register(QUERIES, SQL, "tfidf_terms", f"WITH {_TERMS_SQL} SELECT term, n_total, n_docs, round(idf, 6) AS idf FROM terms")
def terms(spark, folder):
    return rounded(term_table(table(spark, folder, "documents"), "text"))


@register(QUERIES, SQL, "tfidf_matrix", f"""
WITH {_TERMS_SQL}, w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN terms USING (term)),
n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, term, round(w / norm, 6) AS weight FROM w JOIN n USING (doc_id)""")
def matrix(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = [(r["term"], r["idf"]) for r in term_table(docs, "text").collect()]
    wide, log = tfidf(docs, "text", found)
    long = to_long(wide, {term: F.col(column) for _, _, column, term in log}, ["doc_id"], "term", "weight")
    return rounded(long.filter("weight > 0"))


@register(QUERIES, SQL, "drop_unusable", """
SELECT unnest(['user_id', 'value', 'value_log', 'props_freq', 'ts_year', 'ts_month', 'ts_day', 'ts_dayofweek', 'ts_is_weekend',
  'ts_month_sin', 'ts_month_cos', 'ts_dayofweek_sin', 'ts_dayofweek_cos']) AS feature
UNION ALL SELECT DISTINCT 'event_type_' || event_type FROM events""")
def final_features(spark, folder):
    """Feature list of the events: the identifier goes, everything else is encoded."""
    df = table(spark, folder, "events")
    roles = infer_roles(df)
    made = engineer(clean(df, roles)[0], roles)
    return spark.createDataFrame([(c,) for c in made.columns], "feature string")


@register(QUERIES, SQL, "engineered_documents")
def engineered(spark, folder):
    """The whole feature table of the documents: dummies, log and TF-IDF columns."""
    df = table(spark, folder, "documents")
    roles = infer_roles(df)
    return engineer(clean(df, roles)[0], roles).table
