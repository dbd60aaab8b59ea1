"""Roles and profile."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.tables import in_parallel
from ..operators.profile import (class_balance, correlation_matrix, missing_shares, numeric_frame,
                                 numeric_profiles, redundant_pairs, table_profile, top_values)
from ..operators.roles import column_stats, datetime_shares, geo_shares, infer_roles, infer_task, stats_frame
from .common import (EVENTS_GAPS, LINE_NUMERIC, REVENUE, events_gaps, register, revenue, rounded, table,
                     union_sql)

QUERIES: dict = {}
SQL: dict[str, str] = {}

# Columns of the tables by kind: n numeric, s text, d date.
TABLES = {
    "lineitem": "n l_orderkey bigint,n l_partkey bigint,n l_suppkey bigint,n l_linenumber int,"
                "n l_quantity double,n l_extendedprice double,n l_discount double,n l_tax double,"
                "s l_returnflag string,s l_linestatus string,d l_shipdate timestamp_ntz",
    "orders": "n o_orderkey bigint,n o_custkey bigint,s o_orderstatus string,n o_totalprice double,"
              "d o_orderdate timestamp_ntz,s o_orderpriority string",
    "events": "n event_id bigint,d ts timestamp_ntz,n user_id bigint,s event_type string,n value double,"
              "s props string",
    "documents": "n doc_id bigint,s text string,s lang string,s source string,n n_chars bigint",
    "customer": "n c_custkey bigint,s c_name string,n c_nationkey int,n c_acctbal double,s c_mktsegment string",
    "part": "n p_partkey bigint,s p_name string,s p_brand string,s p_type string,n p_size int,"
            "n p_retailprice double",
    "pages": "n page_id bigint,s url string,s html string",
    "conversations": "n conv_id bigint,n turn bigint,s role string,s text string",
}
_ISO_SQL = r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?)?$"


def _columns(name: str) -> list[tuple[str, str, str]]:
    return [tuple(part.split()) for part in TABLES[name].split(",")]


def _stats_sql(name: str) -> str:
    return union_sql([
        f"SELECT '{name}' AS source, '{c}' AS name, '{t}' AS dtype, count(*) AS n_rows, "
        f"count(*) - count({c}) AS n_missing, round((count(*) - count({c})) / count(*)::DOUBLE, 6) AS pct_missing, "
        f"count(DISTINCT {c}) AS n_unique FROM {name}" for _, c, t in _columns(name)])


def _date_share_sql(c: str) -> str:
    return (f"avg(CASE WHEN regexp_matches(trim({c}), '{_ISO_SQL}') AND "
            f"try_cast(trim({c}) AS TIMESTAMP) IS NOT NULL THEN 1.0 ELSE 0.0 END)")


def _role_sql(name: str, source: str | None = None, columns=None) -> str:
    parts = []
    for kind, c, t in columns or _columns(name):
        named_id = "true" if any(p in c.lower() for p in ("uuid", "guid")) or c.endswith("_id") or c == "id" else "false"
        hinted = "true" if any(p in c.lower() for p in ("date", "time", "year", "month", "day")) else "false"
        if kind == "d":
            rule = "CASE WHEN u <= 1 THEN 'constant' ELSE 'datetime' END"
            extra = "0 AS len, 0 AS dates"
        elif kind == "n":
            rule = (f"CASE WHEN u <= 1 THEN 'constant' WHEN {named_id} AND u / n >= 0.98 THEN 'identifier' "
                    "ELSE 'numeric' END")
            extra = "0 AS len, 0 AS dates"
        else:
            rule = (f"CASE WHEN u <= 1 THEN 'constant' WHEN dates >= 0.95 OR ({hinted} AND dates >= 0.7) THEN 'datetime' "
                    "WHEN u / n >= 0.98 AND len < 25 THEN 'identifier' WHEN u <= 20 THEN 'categorical_low' "
                    "WHEN u / n < 0.5 AND len < 25 THEN 'categorical_high' ELSE 'text' END")
            extra = f"avg(length({c})) AS len, {_date_share_sql(c)} AS dates"
        parts.append(f"SELECT '{name}' AS source, '{c}' AS name, '{t}' AS dtype, {rule} AS role, u::BIGINT AS n_unique, "
                     f"round(100.0 * miss / n, 1) AS pct_missing FROM (SELECT count(*)::DOUBLE AS n, "
                     f"count(*) - count({c}) AS miss, count(DISTINCT {c}) AS u, {extra} FROM {source or name})")
    return union_sql(parts)


@register(QUERIES, SQL, "column_stats", union_sql([_stats_sql(t) for t in TABLES]))
def stats(spark, folder):
    found = in_parallel([partial(column_stats, table(spark, folder, name)) for name in TABLES])
    parts = [stats_frame(spark, s).withColumn("source", F.lit(n)) for n, s in zip(TABLES, found)]
    return rounded(reduce(DataFrame.unionByName, parts))


@register(QUERIES, SQL, "infer_roles", union_sql([_role_sql(t) for t in TABLES]))
def roles(spark, folder):
    found = in_parallel([partial(infer_roles, table(spark, folder, name)) for name in TABLES])
    parts = [r.table(spark).withColumn("source", F.lit(n)) for n, r in zip(TABLES, found)]
    return rounded(reduce(DataFrame.unionByName, parts))


@register(QUERIES, SQL, "role_table", _role_sql("events", EVENTS_GAPS))
def role_table(spark, folder):
    return rounded(infer_roles(events_gaps(spark, folder)).table(spark).withColumn("source", F.lit("events")))


_TEXT_DATES = ("(SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS placed, "
               "CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS due_date, "
               "CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS mark, "
               "o_orderpriority FROM orders)")


@register(QUERIES, SQL, "datetime_detect", union_sql([
    f"SELECT '{c}' AS name, round({_date_share_sql(c)}, 6) AS parse_share, "
    f"{_date_share_sql(c)} >= {limit} AS is_datetime FROM {_TEXT_DATES}"
    for c, limit in (("placed", 0.95), ("due_date", 0.7), ("mark", 0.95), ("o_orderpriority", 0.95))]))
def datetime_detect(spark, folder):
    day = F.to_date("o_orderdate").cast("string")
    some = F.when(F.col("o_orderkey") % 5 == 0, "unknown").otherwise(day)
    return rounded(datetime_shares(table(spark, folder, "orders").select(
        day.alias("placed"), some.alias("due_date"), some.alias("mark"), "o_orderpriority")))


_GEO = {"lat": ("CAST(embedding[1] AS DOUBLE) * 90", 90), "latitude": ("CAST(embedding[2] AS DOUBLE) * 900", 90),
        "lon": ("CAST(embedding[3] AS DOUBLE) * 180", 180),
        "lng": ("CASE WHEN vec_id % 10 = 0 THEN NULL ELSE CAST(embedding[4] AS DOUBLE) * 180 END", 180)}


@register(QUERIES, SQL, "geo_detect", union_sql([
    f"SELECT '{n}' AS name, {'round(s, 6)' if w == 90 else '0.0::DOUBLE'} AS lat_share, "
    f"{'round(s, 6)' if w == 180 else '0.0::DOUBLE'} AS lon_share, CASE WHEN s > 0.95 THEN "
    f"'{'geo_lat' if w == 90 else 'geo_lon'}' ELSE 'numeric' END AS role FROM (SELECT "
    f"avg(CASE WHEN {e} BETWEEN -{w} AND {w} THEN 1.0 ELSE 0.0 END) AS s FROM embeddings)"
    for n, (e, w) in _GEO.items()]))
def geo_detect(spark, folder):
    e = [F.col("embedding")[i].cast("double") for i in range(4)]
    return rounded(geo_shares(table(spark, folder, "embeddings").select(
        (e[0] * 90).alias("lat"), (e[1] * 900).alias("latitude"), (e[2] * 180).alias("lon"),
        F.when(F.col("vec_id") % 10 != 0, e[3] * 180).alias("lng"))))


_TARGETS = (("lineitem", "l_linestatus", False), ("orders", "o_totalprice", True), ("embeddings", "label", True),
            ("labels", "quality", True), ("events", "value", True), ("documents", "n_chars", True))


@register(QUERIES, SQL, "infer_task", union_sql([
    f"SELECT '{t}' AS source, '{c}' AS target, CASE WHEN {str(num).lower()} AND count(DISTINCT {c}) > 15 "
    f"THEN 'regression' ELSE 'classification' END AS task FROM {t}" for t, c, num in _TARGETS]))
def task(spark, folder):
    rows = [(t, c, infer_task(column_stats(table(spark, folder, t).select(c))[c])) for t, c, _ in _TARGETS]
    return spark.createDataFrame(rows, "source string, target string, task string")


@register(QUERIES, SQL, "table_profile", """
SELECT (SELECT count(*) FROM conversations) AS n_rows, 2::BIGINT AS n_cols,
       (SELECT count(*) FROM conversations) - (SELECT count(*) FROM (SELECT DISTINCT role, text FROM conversations)) AS duplicate_rows""")
def shape(spark, folder):
    return table_profile(table(spark, folder, "conversations").select("role", "text"))


@register(QUERIES, SQL, "duplicate_rows", """
SELECT (SELECT count(*) FROM documents) AS n_rows, 2::BIGINT AS n_cols,
       (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS duplicate_rows""")
def duplicates(spark, folder):
    return table_profile(table(spark, folder, "documents").select("text", "lang"))


@register(QUERIES, SQL, "missingness", f"""
SELECT name, n_missing, round(n_missing / n::DOUBLE, 6) AS pct_missing FROM (
  SELECT 'event_type' AS name, count(*) - count(event_type) AS n_missing, count(*) AS n FROM {EVENTS_GAPS}
  UNION ALL SELECT 'value', count(*) - count(value), count(*) FROM {EVENTS_GAPS}) WHERE n_missing > 0""")
def missing(spark, folder):
    return rounded(missing_shares(events_gaps(spark, folder)))


def _profile_sql(name: str, source: str) -> str:
    return f"""
SELECT '{name}' AS name, s.n, round(s.mean, 4) AS mean, round(s.std, 4) AS std, round(s.lo, 4) AS min, round(s.hi, 4) AS max,
  round(s.q2, 4) AS median, round(s.skew, 4) AS skew, abs(s.skew) >= 1 AS is_skewed, o.n_outliers,
  round(o.n_outliers / s.n::DOUBLE, 4) AS pct_outliers,
  round(CASE WHEN q3 > q1 THEN q1 - 1.5 * (q3 - q1) END, 6) AS lower_fence,
  round(CASE WHEN q3 > q1 THEN q3 + 1.5 * (q3 - q1) END, 6) AS upper_fence
FROM (SELECT count(v) AS n, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS lo, max(v) AS hi, quantile_cont(v, 0.5) AS q2,
  quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, skewness(v) AS skew FROM (SELECT CAST({name} AS DOUBLE) AS v FROM {source})) s,
 (SELECT count(*) FILTER (WHERE q3 > q1 AND (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))) AS n_outliers
  FROM (SELECT CAST({name} AS DOUBLE) AS v FROM {source}), (SELECT quantile_cont(CAST({name} AS DOUBLE), 0.25) AS q1,
  quantile_cont(CAST({name} AS DOUBLE), 0.75) AS q3 FROM {source})) o"""


@register(QUERIES, SQL, "numeric_profile", union_sql(
    [_profile_sql(c, "lineitem") for c in (*LINE_NUMERIC, "l_linenumber")]
    + [_profile_sql("value", EVENTS_GAPS), _profile_sql("n_chars", "documents")]))
def numeric(spark, folder):
    profiles = numeric_profiles(table(spark, folder, "lineitem"), [*LINE_NUMERIC, "l_linenumber"])
    profiles |= numeric_profiles(events_gaps(spark, folder), ["value"])
    profiles |= numeric_profiles(table(spark, folder, "documents"), ["n_chars"])
    return rounded(numeric_frame(spark, profiles), 4, lower_fence=6, upper_fence=6)


@register(QUERIES, SQL, "iqr_outliers", "SELECT name, n_outliers, lower_fence, upper_fence FROM ("
          + union_sql([_profile_sql("value", "events"), _profile_sql("n_chars", "documents"),
                       _profile_sql("o_totalprice", "orders")]) + ")")
def outliers(spark, folder):
    profiles = {}
    for source, name in (("events", "value"), ("documents", "n_chars"), ("orders", "o_totalprice")):
        profiles |= numeric_profiles(table(spark, folder, source), [name])
    return rounded(numeric_frame(spark, profiles).select("name", "n_outliers", "lower_fence", "upper_fence"))


def _top_sql(source: str, columns: list[str]) -> str:
    return union_sql([f"SELECT '{c}' AS name, value, n, rank FROM (SELECT {c} AS value, count(*) AS n, "
                      f"row_number() OVER (ORDER BY count(*) DESC, {c}) AS rank FROM {source} WHERE {c} IS NOT NULL "
                      f"GROUP BY {c}) WHERE rank <= 10" for c in columns])


@register(QUERIES, SQL, "top_values", union_sql([_top_sql(EVENTS_GAPS, ["event_type", "props"]),
                                                 _top_sql("part", ["p_brand", "p_name", "p_type"])]))
def top(spark, folder):
    return rounded(top_values(events_gaps(spark, folder), ["event_type", "props"]).unionByName(
        top_values(table(spark, folder, "part"), ["p_brand", "p_name", "p_type"])))


def _balance_sql(source: str, c: str) -> str:
    return f"""SELECT '{c}' AS target, label, n, label = majority AS is_majority, label = minority AS is_minority,
 round(most / least::DOUBLE, 6) AS imbalance_ratio, most / least::DOUBLE >= 1.5 AS is_imbalanced FROM
 (SELECT CAST({c} AS VARCHAR) AS label, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1),
 (SELECT max(n) AS most, min(n) AS least, arg_max(label, (n, -ord)) AS majority, arg_min(label, (n, -ord)) AS minority FROM
  (SELECT CAST({c} AS VARCHAR) AS label, count(*) AS n, row_number() OVER (ORDER BY CAST({c} AS VARCHAR)) AS ord
   FROM {source} WHERE {c} IS NOT NULL GROUP BY 1))"""


@register(QUERIES, SQL, "class_balance", union_sql([_balance_sql("labels", "quality"), _balance_sql("orders", "o_orderstatus"),
                                                    _balance_sql(EVENTS_GAPS, "event_type")]))
def balance(spark, folder):
    parts = [class_balance(df, c).withColumn("target", F.lit(c)) for df, c in (
        (table(spark, folder, "labels"), "quality"), (table(spark, folder, "orders"), "o_orderstatus"),
        (events_gaps(spark, folder), "event_type"))]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


_PAIR_COLUMNS = [*LINE_NUMERIC, "revenue"]


@register(QUERIES, SQL, "redundant_pairs", "SELECT * FROM (" + union_sql([
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS correlation FROM {REVENUE}"
    for i, a in enumerate(_PAIR_COLUMNS) for b in _PAIR_COLUMNS[i + 1:]]) + ") WHERE abs(correlation) >= 0.9")
def redundant(spark, folder):
    return rounded(redundant_pairs(revenue(spark, folder), _PAIR_COLUMNS))


def _corr_sql(a: str, b: str) -> str:
    if a == b:
        return f"SELECT '{a}' AS col_a, '{b}' AS col_b, 1.0::DOUBLE AS correlation"
    return f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS correlation FROM {REVENUE}"


@register(QUERIES, SQL, "correlation_matrix", union_sql([_corr_sql(a, b) for a in _PAIR_COLUMNS for b in _PAIR_COLUMNS]))
def correlation(spark, folder):
    return rounded(correlation_matrix(revenue(spark, folder), _PAIR_COLUMNS))


@register(QUERIES, SQL, "correlation_wide", """
WITH long AS (SELECT vec_id, unnest(generate_series(1, 64)) AS i, unnest(embedding) AS raw FROM embeddings),
v AS (SELECT vec_id, i, CASE WHEN (vec_id + i) % 9 = 0 THEN NULL ELSE CAST(raw AS DOUBLE) END AS x FROM long)
SELECT 'd' || (a.i - 1) AS col_a, 'd' || (b.i - 1) AS col_b,
       CASE WHEN a.i = b.i THEN 1.0 ELSE round(corr(a.x, b.x), 6) END AS correlation
FROM v a JOIN v b USING (vec_id) GROUP BY a.i, b.i""")
def correlation_wide(spark, folder):
    """All 64 dimensions, each with its own gaps: pairwise-complete correlations in one pass."""
    e = table(spark, folder, "embeddings")
    dims = [F.when((F.col("vec_id") + i + 1) % 9 != 0, F.col("embedding")[i].cast("double")).alias(f"d{i}")
            for i in range(64)]
    return rounded(correlation_matrix(e.select(*dims), [f"d{i}" for i in range(64)]))
