"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.clean import clean, coerce_numeric, drop_missing_target
from ..operators.roles import infer_roles
from .common import EVENTS_GAPS, events_gaps, register, rounded, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _cleaned(spark, folder, **options):
    df = events_gaps(spark, folder)
    return clean(df, infer_roles(df), **options)[0]


@register(QUERIES, SQL, "coerce_numeric", r"""
SELECT o_orderkey, round(CASE WHEN regexp_full_match(t, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*')
  THEN try_cast(trim(t) AS DOUBLE) END, 6) AS amount FROM
(SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN ' 12.5 ' WHEN 2 THEN '1e3x'
  ELSE CAST(o_totalprice AS VARCHAR) END AS t FROM orders)""")
def coerce(spark, folder):
    kind = F.col("o_orderkey") % 5
    text = (F.when(kind == 0, "n/a").when(kind == 1, " 12.5 ").when(kind == 2, "1e3x")
            .otherwise(F.col("o_totalprice").cast("string")))
    df = table(spark, folder, "orders").select("o_orderkey", text.alias("amount"))
    return rounded(coerce_numeric(df, ["amount"]))


@register(QUERIES, SQL, "impute_median", f"""
SELECT event_id, round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM {EVENTS_GAPS})), 6) AS value FROM {EVENTS_GAPS}""")
def impute_median(spark, folder):
    return rounded(_cleaned(spark, folder).select("event_id", "value"))


@register(QUERIES, SQL, "impute_mean", f"""
SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM {EVENTS_GAPS})), 6) AS value FROM {EVENTS_GAPS}""")
def impute_mean(spark, folder):
    return rounded(_cleaned(spark, folder, strategy="mean").select("event_id", "value"))


@register(QUERIES, SQL, "cap_outliers", f"""
WITH f AS (SELECT event_id, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM {EVENTS_GAPS})) AS value FROM {EVENTS_GAPS}),
q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM f)
SELECT event_id, round(greatest(q1 - 1.5 * (q3 - q1), least(q3 + 1.5 * (q3 - q1), value)), 6) AS value FROM f, q""")
def cap(spark, folder):
    return rounded(_cleaned(spark, folder, cap_outliers=True).select("event_id", "value"))


@register(QUERIES, SQL, "log1p_skewed", f"""
SELECT event_id, round(ln(1 + coalesce(value, (SELECT quantile_cont(value, 0.5) FROM {EVENTS_GAPS}))), 6) AS value_log FROM {EVENTS_GAPS}""")
def log_companion(spark, folder):
    return rounded(_cleaned(spark, folder).select("event_id", "value_log"))


@register(QUERIES, SQL, "impute_mode", f"""
SELECT event_id, coalesce(event_type, (SELECT event_type FROM {EVENTS_GAPS} WHERE event_type IS NOT NULL
  GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)) AS event_type FROM {EVENTS_GAPS}""")
def impute_mode(spark, folder):
    return _cleaned(spark, folder).select("event_id", "event_type")


@register(QUERIES, SQL, "drop_missing_target", f"SELECT event_id, event_type FROM {EVENTS_GAPS} WHERE event_type IS NOT NULL")
def drop_target(spark, folder):
    return drop_missing_target(events_gaps(spark, folder), "event_type").select("event_id", "event_type")
