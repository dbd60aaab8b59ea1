"""Scans, previews, samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.tables import shared_dir
from ..sources.reader import MISSING, csv_facts, load_table, peek, preview, sample_rows
from .common import register, rounded, table

QUERIES: dict = {}
SQL: dict[str, str] = {}

_ORDERS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
           ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@register(QUERIES, SQL, "scan_parquet", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem GROUP BY ALL""")
def scan_parquet(spark, folder):
    df = load_table(spark, f"{folder}/lineitem.parquet")
    return rounded(df.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")), 2)


@register(QUERIES, SQL, "scan_csv", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, round(c_acctbal, 6) AS c_acctbal,
       c_mktsegment FROM customer""")
def scan_csv(spark, folder):
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    table(spark, folder, "customer").write.option("header", True).csv(path)
    return rounded(load_table(spark, path))


@register(QUERIES, SQL, "csv_encoding", """
SELECT 'ISO-8859-1' AS written, 'cp1252' AS encoding, true AS multi_line, count(*) AS n,
       sum(n_chars)::BIGINT AS chars FROM documents
UNION ALL
SELECT 'UTF-8', 'utf-8', true, count(*), sum(n_chars)::BIGINT FROM documents""")
def csv_encoding(spark, folder):
    """Documents written in two charsets and read back: the charset and the line breaks are found."""
    docs, out = table(spark, folder, "documents").select("doc_id", "text", "n_chars"), None
    for charset in ("UTF-8", "ISO-8859-1"):
        path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
        docs.write.option("header", True).option("escape", '"').option("encoding", charset).csv(path)
        facts = csv_facts(spark, path)
        part = load_table(spark, path).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars")).select(
            F.lit(charset).alias("written"), F.lit(facts["encoding"]).alias("encoding"),
            F.lit(facts["multi_line"]).alias("multi_line"), "n", "chars")
        out = part if out is None else out.unionByName(part)
    return out


@register(QUERIES, SQL, "csv_multiline", f"""
SELECT doc_id, CASE WHEN text IN ({', '.join("'" + m + "'" for m in MISSING)}) THEN NULL ELSE text END AS text, lang || ' 5" pipe' AS lang, n_chars FROM documents""")
def csv_multiline(spark, folder):
    """Documents as CSV lines: texts in quotes with their line breaks, a lone inch mark in a field without quotes."""
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    row = F.concat_ws(",", F.col("doc_id").cast("string"), F.coalesce(quoted, F.lit("")), F.concat("lang", F.lit(' 5" pipe')), F.col("n_chars").cast("string"))
    head = F.lit("doc_id,text,lang,n_chars\n")
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    lines = table(spark, folder, "documents").withColumn("i", F.monotonically_increasing_id())
    first = F.pmod("i", F.lit(1 << 33)) == 0                         # each file begins with the header
    lines.select(F.when(first, F.concat(head, row)).otherwise(row).alias("value")).write.text(path)
    return load_table(spark, path)


@register(QUERIES, SQL, "table_peek", "SELECT position::BIGINT AS position, name, dtype, n_rows, 6::BIGINT AS n_cols FROM (VALUES "
          + ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(_ORDERS))
          + ") AS v(position, name, dtype), (SELECT count(*) AS n_rows FROM orders)")
def table_peek(spark, folder):
    return rounded(peek(table(spark, folder, "orders")))


@register(QUERIES, SQL, "sample_rows")
def sample(spark, folder):
    """2,000 rows by key hash, the same for any partitioning."""
    return sample_rows(table(spark, folder, "orders"), 2_000, ["o_orderkey"])


@register(QUERIES, SQL, "preview", "SELECT event_id, user_id, event_type, value, props FROM events ORDER BY event_id LIMIT 10")
def first_rows(spark, folder):
    return preview(table(spark, folder, "events").drop("ts"), ["event_id"])
