"""Shared inputs of the registered queries: tables and columns derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Doubles rounded for comparison, integers widened, dates as text."""
    out = []
    for name, dtype in df.dtypes:
        col = F.col(name)
        if dtype in ("double", "float"):
            places = special.get(name, digits)
            col = F.round(col, places) + F.lit(0.0)          # no negative zero
        elif dtype in ("int", "smallint", "tinyint"):
            col = col.cast("bigint")
        elif dtype == "date":
            col = col.cast("string")
        out.append(col.alias(name))
    return df.select(*out)


def register(queries: dict, sql: dict, name: str, oracle: str | None = None):
    """Decorator: adds the query and, if given, its SQL."""
    def add(fn: Query) -> Query:
        queries[name] = fn
        if oracle is not None:
            sql[name] = oracle
        return fn
    return add


# Events with every tenth value and every seventh type missing.
EVENTS_GAPS = ("(SELECT event_id, ts, user_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type, "
               "CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value, props FROM events)")


def events_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumns({
        "event_type": F.when(F.col("event_id") % 7 != 0, F.col("event_type")),
        "value": F.when(F.col("event_id") % 10 != 0, F.col("value"))})


# Line items with the revenue, a target that depends on two of the other columns.
REVENUE = "(SELECT *, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem)"
LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def revenue(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").withColumn(
        "revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))


# Embedding dimensions read as places.
PLACES = ("(SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) * 90 AS lat, "
          "CAST(embedding[2] AS DOUBLE) * 180 AS lon FROM embeddings)")


def places(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id", "label", (F.col("embedding")[0].cast("double") * 90).alias("lat"),
        (F.col("embedding")[1].cast("double") * 180).alias("lon"))


def unit_of(key: str) -> Column:
    """Arithmetic stand-in for the hash, so that SQL can repeat a split."""
    return F.pmod(F.col(key) * F.lit(7919), F.lit(100003)) / F.lit(100003.0)


def unit_sql(key: str) -> str:
    return f"(({key} * 7919) % 100003) / 100003.0"


def union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)
