"""Tables written between steps, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.tables import shared_dir


def staged(df: DataFrame) -> DataFrame:
    """Written as Parquet below spark.checkpoint.dir and read again: cuts the lineage, survives lost executors.

    The folder goes with `discard`, or when the driver's file system closes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    written = spark.read.schema(schema).parquet(path)
    written.staged_at = where
    return written


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        df.staged_at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(df.staged_at, True)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Only the named columns of a table of the driver."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shards(spark: SparkSession, amount: float, per_shard: float) -> int:
    """As many shards as the amount of data asks for."""
    return max(int(spark.sparkContext.defaultParallelism), int(amount // per_shard) + 1)
