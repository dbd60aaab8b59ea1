"""Whole-table positions without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .stage import staged

_PLACE = 33                 # monotonically_increasing_id: partition above, place in it below


def numbered(df: DataFrame, group: str, order: list[Column], n_parts: int) -> DataFrame:
    """The rows with `pos` (from 0, in the order given within `group`) and `n` (rows of the group).

    Rows are dealt by range of (group, order, a row number), so a group of any share is many partitions and equal rows
    are parted too.  Each partition is sorted and numbered; only a row for each (partition, group) is added up.
    """
    ordered = df.withColumn("_row", F.monotonically_increasing_id())
    keys = [F.col(group).asc_nulls_first(), *order, F.col("_row")]
    dealt = ordered.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    return _placed(dealt, group)


def indexed(df: DataFrame) -> DataFrame:
    """The rows with `pos` (from 0, without gaps, in the order of the partitions) and `n`."""
    return _placed(df.withColumns({"_row": F.monotonically_increasing_id(), "_group": F.lit(0)}), "_group").drop("_group")


def _placed(rows: DataFrame, group: str) -> DataFrame:
    written = staged(rows.withColumn("_part", F.shiftright("_row", _PLACE)))
    counts = written.groupBy("_part", F.col(group).alias("_of")).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_count"))
    whole = Window.partitionBy("_of")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "_of", "_first", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_base"), F.sum("_count").over(whole).alias("n"))
    placed = written.join(staged(counts).withColumnRenamed("_part", "_at"), (F.col("_part") == F.col("_at")) & F.col(group).eqNullSafe(F.col("_of")))
    return placed.withColumn("pos", F.col("_row") - F.col("_first") + F.col("_base")).drop("_row", "_part", "_at", "_of", "_first", "_base")
