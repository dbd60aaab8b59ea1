"""Exact running counts over a whole ordered column without a single-task window.

Values are cut into ranges by approximate quantiles, the ranges get exact totals, and the running
sum is taken inside each range only and shifted by the total of the ranges below.  The cuts only
steer how evenly the work is spread; the result is exact for any cuts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .tables import staged

MAX_RANGES = 4_096
RANGE_ROWS = 200_000        # rows that one range of `running_sums` holds, give or take
STEP = 64                  # above this many cuts the lookup goes through every 64th cut first


def _range_count(df: DataFrame) -> int:
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(MAX_RANGES, wanted))


def running_counts(counts: DataFrame, group: list[str], value: str, sums: dict[str, str],
                   n_ranges: int | None = None) -> DataFrame:
    """For each row of `counts` (one per group and value) the sum of a column over smaller values.

    `sums` maps an input count column to the output column with the sum below the row's value.
    The number of groups must be small (features, not data keys); a group may be of any size.
    """
    n = n_ranges or _range_count(counts)
    # Cuts, totals and sums all read every count column, so that Spark shuffles `counts` once and
    # reuses it, and does not compute it anew for each of them with fewer columns.
    rows = sum((F.col(c) for c in counts.columns if c not in (*group, value)), F.lit(0))
    cuts = (counts.groupBy(*group).agg(
        F.percentile_approx(value, [i / n for i in range(1, n)], max(10_000, 10 * n)).alias("_cuts"),
        F.sum(rows).alias("_rows")).filter("_rows > 0").drop("_rows"))
    ranged = (counts.join(F.broadcast(cuts), group)
              .withColumn("_range", _lookup(F.col("_cuts"), F.col(value), n)).drop("_cuts"))
    totals = (ranged.groupBy(*group, "_range")
              .agg(*[F.sum(c).alias(f"_total_{c}") for c in sums], F.sum(rows).alias("_rows")).filter("_rows > 0"))
    below = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, "_range", *[
        F.coalesce(F.sum(f"_total_{c}").over(below), F.lit(0)).alias(f"_offset_{c}") for c in sums])
    inside = (Window.partitionBy(*group, "_range").orderBy(value)
              .rowsBetween(Window.unboundedPreceding, -1))
    kept = [c for c in counts.columns if c not in group]
    return (ranged.join(F.broadcast(offsets), [*group, "_range"])
            .select(*group, *kept, *[
                (F.col(f"_offset_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(out)
                for c, out in sums.items()]))


def _lookup(cuts, value, n):
    def at_most(array):
        return F.size(F.filter(array, lambda c: c <= value))

    if n <= 4 * STEP:
        return at_most(cuts)
    coarse = F.filter(cuts, lambda c, i: (i % STEP == STEP - 1) & (c <= value))
    block = F.size(coarse) * STEP
    return block + at_most(F.slice(cuts, block + 1, F.lit(STEP)))


def running_sums(rows: DataFrame, group: list[str], order: list[str], sums: dict[str, str], n_rows: int,
                 range_rows: int = RANGE_ROWS) -> DataFrame:
    """For each row the sum of a column over the rows of its group that come before it, and `total_<column>` over the group.

    Rows must differ in `group` and `order`; null groups are not allowed.  Rows are dealt to ranges of (group, order), as
    many as `n_rows` asks for, so any number of groups and a group of any size are served, and so are values of any type.
    The dealt rows are written once: ranges found anew for a second scan could differ.  Without a group the ranges' totals,
    a row for each range, are summed in one task.
    """
    pieces = max(1, -(-n_rows // range_rows))
    placed = staged(rows.repartitionByRange(pieces, *group, *order).withColumn("_range", F.spark_partition_id()))
    by_group = Window.partitionBy(*group)
    below = by_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*group, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    offsets = totals.select(*group, "_range", *[e for c in sums for e in (
        F.coalesce(F.sum(f"_sum_{c}").over(below), F.lit(0)).alias(f"_offset_{c}"), F.sum(f"_sum_{c}").over(by_group).alias(f"total_{c}"))])
    inside = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(offsets, [*group, "_range"]).select(*rows.columns, *[e for c, out in sums.items() for e in (
        (F.col(f"_offset_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(out), F.col(f"total_{c}"))])
