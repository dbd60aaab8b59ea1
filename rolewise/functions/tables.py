"""Row-set helpers: bounded samples, lookups that stand hot keys, checkpoints."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import RDD, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .columns import q, row_hash, unit_interval

T = TypeVar("T")

SMALL_ROWS = 2_000_000         # tables up to this many rows may be dealt over the cores again
MIN_PIECE_ROWS = 1_000
BROADCAST_ROWS = 200_000       # lookup tables up to this many rows are broadcast
HOT_SHARE = 1_000              # a key is hot when it holds more than 1/HOT_SHARE of the rows


_test_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see: `spark.checkpoint.dir`; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _test_dirs:
        _test_dirs[context.applicationId] = tempfile.mkdtemp(prefix="rolewise-")
    return _test_dirs[context.applicationId]


def staged(df: DataFrame) -> DataFrame:
    """A frame that many jobs will read: written to the shared folder where the cluster names one
    (then a lost executor costs no recomputation), otherwise kept by the executors."""
    if df.sparkSession.conf.get("spark.checkpoint.dir", None):
        context = df.sparkSession.sparkContext
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared_dir(df.sparkSession))
        return df.checkpoint(eager=True)
    return df.persist()


def cut_lineage(rdd: RDD) -> None:
    """Mark kept rows, before the first job on them, to be read without what they were made from."""
    if rdd.ctx.getCheckpointDir():
        rdd.checkpoint()
    else:
        rdd.localCheckpoint()


def spread(df: DataFrame, n_rows: int) -> DataFrame:
    """Deal a small table over the cores, because it may come in one piece.

    A large table comes in many pieces already and is left as it is, so nothing large is shuffled.
    """
    if n_rows > SMALL_ROWS:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(cores, n_rows // MIN_PIECE_ROWS)))


def in_parallel(jobs: list[Callable[[], T]], at_once: int = 4) -> list[T]:
    """Run independent Spark jobs side by side; results in the order of the jobs."""
    if len(jobs) <= 1:
        return [job() for job in jobs]
    session = SparkSession.getActiveSession()             # job groups, tags and local properties go along
    jobs = [inheritable_thread_target(session)(job) if session else inheritable_thread_target(job) for job in jobs]
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda job: job(), jobs))


def hash_sample(df: DataFrame, n: int, keys: list[str] | None = None, seed: int = 42,
                n_rows: int | None = None) -> DataFrame:
    """Exactly min(n, rows) rows: those with the smallest key hash, whatever the partitioning.

    A threshold on the hash thins the table in the scan, so the top-n sort sees a few times n rows
    and not n rows of every partition.
    """
    total = df.count() if n_rows is None else n_rows
    if total <= n:
        return df
    hashed = df.withColumn("_h", row_hash(df, keys, seed))
    share = min(1.0, (2.0 * n + 100.0) / total)
    thinned = hashed.filter(unit_interval(F.col("_h")) < share)
    if thinned.limit(n).count() < n:           # only when keys repeat so much that hashes clump
        thinned = hashed
    return thinned.orderBy(unit_interval(F.col("_h")), "_h").limit(n).drop("_h")


def lookup(df: DataFrame, table: DataFrame, keys: list[str], weight: str,
           n_keys: int, n_rows: int) -> DataFrame:
    """Left join of `table` (unique on `keys`, all strings or integers) to every row of `df`.

    Up to BROADCAST_ROWS keys the table is broadcast.  Beyond that the hot keys, at most HOT_SHARE
    of them because each holds over 1/HOT_SHARE of the rows, are still broadcast; the other keys
    go through a shuffle join, in which the rows already served and rows without a key are spread
    by a salt and meet no partner.
    """
    if n_keys <= BROADCAST_ROWS:
        return df.join(F.broadcast(table.drop(weight)), keys, "left")
    values = [c for c in table.columns if c not in (*keys, weight)]
    is_hot = F.col(weight) > n_rows / HOT_SHARE
    hot = table.filter(is_hot).select(
        *keys, *[F.col(v).alias(f"_hot_{v}") for v in values], F.lit(True).alias("_served"))
    cold = table.filter(~is_hot).select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *values, F.lit(-1).alias("_salt"))
    salt = F.when(_any_null(keys) | F.col("_served"), F.pmod(row_hash(df), F.lit(4096))
                  .cast("int")).otherwise(F.lit(-1))
    with_hot = df.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt)
    condition = with_hot["_salt"] == cold["_salt"]
    for i, k in enumerate(keys):
        condition = condition & (with_hot[k] == cold[f"_key_{i}"])
    joined = with_hot.join(cold, condition, "left")
    return joined.select(*[q(c) for c in df.columns],
                         *[F.coalesce(f"_hot_{v}", v).alias(v) for v in values])


def _any_null(keys: list[str]) -> Column:
    flag = F.lit(False)
    for k in keys:
        flag = flag | q(k).isNull()
    return flag
