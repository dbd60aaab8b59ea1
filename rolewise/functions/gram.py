"""Cross-product matrices of the feature columns, of few columns by group, or of many by blocks of columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK = 128                  # columns of a block
LOT = 64                     # pairs of blocks of a pass, 0.8 MB each in a task


def gram_by_group(df: DataFrame, columns: list[str], group: str | None = None,
                  weight: str | None = None) -> dict[int, np.ndarray]:
    """Sum of z zᵀ per group with z = (1, columns...); NULLs must be filled before.

    Every task adds up its own matrix and emits the upper triangle once; Spark sums the entries.
    The result has (columns + 1)² numbers per group, whatever the row count.
    """
    width = len(columns) + 1
    upper = np.triu_indices(width)

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            z = np.column_stack([np.ones(len(batch)), batch[columns].to_numpy(dtype=float)])
            groups = batch["_group"].to_numpy()
            w = batch["_weight"].to_numpy(dtype=float)
            for g in np.unique(groups):
                rows = groups == g
                part = (z[rows] * w[rows, None]).T @ z[rows]
                sums[int(g)] = sums.get(int(g), 0.0) + part
        for g, matrix in sums.items():
            yield pd.DataFrame({"g": g, "i": upper[0], "j": upper[1], "v": matrix[upper]})

    flat = df.select(*[F.col(c) for c in columns],
                     (F.col(group) if group else F.lit(0)).cast("long").alias("_group"),
                     (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_weight"))
    summed = (flat.mapInPandas(partial_sums, "g long, i int, j int, v double")
              .groupBy("g", "i", "j").agg(F.sum("v").alias("v")))
    out: dict[int, np.ndarray] = {}
    for r in summed.collect():
        m = out.setdefault(r["g"], np.zeros((width, width)))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"]
    return out


def column_means(packed: DataFrame, width: int) -> np.ndarray:
    """Mean of the present values of each place of the array `x`; 0 where there is none."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(width), np.zeros(width)
        for batch in batches:
            x = _values(batch, width)
            n, s = n + (~np.isnan(x)).sum(0), s + np.nansum(x, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(n), pa.array(s)], ["i", "n", "s"])

    out = np.zeros(width)
    for r in packed.mapInArrow(sums, "i long, n double, s double").groupBy("i").agg((F.sum("s") / F.greatest(F.sum("n"), F.lit(1.0))).alias("m")).collect():
        out[r["i"]] = r["m"]
    return out


def _values(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def pairwise(packed: DataFrame, width: int, finish: Callable, schema: str, block: int = BLOCK, lot: int = LOT) -> DataFrame:
    """Counts, sums, squares and products of each pair of places of the array `x` over the rows where both are present.

    Places go in blocks.  A pass adds up `lot` pairs of blocks; each task emits a table a pair, the tables of a pair meet in
    one task, which adds them as they come and hands them to finish(first place, other first place, sums): an Arrow batch of
    `schema`.  No task holds more than `lot` tables, the driver holds the means.
    """
    centres = column_means(packed, width)
    starts = range(0, width, block)
    pairs = [(a, b) for a in starts for b in starts if a <= b]
    parts = [_products(packed, width, centres, pairs[k:k + lot], finish, schema, block) for k in range(0, len(pairs), lot)]
    return reduce(DataFrame.unionByName, parts)


def _products(packed, width, centres, pairs, finish, schema, block) -> DataFrame:
    wanted = sorted({a for pair in pairs for a in pair})

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {pair: 0.0 for pair in pairs}
        for batch in batches:
            x = _values(batch, width)
            parts = {}
            for a in wanted:
                v = x[:, a:a + block] - centres[a:a + block]
                seen = ~np.isnan(v)
                v = np.where(seen, v, 0.0)
                parts[a] = seen.astype(float), v, v * v
            for a, b in pairs:
                (s, v, vv), (t, w, ww) = parts[a], parts[b]
                sums[a, b] = sums[a, b] + np.stack([s.T @ t, v.T @ t, s.T @ w, vv.T @ t, s.T @ ww, v.T @ w])
        some = [(a, b, m.tobytes()) for (a, b), m in sums.items() if not isinstance(m, float)]
        for a, b, m in some:
            yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([m], pa.binary())], ["a", "b", "m"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column("a")[i].as_py(), batch.column("b")[i].as_py())
                shape = (6, min(block, width - key[0]), min(block, width - key[1]))
                table = np.frombuffer(batch.column("m")[i].as_buffer()).reshape(shape)
                if key != at and at is not None:
                    yield finish(*at, total)
                total = table.copy() if key != at else total + table
                at = key
        if at is not None:
            yield finish(*at, total)

    tables = packed.mapInArrow(partial_sums, "a int, b int, m binary").repartition(len(pairs), "a", "b").sortWithinPartitions("a", "b")
    return tables.mapInArrow(meet, schema)
