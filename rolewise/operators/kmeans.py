"""KMeans for many cluster counts and restarts at once.

Each Lloyd iteration is one scan that serves every run: a task assigns its blocks of rows to the
centres of all runs and emits only sums per (run, cluster).  A sweep over k with ten restarts thus
costs as many scans as its slowest run, and not one fit per pair.  Starting centres are drawn from
all rows, and every restart is brought to rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import q
from ..functions.tables import spread

MAX_ITERATIONS = 300      # scans of a run that does not come to rest before
LOT_CELLS = 1 << 15       # distances that a task holds at a time
DRIVER_CELLS = 2_000_000  # sums that a scan may send to the driver, counted over its tasks
TOLERANCE = 1e-4          # centre movement, in units of the mean column variance


@dataclass
class KMeansFit:
    k: int
    centres: list[list[float]]
    cost: float              # of these centres over all rows
    converged: bool = True   # the last scan did not move the centres, within the tolerance
    silhouette: float | None = None      # of all rows under squared distances, if asked for


def _squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * x @ centres.T
    return np.maximum(d, 0.0)


def _kept(df: DataFrame, columns: list[str]) -> RDD:
    """Rows as blocks (columns x rows) that stay with the executors, so that a scan is one plain job."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([c.to_numpy(zero_copy_only=False).astype(float, copy=False) for c in batch.columns])
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["x"])

    width = len(columns)
    return (df.select(*columns).mapInArrow(packed, "x binary").rdd.map(lambda row: np.frombuffer(row["x"]).reshape(width, -1))
            .persist(StorageLevel.MEMORY_AND_DISK))


def _added(blocks: RDD, run: Callable[[Iterator[np.ndarray]], Iterator[np.ndarray]], cells: int) -> np.ndarray:
    """Sum of what all tasks yield: added up in Spark first where that would be much for the driver."""
    parts = blocks.mapPartitions(run)
    return sum(parts.collect()) if blocks.getNumPartitions() * cells <= DRIVER_CELLS else parts.treeReduce(np.add)


def _starts(blocks: RDD, width: int, k: int, restarts: int, seed: int) -> list[np.ndarray]:
    """Starting centres of each restart, drawn one by one from all rows, far ones being likelier (greedy k-means++).

    A scan draws some rows for the next centre of all restarts: a block of total weight w races with an exponential time of
    rate w and names one of its rows by weight; the first block of all wins, so each row is drawn in proportion to its weight.
    A second scan tells which of them leaves the lowest cost.  The first j centres of a restart start a fit of j.
    """
    tries = 2 + int(np.log(k))
    chosen = [np.zeros((0, width)) for _ in range(restarts)]

    def race(step: int):
        def run(part: int, rows: Iterator[np.ndarray]) -> Iterator[dict]:
            rng = np.random.default_rng([seed, step, part])
            first: dict[tuple[int, int], tuple] = {}
            for x in rows:
                for r, centres in enumerate(chosen):
                    upto = (_squared_distances(x.T, centres).min(1) if step else np.ones(x.shape[1])).cumsum()
                    times, spots = rng.exponential(size=tries), rng.uniform(size=tries)
                    for t in range(tries if upto[-1] > 0 else 0):
                        if (r, t) not in first or times[t] / upto[-1] < first[r, t][0]:
                            at = min(int(np.searchsorted(upto, spots[t] * upto[-1], side="right")), len(upto) - 1)
                            first[r, t] = times[t] / upto[-1], tuple(x[:, at].tolist())
            yield first
        return run

    def costs(drawn: dict):
        def run(rows: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
            sums = np.zeros((restarts, tries))
            for x in rows:
                for r, centres in enumerate(chosen):
                    near = _squared_distances(x.T, centres).min(1)
                    for t in range(tries):
                        if (r, t) in drawn:
                            sums[r, t] += np.minimum(near, _squared_distances(x.T, np.array([drawn[r, t][1]]))[:, 0]).sum()
            yield sums
        return run

    for step in range(k):
        drawn = blocks.mapPartitionsWithIndex(race(step)).treeReduce(
            lambda a, b: {i: min(d[i] for d in (a, b) if i in d) for i in (*a, *b)})                # a row a try and restart
        left = _added(blocks, costs(drawn), restarts * tries) if step else np.zeros((restarts, tries))
        best = left.argmin(axis=1) if step else np.zeros(restarts, int)
        chosen = [np.vstack([c, drawn[r, best[r]][1] if (r, best[r]) in drawn else c[:1].ravel()])  # no row apart from the centres: the first again
                  for r, c in enumerate(chosen)]
    return chosen


def _sums_of(x: np.ndarray, runs: list[np.ndarray], sums: np.ndarray) -> None:
    """Add (sums..., count, cost) of the rows of x (columns x rows) to the nearest centres of every run, the first one on a tie.

    Runs of one k, which are neighbours, share their work; rows come in lots whose distances stay in a core's cache.  The
    cost of a cluster follows from the sums and squares of its rows.
    """
    rows, at = np.vstack([x, np.ones((1, x.shape[1])), (x * x).sum(0)]), 0
    for k, some in groupby(runs, len):
        stacked = np.vstack(list(some))
        squares, size = (stacked * stacked).sum(1), len(stacked)
        sides, made = np.column_stack([-2.0 * stacked, squares]), np.zeros((size, len(rows)))
        step = min(x.shape[1], max(64, LOT_CELLS // size))
        off, mark = np.empty((size, step)), np.empty((size, step))
        for start in range(0, x.shape[1], step):
            lot = rows[:, start:start + step]
            n = lot.shape[1]
            if n < step:
                off, mark = np.empty((size, n)), np.empty((size, n))
            np.matmul(sides, lot[:-1], out=off)                  # squared distances, without the rows' own squares
            block = off.reshape(-1, k, n)
            near = block == block.min(axis=1, keepdims=True)
            if np.count_nonzero(near) > n * len(block):
                near = block.argmin(axis=1)[:, None] == np.arange(k)[:, None]
            mark[:] = near.reshape(size, n)
            made += mark @ lot.T
        cost = made[:, -1] - 2.0 * (made[:, :-2] * stacked).sum(1) + made[:, -2] * squares
        sums[at:at + size, :-1] += made[:, :-1]
        sums[at:at + size, -1] += np.maximum(cost, 0.0)
        at += size


def _one_pass(blocks: RDD, runs: list[np.ndarray]) -> list[np.ndarray]:
    """Per run a matrix cluster x (sums..., count, cost), added up over all rows."""
    shape = (sum(map(len, runs)), runs[0].shape[1] + 2)

    def partial_sums(rows: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
        sums = np.zeros(shape)
        for x in rows:
            _sums_of(x, runs, sums)
        yield sums

    return np.split(_added(blocks, partial_sums, shape[0] * shape[1]), np.cumsum([len(r) for r in runs])[:-1])


def _lloyd(blocks: RDD, runs: list[np.ndarray], tolerance: float) -> set[int]:
    """Move all runs in place until they rest, one scan per iteration for those that still move; the runs that moved to the end."""
    moving = set(range(len(runs)))
    for _ in range(MAX_ITERATIONS):
        order = sorted(moving)
        for r, sums in zip(order, _one_pass(blocks, [runs[r] for r in order])):
            count = sums[:, -2:-1]
            new = np.where(count > 0, sums[:, :-2] / np.maximum(count, 1), runs[r])
            if float(((new - runs[r]) ** 2).sum()) <= tolerance:
                moving.discard(r)
            runs[r] = new
        if not moving:
            break
    return moving


def _silhouettes(blocks: RDD, runs: list[np.ndarray], sums: list[np.ndarray]) -> list[float | None]:
    """Mean silhouette of each run's clusters under squared distances, from all rows in one scan (see `squared_silhouettes`)."""
    known = []
    for centres, s in zip(runs, sums):
        some = np.flatnonzero(s[:, -2])
        size, mean = s[some, -2], s[some, :-2] / s[some, -2:-1]
        known.append((centres[some], size, mean, np.maximum(s[some, -1] / size - ((mean - centres[some]) ** 2).sum(1), 0.0)))

    def score(rows: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
        total = np.zeros(len(known))
        for x in rows:
            at = np.arange(x.shape[1])
            for i, (centres, size, mean, spread) in enumerate(known):
                if len(size) < 2:
                    continue
                own = (centres @ x * -2.0 + (centres * centres).sum(1)[:, None]).argmin(axis=0)
                apart = _squared_distances(x.T, mean).T + spread[:, None]
                a = apart[own, at] * (size / np.maximum(size - 1, 1))[own]
                apart[own, at] = np.inf
                b = apart.min(axis=0)
                with np.errstate(invalid="ignore", divide="ignore"):
                    total[i] += np.nan_to_num(np.where(size[own] > 1, (b - a) / np.maximum(a, b), 0.0)).sum()
        yield total

    totals = _added(blocks, score, len(known))
    return [float(t / s[:, -2].sum()) if len(size) > 1 else None for t, s, (_, size, *_) in zip(totals, sums, known)]


def fit_sweep(df: DataFrame, columns: list[str], ks: list[int], restarts: int = 10, seed: int = 42,
              n_rows: int | None = None, scored: bool = False) -> dict[int, KMeansFit]:
    """Best fit per k by within-cluster sum of squares; `df` must hold no NULLs in `columns`.

    Every restart starts from rows of the whole table and is brought to rest before its cost is compared.  scored: with
    the silhouettes of the best fits.
    """
    n = df.count() if n_rows is None else n_rows
    ks = [k for k in ks if k < n]
    if not ks:
        return {}
    blocks = _kept(spread(df.select(*columns), n), columns)
    try:
        whole = _one_pass(blocks, [np.zeros((1, len(columns)))])[0]
        mean = whole[:, :-2] / whole[:, -2:-1]
        tolerance = TOLERANCE * float(_one_pass(blocks, [mean])[0][0, -1]) / whole[0, -2] / len(columns)
        starts = _starts(blocks, len(columns), max(ks), restarts, seed)
        runs = [start[:k] for k in ks for start in starts]
        moving = _lloyd(blocks, runs, tolerance)
        last = _one_pass(blocks, runs)
        costs = [float(sums[:, -1].sum()) for sums in last]
        best = {k: min((r for r, run in enumerate(runs) if len(run) == k), key=costs.__getitem__) for k in ks}
        scores = _silhouettes(blocks, [runs[r] for r in best.values()], [last[r] for r in best.values()]) if scored else [None] * len(ks)
    finally:
        blocks.unpersist()
    return {k: KMeansFit(k, runs[r].tolist(), costs[r], r not in moving, score) for (k, r), score in zip(best.items(), scores)}


def fit_best(df: DataFrame, columns: list[str], k: int, restarts: int = 10, seed: int = 42,
             n_rows: int | None = None) -> KMeansFit:
    return fit_sweep(df, columns, [k], restarts, seed, n_rows)[k]


def _distance_terms(columns: list[str], centres: list[list[float]]) -> list[Column]:
    out = []
    for centre in centres:
        total = F.lit(0.0)
        for name, value in zip(columns, centre):
            gap = q(name) - F.lit(float(value))
            total = total + gap * gap
        out.append(total)
    return out


def assign(columns: list[str], centres: list[list[float]]) -> Column:
    """Number of the nearest centre, the lower one on a tie; NULL if a coordinate is missing."""
    pairs = [F.struct(d.alias("d"), F.lit(i).alias("i"))
             for i, d in enumerate(_distance_terms(columns, centres))]
    complete = F.lit(True)
    for name in columns:
        complete = complete & q(name).isNotNull()
    return F.when(complete, F.array_min(F.array(*pairs))["i"])


def distance(columns: list[str], centres: list[list[float]]) -> Column:
    """Euclidean distance to the nearest centre."""
    return F.sqrt(F.array_min(F.array(*_distance_terms(columns, centres))))
