"""Gradient boosting by histograms, trees grown leaf by leaf.

Features become at most BINS bins, and rows of equal bins (and class) are folded into one, which changes no sum.  A pass over
the folded rows sums gradients, curvatures and counts by (node, feature, bin); each task adds up its own, and the driver gets
nodes x features x bins numbers a task or, where these would be many, of all tasks added up in Spark, and picks splits.  A tree grows best
first: of all leaves the one with the largest gain is split, up to `max_leaves`.  Which leaf that is can depend on children
not seen yet, so a pass looks at the children of every leaf that may still be split, and the order is replayed on what is
known; a tree takes about as many passes as it has levels, not one a split, and all classes share them.  Of two children
only the smaller is summed, the other is the difference to the parent.

Scores are kept by the executors and made anew by the first pass of a round; their lineage is cut every STAGED rounds.
Fits of several tables (folds) go round by round together and share the passes; fits of few folded rows are made whole, by the
same steps, by a task each.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import q
from ..functions.tables import cut_lineage, in_parallel, spread, staged

BINS = 255
SLOTS = 256                  # places for the bins of a feature
MAX_LEAVES = 31
MIN_LEAF = 20
MIN_CURVATURE = 1e-3
STAGED = 10                  # rounds between two cuts of the scores' lineage
BLOCK_ROWS = 100_000         # folded rows that travel as one value
PIECE_ROWS = 4_000           # folded rows that are worth a task
TASK_CELLS = 1_500_000       # folded rows x features that a task boosts by itself
DRIVER_CELLS = 2_000_000     # sums that a pass may send to the driver, counted over its tasks
VALID_SHARE = 0.1            # rows held out to stop early
PATIENCE, TOLERANCE = 10, 1e-7
EARLY_ROWS = 10_000          # early stopping by default above this
FEW_VALUES = 400


@dataclass
class Tree:
    """Nodes in arrays: feature (-1: leaf), bin and threshold (left if not above), left, right, value."""
    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def parts(self, columns: np.ndarray, cut: np.ndarray, rows: np.ndarray, wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, its rows) for rows of a table in columns, of values or of bins; only of wanted leaves, if they are given."""
        leads = np.ones(len(self.feature), bool) if wanted is None else wanted.copy()
        if wanted is not None:
            for i in range(len(leads) - 1, -1, -1):              # children come after their parent
                if self.feature[i] >= 0:
                    leads[i] = leads[self.left[i]] or leads[self.right[i]]
        stack = [(0, rows)]
        while stack:
            i, rows = stack.pop()
            if not len(rows) or not leads[i]:
                continue
            if self.feature[i] < 0:
                yield i, rows
                continue
            left = columns[self.feature[i]][rows] <= cut[i]
            stack += [(self.right[i], rows[~left]), (self.left[i], rows[left])]

    @property
    def n_leaves(self) -> int:
        return int((self.feature < 0).sum())


@dataclass
class Node:
    sums: np.ndarray                       # features x bins x (gradient, curvature, count)
    total: np.ndarray                      # gradient, curvature, count
    split: tuple | None = None             # gain, feature, bin
    children: tuple[int, int] | None = None
    depth: int = 0


@dataclass
class Boosted:
    base: np.ndarray
    rounds: list[list[Tree]] = field(default_factory=list)      # a tree for each output
    losses: list[float] = field(default_factory=list)           # on held-out rows, if early stopping is on
    passes: int = 0

    def raw(self, x: list[str]) -> Column:
        """Array of the outputs for the features x."""
        base, rounds = self.base, self.rounds

        @F.pandas_udf("array<double>")
        def outputs(values: pd.Series) -> pd.Series:
            table = np.ascontiguousarray(np.stack(values.to_numpy()).T) if len(values) else np.zeros((len(x), 0))
            out, every = np.repeat(base[:, None], len(values), axis=1), np.arange(len(values))
            for trees in rounds:
                for k, tree in enumerate(trees):
                    for leaf, rows in tree.parts(table, tree.threshold, every):
                        out[k, rows] += tree.value[leaf]
            return pd.Series(list(out.T))

        return outputs(F.array(*[q(c).cast("double") for c in x]))


def bin_edges(df: DataFrame, x: list[str]) -> list[np.ndarray]:
    """Upper limits of the bins but the last: between neighbouring values where there are few, else quantiles."""
    kinds = df.agg(*[F.approx_count_distinct(q(c)).alias(f"k{i}") for i, c in enumerate(x)]).first()
    few = [i for i in range(len(x)) if kinds[i] <= FEW_VALUES]
    known = df.agg(*[F.collect_set(q(x[i]).cast("double")).alias(f"v{i}") for i in few]).first() if few else []
    edges: dict[int, np.ndarray] = {}
    for i, values in zip(few, known):
        values = np.unique(np.array(values, float))
        if len(values) <= BINS:
            edges[i] = (values[1:] + values[:-1]) / 2
    many = [i for i in range(len(x)) if i not in edges]
    if many:
        shares = (np.arange(1, BINS) / BINS).tolist()
        found = df.select(*[q(x[i]).cast("double").alias(f"c{i}") for i in many]).approxQuantile([f"c{i}" for i in many], shares, 1 / (8 * BINS))
        edges |= {i: np.unique(f) for i, f in zip(many, found)}
    return [edges[i] for i in range(len(x))]


_FOLDED = "bins binary, y double, weight double, n long, valid boolean"
_BLOCK = "bins binary, y binary, weight binary, n binary, valid binary"
_KINDS = {"bins": np.uint8, "y": np.float64, "weight": np.float64, "n": np.float64, "valid": np.bool_}


def _binned(edges: list[np.ndarray]):
    """Rows of (x: array, y, weight, valid) with the bins of x as the bytes of one value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, p = batch.num_rows, len(edges)
            if n:
                table = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, p)
                bins = np.stack([np.searchsorted(e, table[:, j]) for j, e in enumerate(edges)], axis=1).astype(np.uint8)
                ends = pa.py_buffer(np.arange(0, (n + 1) * p, p, dtype=np.int32))
                packed = pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(np.ascontiguousarray(bins))])
                yield pa.RecordBatch.from_arrays([packed, *[batch.column(c) for c in ("y", "weight", "valid")]], ["bins", "y", "weight", "valid"])
    return run


def folded(binned: DataFrame, kind: str) -> DataFrame:
    """Rows of equal bins as one: they share every score, so gradients and curvatures need their weight and their mean only.
    Classes stay apart.  `off`: squares about the mean, a part of the loss that no tree changes."""
    if kind != "squared":
        return binned.groupBy("bins", "valid", "y").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")).withColumn("off", F.lit(0.0))
    total = F.sum(F.col("y") * F.col("weight"))
    sums = binned.groupBy("bins", "valid").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"), total.alias("s"),
                                               F.sum(F.col("y") * F.col("y") * F.col("weight")).alias("ss"))
    y = F.when(F.col("weight") > 0, F.col("s") / F.col("weight")).otherwise(F.lit(0.0))
    return sums.withColumn("y", y).withColumn("off", F.greatest(F.col("ss") - F.col("s") * F.col("y"), F.lit(0.0)) / 2)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of folded rows as blocks: a row whose values are the bytes of whole fields, so a pass hands over few large values."""
    held, size = [], 0

    def block() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        bins = b"".join(table.column("bins").to_pylist())
        plain = [np.ascontiguousarray(table.column(c).to_numpy().astype(kind)).tobytes() for c, kind in _KINDS.items() if c != "bins"]
        return pa.RecordBatch.from_arrays([pa.array([f], pa.binary()) for f in (bins, *plain)], list(_KINDS))
    for batch in batches:
        if batch.num_rows:
            held, size = [*held, batch], size + batch.num_rows
        if size >= BLOCK_ROWS:
            yield block()
            held, size = [], 0
    if held:
        yield block()


@dataclass
class Block:
    """Folded rows: those that trees learn from first, then the held-out ones."""
    bins: np.ndarray                       # features x rows
    y: np.ndarray
    weight: np.ndarray
    n: np.ndarray                          # rows folded into one
    learning: int
    score: np.ndarray                      # outputs x rows
    fit: int                               # which of the fits they belong to


def _opened(p: int, base: np.ndarray, fit: int):
    def run(row) -> Block:
        bins, y, weight, n, valid = (np.frombuffer(row[c], kind) for c, kind in _KINDS.items())
        order = np.argsort(valid, kind="stable")
        score = np.repeat(base[:, None], len(y), axis=1)
        return Block(np.ascontiguousarray(bins.reshape(-1, p)[order].T), y[order], weight[order], n[order], int((~valid).sum()), score, fit)
    return run


def _advance(trees: dict[int, list[Tree]]):
    """The blocks of the fits that go on, with the scores after one more round."""
    def run(blocks: Iterator[Block]) -> Iterator[Block]:
        for block in blocks:
            if block.fit not in trees:
                continue
            score, every = block.score.copy(), np.arange(block.score.shape[1])
            for k, tree in enumerate(trees[block.fit]):
                for leaf, rows in tree.parts(block.bins, tree.bin, every):
                    score[k, rows] += tree.value[leaf]
            yield replace(block, score=score)
    return run


def _derivatives(kind: str, score: np.ndarray, y: np.ndarray, w: np.ndarray):
    """Gradient and curvature of each output and row, and the loss of each row."""
    if kind == "squared":
        off = score - y
        return off * w, w[None, :], w * off[0] ** 2 / 2
    if kind == "binary":
        p = 1 / (1 + np.exp(-score))
        return (p - y) * w, p * (1 - p) * w, (np.logaddexp(0, score[0]) - y * score[0]) * w
    shifted = score - score.max(axis=0)
    logs = shifted - np.log(np.exp(shifted).sum(axis=0))
    p, at = np.exp(logs), (y.astype(np.int64), np.arange(len(y)))
    gradient = p.copy()
    gradient[at] -= 1
    return gradient * w, p * (1 - p) * w, -logs[at] * w


def _summing(kind: str, p: int, asked: dict[int, tuple[list[Tree], list[np.ndarray], int, int]], judged: bool):
    """Of one task: sums by (slot, feature, bin) of gradient, curvature and rows, and by fit loss and weight of held-out rows if judged.
    asked: fit -> its growing trees, for each output node -> slot or -1, its first slot and its number of slots."""
    def run(blocks: Iterator[Block]) -> Iterator[tuple]:
        sums, lost = {}, {}
        for b in blocks:
            if b.fit not in asked:
                continue
            growing, slots, first, n_slots = asked[b.fit]
            area = sums.setdefault(b.fit, np.zeros((n_slots, p, SLOTS, 3)))
            learning, held = slice(b.learning), slice(b.learning, None)
            gradient, curvature, _ = _derivatives(kind, b.score[:, learning], b.y[learning], b.weight[learning])
            if judged and b.learning < len(b.y):
                loss = _derivatives(kind, b.score[:, held], b.y[held], b.weight[held])[2]
                lost[b.fit] = lost.get(b.fit, 0.0) + np.array([loss.sum(), b.weight[held].sum()])
            for k, (tree, slot) in enumerate(zip(growing, slots)):
                for node, rows in tree.parts(b.bins, tree.bin, np.arange(b.learning), slot >= 0):
                    parts = gradient[k, rows], curvature[k, rows], b.n[rows]
                    for j in range(p):
                        at = b.bins[j, rows].astype(np.intp)
                        for c, values in enumerate(parts):
                            area[slot[node] - first, j, :, c] += np.bincount(at, values, SLOTS)
        cells, values = [np.zeros(0, np.int64)], [np.zeros((0, 3))]
        for fit, area in sums.items():
            some = np.flatnonzero(area[..., 2])
            cells.append(some + asked[fit][2] * p * SLOTS)
            values.append(area.reshape(-1, 3)[some])
        yield np.concatenate(cells), np.concatenate(values), lost
    return run


def _added(a: tuple, b: tuple) -> tuple:
    cells, where = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    sums = np.zeros((len(cells), 3))
    np.add.at(sums, where, np.concatenate([a[1], b[1]]))
    return cells, sums, {fit: a[2].get(fit, 0.0) + b[2].get(fit, 0.0) for fit in {**a[2], **b[2]}}


def _gathered(blocks: RDD, run, n_cells: int, sent: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Sums of all tasks: added up in Spark first where what they send would be much for the driver."""
    parts = blocks.mapPartitions(run)
    sums, lost = np.zeros((n_cells, 3)), {}
    for cells, values, some in parts.collect() if sent <= DRIVER_CELLS else [parts.treeReduce(_added)]:
        sums[cells] += values
        for fit, loss in some.items():
            lost[fit] = lost.get(fit, 0.0) + loss
    return sums, lost


def best_split(sums: np.ndarray, min_leaf: int) -> tuple | None:
    """(gain, feature, bin) of the best split of a node, None if no split gains; of equal gains the first."""
    left = sums.cumsum(axis=1)
    whole = left[:, -1:, :]
    right = whole - left
    fits = (left[..., 2] >= min_leaf) & (right[..., 2] >= min_leaf) & (left[..., 1] >= MIN_CURVATURE) & (right[..., 1] >= MIN_CURVATURE)
    part = lambda s: s[..., 0] ** 2 / np.maximum(s[..., 1], 1e-300)
    gain = np.where(fits, part(left) + part(right) - part(whole), -np.inf)
    at = int(gain.argmax())
    best = gain.flat[at]
    return (float(best), *divmod(at, gain.shape[1])) if best > 1e-12 * max(1.0, float(part(whole).max())) else None


class Grower:
    """One tree while it grows: the nodes known so far, and which of them the tree takes."""

    def __init__(self, max_leaves: int, min_leaf: int, max_depth: int | None):
        self.max_leaves, self.min_leaf, self.max_depth = max_leaves, min_leaf, max_depth
        self.nodes: list[Node] = []
        self.parts: list[tuple[int, int, int]] = []          # parent, child that is summed, its sibling
        self.asked = [0]

    def receive(self, sums: dict[int, np.ndarray]) -> None:
        """Sums of the asked nodes; siblings by subtraction."""
        if not self.nodes:
            self.nodes.append(Node(sums[0], sums[0][0].sum(axis=0)))
            self._judge(0)
            return
        for parent, child, sibling in self.parts:
            self.nodes[child].sums = sums[child]
            self.nodes[sibling].sums = self.nodes[parent].sums - sums[child]
            for i in (child, sibling):
                self._judge(i)
            self.nodes[parent].sums = sums[child][:0]                        # not needed any more
        self.parts, self.asked = [], []

    def _judge(self, i: int) -> None:
        if self.max_depth is None or self.nodes[i].depth < self.max_depth:
            self.nodes[i].split = best_split(self.nodes[i].sums, self.min_leaf)

    def replay(self) -> tuple[dict[int, tuple[int, int]], list[int]]:
        """Splits in best-first order as far as it is known, and the leaves that may be split next (none: the tree is done)."""
        taken: dict[int, tuple[int, int]] = {}
        heap = [(-self.nodes[0].split[0], 0)] if self.nodes[0].split else []
        while heap and len(taken) + 1 < self.max_leaves:
            if self.nodes[heap[0][1]].children is None:
                left = self.max_leaves - 1 - len(taken)
                if left == 1:                                    # what lies below the last split is of no interest
                    taken[heap[0][1]] = self._children(heap[0][1])
                    return taken, []
                top = heap[0][1]                                 # the one that blocks, and others that may come into reach
                known = [(-n.split[0], i) for i, n in enumerate(self.nodes) if n.split and n.children is None and i != top]
                return taken, [top, *[i for _, i in heapq.nsmallest(left - 1, known)]]
            _, i = heapq.heappop(heap)
            taken[i] = self.nodes[i].children
            for child in taken[i]:
                if self.nodes[child].split:
                    heapq.heappush(heap, (-self.nodes[child].split[0], child))
        return taken, []

    def expand(self, leaves: list[int]) -> None:
        self.asked = []
        for i in leaves:
            a, b = self._children(i)
            child, sibling = (a, b) if self.nodes[a].total[2] <= self.nodes[b].total[2] else (b, a)
            self.parts.append((i, child, sibling))
            self.asked.append(child)

    def _children(self, i: int) -> tuple[int, int]:
        node, a = self.nodes[i], len(self.nodes)
        _, f, b = node.split
        left = node.sums[f, :b + 1].sum(axis=0)
        self.nodes += [Node(node.sums[:0], total, depth=node.depth + 1) for total in (left, node.total - left)]
        node.children = (a, a + 1)
        return node.children

    def tree(self, taken: dict | None, edges: list[np.ndarray], rate: float) -> Tree:
        """All known nodes, or only those the tree takes, with the leaves' values."""
        n = max(1, len(self.nodes))
        out = Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n))
        for i, node in enumerate(self.nodes):
            children = node.children if taken is None else taken.get(i)
            if children:
                _, f, b = node.split
                out.feature[i], out.bin[i], out.left[i], out.right[i] = f, b, *children
                out.threshold[i] = edges[f][b] if b < len(edges[f]) else np.inf
            g, h, _ = node.total
            out.value[i] = -rate * g / h if h > 0 else 0.0
        return out


def _base(kind: str, rows: DataFrame, n_out: int) -> np.ndarray:
    if kind == "squared":
        return np.array([rows.agg(F.sum(F.col("y") * F.col("weight")) / F.sum("weight")).first()[0] or 0.0])
    shares = {int(r["y"]): r["w"] for r in rows.groupBy("y").agg(F.sum("weight").alias("w")).collect()}      # a row for each class
    total = sum(shares.values())
    share = np.clip([shares.get(k, 0.0) / total for k in range(max(2, n_out))], 1e-12, 1.0)
    return np.array([np.log(share[1] / share[0])]) if kind == "binary" else np.log(share) - np.log(share).mean()


def boost(train: DataFrame, x: list[str], task: str, n_classes: int, n_rows: int, rate: float = 0.1, n_rounds: int = 100,
          max_leaves: int = MAX_LEAVES, max_depth: int | None = None, min_leaf: int = MIN_LEAF, early: bool | None = None) -> Boosted:
    """Model of the rows of train (x, y, weight, row_key).  y: a number, or a class from 0.

    early: stop when the loss of a tenth of the rows, which no tree learns from, has not fallen for 10 rounds; by default
    above 10,000 rows."""
    return boost_all([train], x, task, n_classes, n_rows, rate, n_rounds, max_leaves, max_depth, min_leaf, early)[0]


@dataclass
class _Fit:
    """One of the fits that go round by round together: its model, and the trees of the current round."""
    edges: list[np.ndarray]
    model: Boosted
    off: float                             # part of the held-out loss that no tree changes
    pieces: int                            # tasks that hold them
    growers: list[Grower] = field(default_factory=list)
    taken: list[dict] = field(default_factory=list)
    loss: float | None = None

    def rests(self) -> bool:
        """Whether the held-out loss has stopped falling."""
        losses = self.model.losses
        return len(losses) > PATIENCE and min(losses[-PATIENCE:]) >= losses[-PATIENCE - 1] - TOLERANCE


def _begun(number: int, train: DataFrame, x: list[str], kind: str, n_out: int, n_rows: int, early: bool) -> tuple[_Fit, RDD, list[DataFrame]]:
    """A fit before its first round, its blocks of folded rows, and the frames that these come from."""
    valid = F.pmod(F.xxhash64(F.lit(97), "row_key"), F.lit(1_000_003)) < int(VALID_SHARE * 1_000_003) if early else F.lit(False)
    rows = staged(spread(train.select(F.array(*[q(c).cast("double") for c in x]).alias("x"), F.col("y").cast("double"),
                                      F.col("weight").cast("double"), valid.alias("valid")), n_rows))
    edges = bin_edges(rows.select(*[F.col("x")[i].alias(c) for i, c in enumerate(x)]), x)
    base = _base(kind, rows.filter(~F.col("valid")), n_out)
    cells = staged(folded(rows.mapInArrow(_binned(edges), "bins binary, y double, weight double, valid boolean"), kind))
    head = cells.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("valid"), F.col("off"))).alias("off")).first()
    cores = train.sparkSession.sparkContext.defaultParallelism
    pieces = max(1, min(cores, head["n"] // PIECE_ROWS), head["n"] // (8 * BLOCK_ROWS)) if head["n"] * len(x) > TASK_CELLS else 1
    packed = cells.select(*[c.split()[0] for c in _FOLDED.split(", ")]).repartition(pieces).mapInArrow(_packed, _BLOCK)
    return _Fit(edges, Boosted(base), head["off"] or 0.0, pieces), packed.rdd.map(_opened(len(x), base, number)), [cells, rows]


def boost_all(trains: list[DataFrame], x: list[str], task: str, n_classes: int, n_rows: int, rate: float = 0.1, n_rounds: int = 100,
              max_leaves: int = MAX_LEAVES, max_depth: int | None = None, min_leaf: int = MIN_LEAF, early: bool | None = None) -> list[Boosted]:
    """The models of `boost` for several tables of about n_rows rows, such as the training rows of folds.  They grow side by side: a pass
    serves all of them, so the number of passes is that of the slowest.  Fits of few folded rows are made by a task each."""
    kind = "squared" if task == "regression" else "binary" if n_classes == 2 else "softmax"
    n_out = n_classes if kind == "softmax" else 1
    early = n_rows > EARLY_ROWS if early is None else early
    begun = in_parallel([partial(_begun, i, train, x, kind, n_out, n_rows, early) for i, train in enumerate(trains)], 2)
    fits = {i: fit for i, (fit, *_) in enumerate(begun)}
    grow = partial(_rounds, kind=kind, n_out=n_out, p=len(x), rate=rate, n_rounds=n_rounds, early=early,
                   new=partial(Grower, max_leaves, min_leaf, max_depth))
    context = trains[0].sparkSession.sparkContext
    small = {i: fit for i, fit in fits.items() if fit.pieces == 1}

    def in_task(blocks: Iterator[Block]) -> Iterator[tuple[int, Boosted]]:
        held = list(blocks)
        for i in {b.fit for b in held}:
            fit = small[i]
            grow({i: fit}, _Held([b for b in held if b.fit == i]))
            yield i, fit.model

    if small:
        made = dict(context.union([begun[i][1] for i in small]).mapPartitions(in_task).collect())       # the models
        for i, fit in small.items():
            fit.model = made.get(i, fit.model)
    large = {i: fit for i, fit in fits.items() if i not in small}
    if large:
        grow(large, _Kept(context.union([begun[i][1] for i in large])))
    for frame in (f for *_, frames in begun for f in frames):
        frame.unpersist()
    return [fit.model for fit in fits.values()]


class _Held:
    """Blocks of a task."""

    def __init__(self, blocks: list[Block]):
        self.blocks = blocks

    def sums(self, run, n_cells: int, sent: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        sums, ((cells, values, lost),) = np.zeros((n_cells, 3)), run(iter(self.blocks))
        sums[cells] = values
        return sums, lost

    def advance(self, grown: dict[int, list[Tree]]) -> None:
        self.blocks = list(_advance(grown)(iter(self.blocks)))

    def release(self) -> None:
        self.blocks = []


class _Kept:
    """Blocks that the executors keep, with the scores of the last round."""

    def __init__(self, blocks: RDD):
        self.blocks, self.former, self.rounds = blocks.persist(StorageLevel.MEMORY_AND_DISK), None, 0

    def sums(self, run, n_cells: int, sent: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        found = _gathered(self.blocks, run, n_cells, sent)
        if self.former is not None:                              # the new scores are kept by now
            self.former.unpersist()
            self.former = None
        return found

    def advance(self, grown: dict[int, list[Tree]]) -> None:
        self.former, self.blocks, self.rounds = self.blocks, self.blocks.mapPartitions(_advance(grown)).persist(StorageLevel.MEMORY_AND_DISK), self.rounds + 1
        if self.rounds % STAGED == 0:
            cut_lineage(self.blocks)

    def release(self) -> None:
        for blocks in (self.blocks, self.former):
            if blocks is not None:
                blocks.unpersist()


def _rounds(live: dict[int, _Fit], rows: _Held | _Kept, *, kind: str, n_out: int, p: int, rate: float, n_rounds: int, early: bool,
            new: Callable[[], Grower]) -> None:
    """Grow the models of all fits, round by round, from sums over their rows."""
    for done in range(1, n_rounds + 1):
        for fit in live.values():
            fit.growers, fit.taken, fit.loss = [new() for _ in range(n_out)], [{} for _ in range(n_out)], None
        first = True
        while growing := {i: fit for i, fit in live.items() if any(g.asked for g in fit.growers)}:
            asked, number, sent = {}, {}, 0
            for i, fit in growing.items():
                slots, begin = [], len(number)
                for k, g in enumerate(fit.growers):
                    of = np.full(max(1, len(g.nodes)), -1)
                    for node in g.asked:
                        of[node] = number[i, k, node] = len(number)
                    slots.append(of)
                asked[i] = [g.tree(None, fit.edges, rate) for g in fit.growers], slots, begin, len(number) - begin
                sent += fit.pieces * (len(number) - begin) * p * SLOTS
                fit.model.passes += 1
            sums, lost = rows.sums(_summing(kind, p, asked, early and first), len(number) * p * SLOTS, sent)
            sums = sums.reshape(len(number), p, SLOTS, 3)
            for i, fit in growing.items():
                if first and early:
                    loss, weight = lost.get(i, (0.0, 0.0))
                    fit.loss = (loss + fit.off) / max(weight, 1e-300)
                for k, g in enumerate(fit.growers):
                    if g.asked:
                        g.receive({node: sums[number[i, k, node]] for node in g.asked})
                        fit.taken[k], more = g.replay()
                        g.asked = []
                        g.expand(more)
            first = False
        grown = {}
        for i, fit in live.items():
            if early:
                fit.model.losses.append(fit.loss)
                if fit.rests():
                    continue
            fit.model.rounds.append([_pruned(g.tree(t, fit.edges, rate)) for g, t in zip(fit.growers, fit.taken)])
            if any(t.n_leaves > 1 for t in fit.model.rounds[-1]):
                grown[i] = fit.model.rounds[-1]
        live = {i: live[i] for i in grown}
        if not live or done == n_rounds:
            break
        rows.advance(grown)
    rows.release()


def _pruned(tree: Tree) -> Tree:
    """The nodes that a row can reach, numbered anew."""
    reached = [0]
    for i in reached:
        if tree.feature[i] >= 0:
            reached += [int(tree.left[i]), int(tree.right[i])]
    new = np.zeros(len(tree.feature), np.int64)
    new[reached] = np.arange(len(reached))
    return Tree(*[getattr(tree, c)[reached] for c in ("feature", "bin", "threshold")], new[tree.left[reached]], new[tree.right[reached]], tree.value[reached])
