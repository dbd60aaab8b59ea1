"""Random forests of any depth.

A tree learns from rows drawn with counts that follow a Poisson law of mean 1, fixed by the row key and the tree.  Nodes
of more than `fit_rows` rows are split by histograms: a pass over the rows counts weights and targets of the open nodes of
all trees by (node, feature, bin), Spark sums them and picks a node's split in a task, so the driver gets one row a node.
Bins begin as quantiles of the whole column.  A node that its bins cannot split is cut anew within the box that its rows
take, in equal steps of the ordered bits of a double, so eight cuts reach single values whatever the distribution.

Smaller nodes are finished whole: their drawn rows meet in one task, which grows the rest of the tree on exact values, all
nodes of a level at once, until nodes are pure or equal in all features.  No group holds over `fit_rows` rows.

The tops of the trees stay on the driver.  The finished parts are a table (tree, node, bytes); rows meet them by a shuffle
on (tree, node), or the parts go to the tasks where their counted bytes are few.  Which features a node may use follows
from its place in the tree, so the forest does not depend on the partitioning.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import q
from ..functions.tables import spread, staged
from .boosting import bin_edges

FIT_ROWS = 50_000            # rows of a node that one task finishes
LOT_CELLS = 4_000_000        # numbers that a task of a histogram pass holds
TASK_BYTES = 32 << 20        # finished parts up to this size go to every task
SLOTS = 256                  # bins of a feature
SOME = 0.75                  # share of the nodes below which a feature's gains are asked for their rows only
FEW_CLASSES = 8              # running weights class by class up to this number, else by sorting
POISSON = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 16)])])

_BLOCK = "x binary, y binary, weight binary, key binary"
_KINDS = {"x": np.float64, "y": np.float64, "weight": np.float64, "key": np.uint64}


def _mix(z: np.ndarray) -> np.ndarray:
    """Scrambled 64 bits."""
    with np.errstate(over="ignore"):
        z = np.asarray(z, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def draws(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree takes each row."""
    unit = (_mix(keys ^ _mix(np.uint64(seed * 1_000_003 + tree))) >> np.uint64(11)) / 2.0 ** 53
    return np.searchsorted(POISSON, unit, side="right")


def _child(place: np.ndarray, side: int) -> np.ndarray:
    return _mix(place ^ np.uint64(side + 1))


def _ranks(place: np.ndarray, p: int) -> np.ndarray:
    """Order (features x nodes) in which the features fall to each node."""
    with np.errstate(over="ignore"):
        luck = _mix(place[None, :] ^ _mix(np.arange(p, dtype=np.uint64) + np.uint64(17))[:, None])
    return luck.argsort(axis=0, kind="stable").argsort(axis=0, kind="stable")


def _allowed(place: np.ndarray, gains: np.ndarray, m: int) -> np.ndarray:
    """Gains (features x nodes) of the m features that fall to each node; if none of them can split, of the next that can."""
    p = len(gains)
    if m >= p:
        return gains
    rank = _ranks(place, p)
    first = np.where(np.isfinite(gains), rank, p).min(axis=0)
    return np.where(rank < np.maximum(m, first + 1), gains, -np.inf)


@dataclass
class Part:
    """A tree or the rest of one: nodes in arrays (feature -1: leaf), leaf values as (output, share) lists."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    offset: np.ndarray                     # of a node's values
    output: np.ndarray
    share: np.ndarray

    def packed(self) -> bytes:
        small = (self.feature.astype(np.int32), self.threshold, *[a.astype(np.int32) for a in (self.left, self.right, self.offset, self.output)], self.share)
        return pickle.dumps(small, 5)

    @staticmethod
    def unpacked(data: bytes) -> Part:
        return Part(*pickle.loads(data))

    def add(self, x: np.ndarray, out: np.ndarray, rows: np.ndarray) -> None:
        """Add the values of rows x to out[rows]; no row comes twice."""
        leaf = route(self.feature, self.threshold, self.left, self.right, x)
        n = self.offset[leaf + 1] - self.offset[leaf]
        at = np.repeat(self.offset[leaf] - np.concatenate([[0], n.cumsum()[:-1]]), n) + np.arange(n.sum())
        out[np.repeat(rows, n), self.output[at]] += self.share[at]


def route(feature, threshold, left, right, x: np.ndarray) -> np.ndarray:
    node = np.zeros(len(x), np.int64)
    live = np.flatnonzero(feature[node] >= 0)
    while len(live):
        at = node[live]
        node[live] = np.where(x[live, feature[at]] <= threshold[at], left[at], right[at])
        live = live[feature[node[live]] >= 0]
    return node


def _two_valued(columns: np.ndarray) -> dict[int, tuple[float, float, np.ndarray]]:
    """Features with two values: both values, and 1.0 where a row has the greater one."""
    out = {}
    for j, c in enumerate(columns):
        low, high = c.min(initial=np.inf), c.max(initial=-np.inf)
        upper = c == high
        if low < high and (upper | (c == low)).all():
            out[j] = low, high, upper.astype(np.float64)
    return out


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: bool, m: int, min_leaf: int, depth: int | None, place: int) -> Part:
    """The tree of rows x with targets y and weights w, level by level; depth: levels left, None for any."""
    n, p = x.shape
    columns = np.ascontiguousarray(x.T)
    twos = _two_valued(columns) if not classes or int(y.max(initial=0)) < FEW_CLASSES else {}
    many = [j for j in range(p) if j not in twos]
    orders = [np.argsort(columns[j], kind="stable") for j in many] or [np.arange(n)]     # by node, then by value
    starts, sizes = np.zeros(1, np.int64), np.array([n])
    ids, places, known = np.zeros(1, np.int64), np.array([place], np.uint64), 1
    leaf_of, both, side = np.zeros(n, np.int64), w + 0j, np.zeros(n, np.uint8)
    off = both.imag                                                      # beside the weight, so that one running sum serves both
    feature, threshold, left, right = [], [], [], []
    code = y.astype(np.int64) if classes else None
    n_codes = int(code.max(initial=0)) + 1 if classes else 0
    of_class = [np.where(code == c, w, 0.0) for c in range(n_codes)] if n_codes <= FEW_CLASSES else []
    while len(starts):
        seg, rows, ends = np.repeat(np.arange(len(starts)), sizes), orders[0], starts + sizes
        wr, yr = w.take(rows), y.take(rows)
        whole = np.add.reduceat(wr, starts)
        mixed = np.minimum.reduceat(yr, starts) < np.maximum.reduceat(yr, starts)
        gains, cuts = np.full((p, len(starts)), -np.inf), np.zeros((p, len(starts)))
        room = mixed[seg] & (depth is None or depth > 0)
        room[ends - 1] = False
        if min_leaf > 1:
            at = np.arange(len(rows))
            room &= (at - starts[seg] + 1 >= min_leaf) & (ends[seg] - at - 1 >= min_leaf)
        if not classes:                                 # about the node's mean, so that small steps beside large ones count
            off[rows] = wr * (yr - (np.add.reduceat(wr * yr, starts) / whole)[seg])
        splits = mixed & (depth is None or depth > 0)
        rank = _ranks(places, p) if m < p else None

        def judge(j: int, o: np.ndarray, some: np.ndarray) -> None:
            """Best cut of some nodes by feature j, whose order is o."""
            mine, free, of, base, weight = seg, room, some, starts, whole
            if len(some) < len(starts):
                taken = np.zeros(len(starts), bool)
                taken[some] = True
                taken = np.repeat(taken, sizes)
                o, free, mine, weight = o[taken], room[taken], np.repeat(np.arange(len(some)), sizes[some]), whole[some]
                base = np.concatenate([[0], sizes[some].cumsum()[:-1]])
            tops = np.append(base[1:], len(o))
            v = columns[j].take(o)
            fits = free.copy()
            fits[:-1] &= v[:-1] < v[1:]
            spots = np.flatnonzero(fits)                                 # the only places a gain is asked for
            if not len(spots):
                return
            node = mine[spots]

            def upto(s):
                """Sums of the node up to each spot, and of whole nodes."""
                sums = np.empty(len(s) + 1, s.dtype)
                sums[0] = 0.0
                s.cumsum(out=sums[1:])
                before = sums[base]
                return sums[spots + 1] - before[node], sums[tops] - before
            lw, total = upto((w if classes else both).take(o))
            if not classes:
                lw, ls, total = lw.real.copy(), lw.imag.copy(), total.imag
            rw = np.maximum(weight[node] - lw, 1e-300)
            if of_class:
                lefts, rights, rest, last = 0.0, 0.0, lw, rw
                for weights in of_class[1:]:
                    lc, total = upto(weights.take(o))
                    rc = total[node] - lc
                    lefts, rights, rest, last = lefts + lc ** 2, rights + rc ** 2, rest - lc, last - rc
                gain = (lefts + rest ** 2) / lw + (rights + last ** 2) / rw
            elif classes:                              # squares of class weights left and right, from running weights by class
                wt, at = w[o], np.arange(len(o))
                order = np.lexsort((at, code[o], mine))
                same = wt[order].cumsum()
                begin = np.flatnonzero(np.append(True, (np.diff(mine[order]) != 0) | (np.diff(code[o][order]) != 0)))
                runs = np.diff(np.append(begin, len(order)))
                above = np.repeat(same[begin] - wt[order][begin], runs)
                before, total = np.empty(len(o)), np.empty(len(o))
                before[order] = same - wt[order] - above
                total[order] = np.repeat(np.add.reduceat(wt[order], begin), runs)
                ll, cross = upto(2 * wt * before + wt * wt)[0], upto(wt * total)[0]
                squares = np.add.reduceat(wt * total, base)[node]        # of all class weights
                gain = ll / lw + (squares - 2 * cross + ll) / rw
            else:
                gain = ls ** 2 / lw + (total[node] - ls) ** 2 / rw
            begin = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            top = np.maximum.reduceat(gain, begin)
            hit = gain == np.repeat(top, np.diff(np.append(begin, len(node))))
            best = np.minimum.reduceat(np.where(hit, spots, len(o)), begin)
            middle, at = v[best] + (v[best + 1] - v[best]) / 2, of[node[begin]]
            gains[j, at] = top
            cuts[j, at] = np.where(middle < v[best + 1], middle, v[best])

        parts = None
        for turn in range(p - m + 1 if m < p and splits.any() else int(splits.any())):       # first the m features that fall to a node, then
            ask = splits & ~(np.isfinite(gains) & (rank < m + turn - 1)).any(axis=0) if turn else splits     # one more where none of them can split
            if not ask.any():
                break
            asked = [np.flatnonzero(ask if rank is None else ask & ((rank[j] < m) if turn == 0 else (rank[j] == m + turn - 1))) for j in range(p)]
            for j, o in zip(many, orders):
                if len(asked[j]):
                    judge(j, o, asked[j] if rank is not None and len(asked[j]) < SOME * len(starts) else np.arange(len(starts)))
            for j, (low, high, upper) in twos.items():                   # one sum a node, no order to keep
                if not len(asked[j]):
                    continue
                if parts is None:
                    parts = [weights.take(rows) for weights in of_class] if classes else [off.take(rows)]
                    totals, weight = [np.add.reduceat(part, starts) for part in parts], wr
                up = upper.take(rows)
                n_up = np.add.reduceat(up, starts)
                nodes = np.flatnonzero(splits & (n_up >= max(1, min_leaf)) & (sizes - n_up >= max(1, min_leaf)))
                if not len(nodes):
                    continue
                rw = np.add.reduceat(weight * up, starts)[nodes]
                lw = np.maximum(whole[nodes] - rw, 1e-300)
                lefts = rights = 0.0
                for part, total in zip(parts, totals):
                    right_sum = np.add.reduceat(part * up, starts)[nodes]
                    lefts, rights = lefts + (total[nodes] - right_sum) ** 2, rights + right_sum ** 2
                gains[j, nodes], middle = lefts / lw + rights / rw, low + (high - low) / 2
                cuts[j, nodes] = middle if middle < high else low
        chosen = _allowed(places, gains, m)
        f, nodes = chosen.argmax(axis=0), np.arange(len(starts))
        split = np.isfinite(chosen[f, nodes])
        number = np.cumsum(split) - 1
        cut = cuts[f, nodes]
        feature.append(np.where(split, f, -1))
        threshold.append(np.where(split, cut, 0.0))
        left.append(np.where(split, known + 2 * number, 0))
        right.append(np.where(split, known + 2 * number + 1, 0))
        stays = split[seg]
        leaf_of[rows[~stays]] = ids[seg[~stays]]
        if not split.any():
            break
        side[rows[~stays]] = 2
        rows, seg, kept = rows[stays], seg[stays], sizes[split]
        base = np.concatenate([[0], kept.cumsum()[:-1]])
        goes = x[rows, f[seg]] <= cut[seg]
        side[rows] = ~goes
        into = np.add.reduceat(goes.astype(np.int64), base)
        outof = kept - into
        lefts = np.arange(into.sum()) + np.repeat(base - (into.cumsum() - into), into)              # where the rows of the children go,
        rights = np.arange(outof.sum()) + np.repeat(base + into - (outof.cumsum() - outof), outof)  # in the order of every feature
        for j, o in enumerate(orders):
            to = side.take(o)
            orders[j] = np.empty(len(rows), np.int64)
            orders[j][lefts], orders[j][rights] = o[to == 0], o[to == 1]
        sizes = np.stack([into, outof], axis=1).ravel()
        starts = np.concatenate([[0], sizes.cumsum()[:-1]]).astype(np.int64)
        ids = known + np.arange(len(sizes))
        places = np.stack([_child(places[split], 0), _child(places[split], 1)], axis=1).ravel()
        known += len(sizes)
        depth = None if depth is None else depth - 1
    weight = np.bincount(leaf_of, w, known)
    if classes:
        width = int(code.max(initial=0)) + 1
        cell, inverse = np.unique(leaf_of * width + code, return_inverse=True)
        owner, output, share = cell // width, cell % width, np.bincount(inverse, w)
    else:
        owner = np.unique(leaf_of)
        output, share = np.zeros(len(owner), np.int64), np.bincount(leaf_of, w * y, known)[owner]
    offset = np.concatenate([[0], np.bincount(owner, minlength=known).cumsum()])
    return Part(np.concatenate(feature), np.concatenate(threshold), np.concatenate(left), np.concatenate(right), offset, output,
                share / weight[owner])


# --- nodes of many rows -------------------------------------------------------------------------

def _ordered(v: np.ndarray) -> np.ndarray:
    """Doubles as integers of the same order."""
    bits = (np.asarray(v, np.float64) + 0.0).view(np.int64)
    return np.where(bits >= 0, bits, np.int64(-2 ** 63) - bits)


def _double(code: np.ndarray) -> np.ndarray:
    code = np.asarray(code, np.int64)
    return np.where(code >= 0, code, np.int64(-2 ** 63) - code).view(np.float64)


def _steps(low: float, high: float) -> np.ndarray:
    """Limits that cut (low, high] in equal steps of ordered bits."""
    a, b = int(_ordered(np.array([low]))[0]), int(_ordered(np.array([high]))[0])
    return np.unique(_double(np.array([a + (b - a) * i // (SLOTS - 1) for i in range(SLOTS - 1)], dtype=np.int64)))


@dataclass
class Top:
    """The upper nodes of a tree; `open` ones still have more rows than a task finishes."""
    feature: list = field(default_factory=lambda: [-1])
    threshold: list = field(default_factory=lambda: [0.0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    place: list = field(default_factory=list)
    depth: list = field(default_factory=lambda: [0])
    edges: list = field(default_factory=lambda: [None])      # a node's own limits, None: those of the columns
    box: list = field(default_factory=list)                  # (low, high] a feature
    open: list = field(default_factory=list)
    mean: list = field(default_factory=lambda: [0.0])        # of the node's targets
    stop: dict = field(default_factory=dict)                 # node -> [(output, share)]: a leaf of many rows

    def arrays(self):
        return np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.right)


def _blocks(batches: Iterator[pa.RecordBatch], p: int) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            x, y, w, key = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in _KINDS.items())
            yield [x.reshape(-1, p), y, w, key]


def _pack(p: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                fields = [batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p) + 0.0,
                          *[batch.column(c).to_numpy(zero_copy_only=False).astype(_KINDS[c]) for c in ("y", "weight")],
                          batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)]
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(f).tobytes()], pa.binary()) for f in fields], list(_KINDS))
    return run


def _counting(p: int, k: int, classes: bool, seed: int, edges: list[np.ndarray], asked: list[tuple]):
    """Sums of a task by (slot, cell): cell = (feature, bin, channel), channels rows, weight, squares and a target for each output.
    asked: (tree, top arrays, {node: (slot, own limits, mean of the targets)})."""
    width = 3 + k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(sum(len(nodes) for _, _, nodes in asked) * p * SLOTS * width)
        for x, y, weight, key in _blocks(batches, p):
            bins = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1)
            for tree, top, nodes in asked:
                count = draws(key, tree, seed)
                taken = np.flatnonzero(count)
                node = route(*top, x[taken])
                slot = np.full(len(top[0]), -1)
                about = np.zeros(len(top[0]))
                for i, (s, _, mean) in nodes.items():
                    slot[i], about[i] = s, mean
                taken, node = taken[slot[node] >= 0], node[slot[node] >= 0]
                mine = bins[taken]
                for i, (_, own, _) in nodes.items():
                    if own is not None:
                        these = np.flatnonzero(node == i)
                        mine[these] = np.stack([np.searchsorted(e, x[taken[these], j]) for j, e in enumerate(own)], axis=1)
                w, t = weight[taken] * count[taken], y[taken] - about[node]
                begin, cells = min(s for s, *_ in nodes.values()), len(nodes) * p * SLOTS * width       # slots of a tree are neighbours
                area = sums[begin * p * SLOTS * width:][:cells]
                for j in range(p):
                    at = (((slot[node] - begin) * p + j) * SLOTS + mine[:, j]) * width
                    target = at + 3 + (t.astype(np.int64) if classes else 0)
                    area += np.bincount(np.concatenate([at, at + 1, at + 2, target]),
                                        np.concatenate([np.ones(len(t)), w, w if classes else w * t * t, w if classes else w * t]), cells)
        some = np.flatnonzero(sums)
        cells = p * SLOTS * width
        yield pa.RecordBatch.from_arrays([pa.array(some // cells), pa.array(some % cells), pa.array(sums[some])], ["slot", "cell", "v"])
    return run


_PICKED = "slot long, n long, off double, mean_left array<double>, mean_right array<double>, gain array<double>, bin array<int>, n_left array<long>, low array<int>, high array<int>, share array<double>"


def _pick(p: int, k: int, min_leaf: int):
    """Best split of a node for each feature, and the bins its rows take."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros(p * SLOTS * (3 + k))
        sums[rows["cell"].to_numpy()] = rows["v"].to_numpy()
        sums = sums.reshape(p, SLOTS, 3 + k)
        left = sums.cumsum(axis=1)
        right = left[:, -1:] - left
        fits = (left[..., 0] >= max(1, min_leaf)) & (right[..., 0] >= max(1, min_leaf)) & (left[..., 1] > 0) & (right[..., 1] > 0)
        part = lambda s: (s[..., 3:] ** 2).sum(axis=-1) / np.maximum(s[..., 1], 1e-300)
        gain = np.where(fits, part(left) + part(right), -np.inf)
        at, whole = gain.argmax(axis=1), left[0, -1]
        off = (whole[2] - float(part(whole))) / max(whole[1], 1e-300)        # impurity: variance, or Gini
        means = [(s[np.arange(p), at, 3] / np.maximum(s[np.arange(p), at, 1], 1e-300)).tolist() for s in (left, right)]
        filled = sums[..., 0] > 0
        return pd.DataFrame({"slot": [rows["slot"].iloc[0]], "n": [int(round(whole[0]))], "off": [off], "mean_left": [means[0]], "mean_right": [means[1]],
                             "gain": [gain[np.arange(p), at].tolist()], "bin": [at.tolist()],
                             "n_left": [np.rint(left[np.arange(p), at, 0]).astype(np.int64).tolist()], "low": [filled.argmax(axis=1).tolist()],
                             "high": [(SLOTS - 1 - filled[:, ::-1].argmax(axis=1)).tolist()], "share": [(whole[3:] / max(whole[1], 1e-300)).tolist()]})
    return run


def _settle(top: Top, i: int, found, edges: list[np.ndarray], m: int, fit_rows: int, max_depth: int | None, classes: bool, centre: float) -> None:
    """What becomes of an open node: split, cut into finer bins, or a leaf."""
    own = top.edges[i] or edges
    box = [(max(low, own[j][lo - 1]) if lo else low, min(high, own[j][hi]) if hi < len(own[j]) else high)
           for j, ((low, high), lo, hi) in enumerate(zip(top.box[i], found["low"], found["high"]))]
    top.open.remove(i)
    if found["n"] <= fit_rows:                                   # the drawn rows fit after all
        return
    spread_out = [_ordered(np.array([a]))[0] + 1 < _ordered(np.array([b]))[0] for a, b in box]
    gains = _allowed(np.array([top.place[i]], np.uint64), np.array(found["gain"])[:, None], m)[:, 0]
    noise = 1e-12 if classes else (1e-14 * (abs(centre) + abs(top.mean[i]))) ** 2
    if found["off"] <= noise or (max_depth is not None and top.depth[i] >= max_depth) or not (np.isfinite(gains).any() or any(spread_out)):
        top.stop[i] = [(c, s + top.mean[i]) for c, s in enumerate(found["share"]) if s or not classes]
        return
    if not np.isfinite(gains).any():
        top.box[i], top.edges[i] = box, [_steps(a, b) for a, b in box]
        top.open.append(i)
        return
    f = int(gains.argmax())
    cut = float(own[f][found["bin"][f]])
    sides = (found["n_left"][f], found["n"] - found["n_left"][f])
    top.feature[i], top.threshold[i], top.left[i], top.right[i] = f, cut, len(top.feature), len(top.feature) + 1
    for side, n in enumerate(sides):
        child, area = len(top.feature), list(box)
        area[f] = (box[f][0], cut) if side == 0 else (cut, box[f][1])
        for values, value in ((top.feature, -1), (top.threshold, 0.0), (top.left, 0), (top.right, 0), (top.depth, top.depth[i] + 1),
                              (top.place, int(_child(np.array([top.place[i]], np.uint64), side)[0])), (top.edges, top.edges[i]), (top.box, area),
                              (top.mean, 0.0 if classes else top.mean[i] + found[("mean_left", "mean_right")[side]][f])):
            values.append(value)
        if n > fit_rows:
            top.open.append(child)


# --- the forest ---------------------------------------------------------------------------------

@dataclass
class Forest:
    p: int
    k: int
    base: np.ndarray                       # shares, or the mean, of all rows: what a tree without rows says
    centre: float
    tops: list[Top]
    parts: DataFrame                       # tree, node, part (bytes)
    size: int
    passes: int
    depth: int                             # of the deepest leaf

    def __post_init__(self):
        self._near = None
        if self.size <= TASK_BYTES:
            self._near = {(r["tree"], r["node"]): bytes(r["part"]) for r in self.parts.collect()}

    def outputs(self, df: DataFrame, x: list[str]) -> DataFrame:
        """df with `_outputs`: shares of the classes, or the predicted value."""
        features = F.array(*[q(c).cast("double") for c in x])
        if self._near is not None:
            return df.withColumn("_outputs", self._in_tasks()(features))
        numbered = staged(df.withColumn("_row", F.monotonically_increasing_id()))
        return numbered.join(self._met(numbered.select("_row", features.alias("x"))), "_row").drop("_row")

    def _in_tasks(self):
        parts = {key: Part.unpacked(part) for key, part in self._near.items()}
        tops, k, base, centre = [(t.arrays(), t.stop) for t in self.tops], self.k, self.base, self.centre

        @F.pandas_udf("array<double>")
        def outputs(values: pd.Series) -> pd.Series:
            x = np.stack(values.to_numpy()) + 0.0 if len(values) else np.zeros((0, 1))
            out = np.zeros((len(x), k))
            for tree, (top, stop) in enumerate(tops):
                _through(tree, top, stop, parts, base, x, out)
            return pd.Series(list(out / len(tops) + centre))
        return outputs

    def _met(self, rows: DataFrame) -> DataFrame:
        """(_row, _outputs): rows sent to the finished parts in blocks, the blocks' sums added up by block."""
        tops, k, p, base, centre = [(t.arrays(), t.stop) for t in self.tops], self.k, self.p, self.base, self.centre
        sent = "block string, tree int, node int, kind int, rows binary, data binary"
        summed = "block string, rows binary, data binary"
        finished = self.parts.select("tree", "node").distinct()
        have = {(r["tree"], r["node"]) for r in finished.collect()}         # a pair for each node of a task's worth of rows

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids = batch.column("_row").to_numpy(zero_copy_only=False).astype(np.int64)
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p) + 0.0
                block, here = str(ids[0]), np.zeros((len(x), k))
                for tree, (top, stop) in enumerate(tops):
                    node, fields = route(*top, x), []
                    for i in np.unique(node):
                        at = np.flatnonzero(node == i)
                        if (tree, int(i)) in have:
                            fields.append((block, tree, int(i), 1, at.astype(np.int32).tobytes(), x[at].tobytes()))
                        else:
                            _stopped(stop, int(i), base, at, here)
                    if fields:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*fields), _SENT)], sent_names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    ([block], [-1], [-1], [2], [ids.tobytes()], [here.tobytes()]), _SENT)], sent_names)

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = None
            for batch in batches:
                for i in range(batch.num_rows):
                    kind, rows, data = batch.column("kind")[i].as_py(), batch.column("rows")[i].as_py(), batch.column("data")[i].as_py()
                    block = batch.column("block")[i].as_py()
                    if kind == 0:
                        part = Part.unpacked(data)
                        continue
                    if kind == 1:
                        x = np.frombuffer(data).reshape(-1, p)
                        out = np.zeros((len(x), k))
                        part.add(x, out, np.arange(len(x)))
                        data = out.tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([rows if kind == 1 else b"\0" + rows], pa.binary()),
                                                      pa.array([data], pa.binary())], ["block", "rows", "data"])

        def add(group: pd.DataFrame) -> pd.DataFrame:
            head = next(r[1:] for r in group["rows"] if len(r) % 4)
            ids = np.frombuffer(head, np.int64)
            out = np.zeros((len(ids), k))
            for rows, data in sorted(zip(group["rows"], group["data"])):
                values = np.frombuffer(data).reshape(-1, k)
                if len(rows) % 4:
                    out += values
                else:
                    out[np.frombuffer(rows, np.int32)] += values
            return pd.DataFrame({"_row": ids, "_outputs": list(out / len(tops) + centre)})

        parts = self.parts.select(F.lit("").alias("block"), "tree", "node", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("rows"),
                                  F.col("part").alias("data"))
        sent_names = [c.split()[0] for c in sent.split(", ")]
        met = (rows.mapInArrow(deal, sent).unionByName(parts).repartition(max(1, min(4096, len(have))), "tree", "node")
               .sortWithinPartitions("tree", "node", "kind").mapInArrow(meet, summed))
        return met.groupBy("block").applyInPandas(add, "_row long, _outputs array<double>")


_SENT = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())


def _stopped(stop: dict, node: int, base: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    for c, share in stop[node] if node in stop else enumerate(base):
        out[rows, c] += share


def _through(tree: int, top, stop: dict, parts: dict, base: np.ndarray, x: np.ndarray, out: np.ndarray) -> None:
    node = route(*top, x)
    for i in np.unique(node):
        at = np.flatnonzero(node == i)
        part = parts.get((tree, int(i)))
        if part is None:
            _stopped(stop, int(i), base, at, out)
        else:
            part.add(x[at], out, at)


def fit_forest(train: DataFrame, x: list[str], task: str, n_classes: int, n_rows: int, n_trees: int = 200, max_depth: int | None = None,
               min_leaf: int = 1, max_features: str | None = None, seed: int = 42, fit_rows: int = FIT_ROWS) -> Forest:
    """Forest of the rows of train (x, y, weight, row_key).  y: a number, or a class from 0.  max_features: sqrt, log2 or None for all."""
    classes = task != "regression"
    p, k = len(x), n_classes if classes else 1
    m = max(1, {"sqrt": int(np.sqrt(p)), "log2": int(np.log2(p))}.get(max_features, p))
    rows = train.select(F.array(*[q(c).cast("double") for c in x]).alias("x"), F.col("y").cast("double"), F.col("weight").cast("double"),
                        F.xxhash64("row_key").alias("key")).filter("weight > 0")
    head = rows.agg(F.sum("weight").alias("w"), (F.sum(F.col("y") * F.col("weight")) / F.sum("weight")).alias("mean")).first()
    centre = 0.0 if classes else head["mean"] or 0.0
    if classes:
        share = {int(r["y"]): r["w"] / head["w"] for r in rows.groupBy("y").agg(F.sum("weight").alias("w")).collect()}   # a row for each class
        base = np.array([share.get(c, 0.0) for c in range(k)])
    else:
        base = np.zeros(1)
    rows = spread(rows.withColumn("y", F.col("y") - F.lit(centre)), n_rows)
    table = staged(rows.mapInArrow(_pack(p), _BLOCK))
    tops = [Top(place=[int(_mix(np.uint64(seed * 7_919 + t)))]) for t in range(n_trees)]
    edges, passes = [np.zeros(0)] * p, 0
    if n_rows > fit_rows:
        flat = staged(train.select(*[q(c).cast("double").alias(c) for c in x]))
        edges = bin_edges(flat, x)
        ends = flat.agg(*[f(q(c)).alias(f"{f.__name__}{j}") for j, c in enumerate(x) for f in (F.min, F.max)]).first()
        flat.unpersist()
        for top in tops:
            top.open, top.box = [0], [[(float(np.nextafter(ends[f"min{j}"], -np.inf)), float(ends[f"max{j}"])) for j in range(p)]]
    lot = max(1, LOT_CELLS // (p * SLOTS * (3 + k)))
    while any(t.open for t in tops):
        wanted = [(t, i) for t, top in enumerate(tops) for i in top.open]
        for a in range(0, len(wanted), lot):
            asked: dict[int, dict] = {}
            for s, (t, i) in enumerate(wanted[a:a + lot]):
                asked.setdefault(t, {})[i] = (s, tops[t].edges[i], tops[t].mean[i])
            count = _counting(p, k, classes, seed, edges, [(t, tops[t].arrays(), nodes) for t, nodes in asked.items()])
            sums = table.mapInArrow(count, "slot long, cell long, v double").groupBy("slot", "cell").agg(F.sum("v").alias("v"))
            found = {r["slot"]: r for r in sums.groupBy("slot").applyInPandas(_pick(p, k, min_leaf), _PICKED).collect()}     # a row a node
            passes += 1
            for s, (t, i) in enumerate(wanted[a:a + lot]):
                if s in found:
                    _settle(tops[t], i, found[s], edges, m, fit_rows, max_depth, classes, centre)
                else:                                            # no row was drawn
                    tops[t].open.remove(i)
    ready = [(t, top.arrays(), np.array(top.depth), np.array(top.place, np.uint64), np.array(sorted(top.stop), np.int64)) for t, top in enumerate(tops)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, y, weight, key in _blocks(batches, p):
            for t, top, *_, stop in ready:
                count = draws(key, t, seed)
                taken = np.flatnonzero(count)
                node = route(*top, values[taken])
                packs = []
                for i in np.setdiff1d(node, stop):
                    at = taken[node == i]
                    packs.append((t, int(i), np.column_stack([values[at], y[at], weight[at] * count[at], key[at].view(np.float64)]).tobytes()))
                if packs:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*packs), (pa.int32(), pa.int32(), pa.binary()))],
                                                     ["tree", "node", "rows"])

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        t, i = int(group["tree"].iloc[0]), int(group["node"].iloc[0])
        data = np.concatenate([np.frombuffer(r).reshape(-1, p + 3) for r in group["rows"]])
        keys = np.ascontiguousarray(data[:, -1]).view(np.int64)
        order = keys.argsort()
        if (np.diff(keys[order]) == 0).any():                            # copies of a key: by their values
            order = np.lexsort((*data[:, :p + 2].T, keys))
        data = data[order]                                               # whatever the order of arrival
        _, _, depth, place, _ = ready[t]
        part = grow(data[:, :p].copy(), data[:, p].copy(), data[:, p + 1].copy(), classes, m, min_leaf,
                    None if max_depth is None else max_depth - int(depth[i]), int(place[i]))
        return pd.DataFrame({"tree": [t], "node": [i], "depth": [int(depth[i]) + _depth(part)], "part": [part.packed()]})

    n_nodes = sum(top.feature.count(-1) - len(top.stop) for top in tops)
    parts = staged(table.mapInArrow(deal, "tree int, node int, rows binary").repartition(max(1, min(4096, n_nodes)), "tree", "node")
                   .groupBy("tree", "node").applyInPandas(finish, "tree int, node int, depth int, part binary"))
    made = parts.agg(F.sum(F.length("part")).alias("size"), F.max("depth").alias("depth")).first()
    table.unpersist()
    return Forest(p, k, base, centre, tops, parts, made["size"] or 0, passes, max([made["depth"] or 0, *[max(t.depth) for t in tops]]))


def _depth(part: Part) -> int:
    level, nodes = 0, np.zeros(1, np.int64)
    while True:
        nodes = nodes[part.feature[nodes] >= 0]
        if not len(nodes):
            return level
        nodes, level = np.concatenate([part.left[nodes], part.right[nodes]]), level + 1
