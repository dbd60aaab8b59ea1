"""Exact top-k search by inner product, with a KD-tree for each shard of vectors.

A shard (the vectors of one Arrow batch) is split at the median of its widest component until a leaf is small; every node
keeps the tight box of its vectors.  The largest inner product that a box allows is the sum over components of the better
of its two sides.  Queries descend together and leave a node whose bound is below their kth score; leaves are then
visited from the best bound on, and the kth score rises as they are.  It is carried from shard to shard of a task, and
starts as the kth score among the block of queries themselves, which are rows of the table; a job with trees finds it.

Queries are a stated set; they are written in blocks (by hash) of about BLOCK queries and go to the shards block by
block, one scan for each.  Results are written before the next block, so the driver holds one block and no product of it.  Vectors that are null,
empty, or hold null or non-finite components, and rows without an id take no part.  Vectors of another length than the
query's are not compared with it.  A row is the query's own if it has its vec_id; equal rows of a query count once as
query and each as candidate; ties go to the smaller vec_id.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .stage import discard, staged, table

K = 5
BLOCK = 8192
LEAF = 64


class Tree:
    """Median splits down to leaves; nodes level by level, with tight boxes."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.vectors = vectors
        self.low, self.high, self.children, self.rows = [], [], [], []
        pending = [(np.arange(len(vectors)), -1)]
        for index, (rows, parent) in enumerate(pending):     # grows while it is walked
            inside = vectors[rows]
            low, high = inside.min(axis=0), inside.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(index)
            wide = int(np.argmax(high - low))
            if len(rows) > leaf and high[wide] > low[wide]:
                order = rows[np.argsort(inside[:, wide], kind="stable")]
                pending += [(order[:len(order) // 2], index), (order[len(order) // 2:], index)]
                self.rows.append(None)
            else:
                self.rows.append(rows)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def leaves(self, queries: np.ndarray, kth: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Leaves that may hold a result: (node, queries, their bounds)."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        reach, found = [(0, np.arange(len(queries)))], []
        for node, who in reach:
            bound = up[who] @ self.high[node] + down[who] @ self.low[node]
            open_ = bound >= kth[who]
            who, bound = who[open_], bound[open_]
            if not len(who):
                continue
            if self.rows[node] is not None:
                found.append((node, who, bound))
            reach += [(child, who) for child in self.children[node]]
        return found


class Best:
    """The k best of each query: scores from the highest, ties by id."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.scores, self.ids = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)

    def add(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores: one row for each of `who`, -inf where a vector is not a candidate."""
        s = np.concatenate([self.scores[who], scores], axis=1)
        i = np.concatenate([self.ids[who], np.broadcast_to(ids, scores.shape)], axis=1)
        i[s == -np.inf] = np.iinfo(np.int64).max
        order = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.scores[who], self.ids[who] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        self.floor[who] = np.maximum(self.floor[who], self.scores[who, -1])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact in double precision or else in 64-bit integers."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2 ** 53:
        return a @ b.T
    return (a.astype(np.int64) @ b.astype(np.int64).T).astype(float)


def _matrix(batch: pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """ids and vectors by length."""
    column, ids = batch.column("v"), batch.column("vec_id").to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    begin = np.cumsum(sizes) - sizes
    return {int(d): (ids[sizes == d], flat[(begin[sizes == d][:, None] + np.arange(d))]) for d in np.unique(sizes)}


def _search(queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], k: int):
    """queries: by length, their numbers, ids, vectors and known kth scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {d: Best(len(q[0]), k, q[3]) for d, q in queries.items()}
        for batch in batches:
            for d, (ids, vectors) in _matrix(batch).items() if batch.num_rows else ():
                if d not in queries:
                    continue
                _, own, asked, _ = queries[d]
                tree, top = Tree(vectors), best[d]
                leaves = tree.leaves(asked, top.floor)
                if not leaves:
                    continue
                node = np.concatenate([np.full(len(w), j) for j, (_, w, _) in enumerate(leaves)])
                who = np.concatenate([w for _, w, _ in leaves])
                bound = np.concatenate([b for _, _, b in leaves])
                order = np.lexsort((-bound, who))
                node, who, bound = node[order], who[order], bound[order]
                turn = np.arange(len(who)) - np.searchsorted(who, who)           # 0: the query's best leaf
                for r in range(int(turn.max()) + 1):
                    now = np.flatnonzero((turn == r) & (bound >= top.floor[who]))
                    now = now[np.argsort(node[now], kind="stable")]
                    for part in np.split(now, np.flatnonzero(np.diff(node[now])) + 1) if len(now) else ():
                        rows, q = tree.rows[leaves[node[part[0]]][0]], who[part]
                        scores = _products(asked[q], vectors[rows])
                        scores = np.where(own[q][:, None] == ids[rows][None, :], -np.inf, scores)
                        top.add(q, scores, ids[rows])
        for d, (number, own, _, _) in queries.items():
            row, place = np.nonzero(best[d].scores > -np.inf)
            yield pa.RecordBatch.from_arrays([
                pa.array(number[row], pa.int64()), pa.array(own[row], pa.int64()), pa.array(best[d].ids[row, place], pa.int64()),
                pa.array(best[d].scores[row, place].astype(np.int64), pa.int64())], ["number", "query_id", "vec_id", "score"])
    return run


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """Usable rows: vec_id and v, the components times 256, rounded down."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad).select(
        "vec_id", F.transform("embedding", lambda v: F.floor(v * 256).cast("double")).alias("v"))


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query.  Both tables: vec_id, v (whole numbers)."""
    asked = queries.select("vec_id", "v").distinct()
    n_blocks = -(-asked.count() // block) or 1
    asked = staged(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks))).orderBy("block"))
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    schema, parts = "number long, query_id long, vec_id long, score long", []
    for b in range(n_blocks):
        mine = asked.filter(F.col("block") == b).select("vec_id", "v")
        held, n = {}, 0
        for batch in mine.toArrow().to_batches():
            for d, (ids, matrix) in _matrix(batch).items() if batch.num_rows else ():
                held.setdefault(d, []).append((np.arange(n, n + len(ids)), ids, matrix, np.full(len(ids), -np.inf)))
                n += len(ids)
        known = {d: tuple(np.concatenate(x) for x in zip(*q)) for d, q in held.items()}
        ranked = lambda found: found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        floor = np.full(n, -np.inf)
        for number, score in ranked(mine.mapInArrow(_search(known, k), schema)).filter(F.col("rank") == k).select("number", "score").toLocalIterator():
            floor[number] = score
        known = {d: (*q[:3], floor[q[0]]) for d, q in known.items()}
        parts.append(staged(ranked(vectors.mapInArrow(_search(known, k), schema)).select("query_id", "rank", "vec_id", "score")))
    discard(asked)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return exact_top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
