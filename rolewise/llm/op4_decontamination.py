"""Benchmark decontamination: a positional inverted index of the training texts, searched for benchmark windows.

A-Z is lower-cased, words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`.  The index is distributed by document: a shard of texts
keeps, for each term, the sorted places where it occurs, as one array of (term, place) keys.  A window's terms are taken
from the rarest in the shard on: the rarest list, moved by the term's offset, gives candidate starts, and each further
list, moved by its own offset, is intersected with what is left.  With `slop` a term may lie that many words from its
offset (proximity match).  No text is shuffled; a text is in one shard, so its hits are complete there.

The benchmark is a stated query set: it is sent to the shards in blocks of at most BLOCK_WORDS words, one scan for each
block, however large it is.  Null and empty texts have no words; an item of fewer than `length` words is one window;
items of equal text are all reported; items without an id are searched for like others and reported together as one null, last in
`items` (it counts in n_items, and the hash of the ids leaves it out); repeated rows are judged one by one.  Columns other than doc_id, text, item_id are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .passages import keyed, NO_ID
from .stage import table
from .text import LOWER, slices, utf8, word_hashes, words

LENGTH = 10
BLOCK_WORDS = 2_000_000          # benchmark words that one scan searches for
SHARD_BYTES = 2 << 20
TERM = ~np.isin(np.arange(256), [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

HITS = "id long, key long, n_words long, spans array<struct<begin:int,stop:int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32())]))


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of words before each row."""
    data = LOWER[data]
    starts, stops, per_row = words(data, offsets, TERM)
    return word_hashes(data, starts, stops), per_row


def _null_last(name: str | None) -> tuple[bool, str]:
    return name is None, name or ""


class Windows:
    """Distinct windows of a block of items: places in the sorted list of test terms, and the items that hold them."""

    def __init__(self, items: list[tuple[str | None, str]], length: int):
        column = pa.array([t for _, t in items], pa.string())
        hashes, per_item = term_hashes(*utf8(column))
        self.terms, place = np.unique(hashes, return_inverse=True)
        holders: dict[tuple, set[str | None]] = {}
        for (name, _), a, b in zip(items, per_item[:-1], per_item[1:]):
            for s in range(a, max(a, b - length) + 1) if b > a else ():
                holders.setdefault(tuple(place[s:min(s + length, b)].tolist()), set()).add(name)
        self.size = np.array([len(w) for w in holders], np.int64)
        self.grid = np.full((len(holders), length), -1, np.int64)
        for i, w in enumerate(holders):
            self.grid[i, :len(w)] = w
        self.items = [sorted(s, key=_null_last) for s in holders.values()]


class Shard:
    """Positional inverted index of some texts."""

    def __init__(self, hashes: np.ndarray, per_row: np.ndarray):
        self.n = len(hashes)
        self.terms, rank, self.count = np.unique(hashes, return_inverse=True, return_counts=True)
        self.keys = np.sort(rank.astype(np.int64) * self.n + np.arange(self.n))     # (term, place)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.row = np.repeat(np.arange(len(per_row) - 1), np.diff(per_row))
        self.begin = np.asarray(per_row)

    def search(self, w: Windows, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, start, row) of the matches.  With slop a match may reach over an end of its row, its terms may not."""
        none = np.zeros(0, np.int64)
        if not self.n or not len(w.size):
            return none, none, none
        at = np.minimum(np.searchsorted(self.terms, w.terms), len(self.terms) - 1)
        term = np.where(self.terms[at] == w.terms, at, -1)             # of the test terms, in this shard
        grid = np.where(w.grid >= 0, term[w.grid], -2)
        window = np.flatnonzero((grid != -1).all(axis=1))              # all terms occur
        grid = grid[window]
        count = np.where(grid >= 0, self.count[np.maximum(grid, 0)], np.iinfo(np.int64).max)
        order = np.argsort(count, axis=1, kind="stable")               # rarest first, gaps last
        rare = order[:, 0]
        lists = grid[np.arange(len(grid)), rare] if len(grid) else none
        sizes = self.count[lists]
        local = np.repeat(np.arange(len(grid)), sizes)
        index = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.first[lists], sizes)
        place = self.keys[index] % self.n
        start, row = place - rare[local], self.row[place]
        if not slop:
            keep = (start >= self.begin[row]) & (start + w.size[window][local] <= self.begin[row + 1])
            start, local, row = start[keep], local[keep], row[keep]
        for j in range(1, order.shape[1]):
            offset = order[local, j]
            want = grid[local, offset]
            low = np.maximum(start + offset - slop, self.begin[row])
            high = np.minimum(start + offset + slop, self.begin[row + 1] - 1)
            found = np.searchsorted(self.keys, want * self.n + high, "right") > np.searchsorted(self.keys, want * self.n + low)
            keep = (found & (low <= high)) | (want == -2)
            start, local, row = start[keep], local[keep], row[keep]
        return window[local], start, row


def _scan(windows: Windows, slop: int, keep_clean: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SHARD_BYTES):
            hashes, per_row = term_hashes(*utf8(batch.column("text")))
            shard = Shard(hashes, per_row)
            window, start, in_row = shard.search(windows, slop)
            spans: dict[int, set] = {}
            items: dict[int, set] = {}
            for v, s, row in zip(window.tolist(), start.tolist(), in_row.tolist()):
                begin, n = s - int(per_row[row]), int(per_row[row + 1] - per_row[row])
                spans.setdefault(row, set()).add((max(begin, 0), min(begin + int(windows.size[v]), n)))
                items.setdefault(row, set()).update(windows.items[v])
            rows = range(batch.num_rows) if keep_clean else sorted(spans)
            picked = batch.select(["id", "key"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([
                picked.column(0), picked.column(1), pa.array(np.diff(per_row)[list(rows)] if len(rows) else [], pa.int64()),
                pa.array([[{"begin": a, "stop": b} for a, b in merged(spans.get(r, ()))] for r in rows], _SPANS),
                pa.array([sorted(items.get(r, ()), key=_null_last) for r in rows], pa.list_(pa.string()))],
                ["id", "key", "n_words", "spans", "items"])
    return run


def merged(spans) -> list[list[int]]:
    """Stretches joined where they touch."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _blocks(benchmark: DataFrame, length: int, block_words: int) -> Iterator[Windows]:
    block, size = [], 0
    for name, text in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator():
        if text is None:
            continue
        block.append((name, text))
        size += len(text) // 2 + 1
        if size >= block_words:
            yield Windows(block, length)
            block, size = [], 0
    yield Windows(block, length)


def decontaminate(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, slop: int = 0,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """For each row of docs: doc_id, key, n_words, spans (joined stretches of hit words) and items (sorted ids)."""
    rows, parts = keyed(docs), []
    for windows in _blocks(benchmark, length, block_words):
        parts.append(rows.mapInArrow(_scan(windows, slop, not parts), HITS))
    found = parts[0]
    if len(parts) > 1:
        more = parts[1]
        for part in parts[2:]:
            more = more.unionByName(part)
        more = more.groupBy("id", "key").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("_spans"),
                                             F.flatten(F.collect_list("items")).alias("_items"))
        found = found.join(more, ["id", "key"], "left").select(
            "id", "key", "n_words", F.concat("spans", F.coalesce("_spans", F.array())).alias("spans"),
            F.array_sort(F.array_union("items", F.coalesce("_items", F.array()))).alias("items"))
        spans = F.array_sort("spans")
        found = found.withColumn("spans", F.aggregate(spans, F.expr("CAST(array() AS array<struct<begin:int,stop:int>>)"), lambda out, s: F.when(
            (F.size(out) > 0) & (s["begin"] <= F.element_at(out, -1)["stop"]),
            F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(
                F.element_at(out, -1)["begin"].alias("begin"), F.greatest(F.element_at(out, -1)["stop"], s["stop"]).alias("stop")))))
            .otherwise(F.concat(out, F.array(s)))))
    return found.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "key", "n_words", "spans", "items")


def _drop(windows: Windows, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SHARD_BYTES):
            hashes, per_row = term_hashes(*utf8(batch.column("text")))
            shard = Shard(hashes, per_row)
            clean = np.ones(batch.num_rows, bool)
            clean[shard.search(windows, slop)[2]] = False
            yield batch.filter(pa.array(clean))
    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, slop: int = 0,
                    block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs, with all their columns, that hold no benchmark window."""
    for windows in _blocks(benchmark, length, block_words):
        docs = docs.mapInArrow(_drop(windows, slop), docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["begin"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
wb AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, md5(array_to_string(w[s + 1:s + 10], ' ')) AS h
       FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wb),
wd AS (SELECT doc_id, n, s, md5(array_to_string(w[s + 1:s + n], ' ')) AS h
       FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, n, s, item_id FROM wd JOIN wb USING (n, h)),
spots AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM (SELECT DISTINCT doc_id, n, s FROM hits)) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN names USING (doc_id)
"""
