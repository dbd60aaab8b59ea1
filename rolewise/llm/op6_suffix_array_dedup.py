"""Suffix-array dedup: remove every byte inside a string of `length` bytes that starts anywhere else too.

Texts are UTF-8 bytes (null: none); matches never cross documents.  Candidate passages reach shards by content
(`passages`).  A shard holds several parts; each part has a suffix array of its own and its Burrows-Wheeler transform,
and the transforms are merged by refining an interleave: the suffixes are never sorted together.

The transform takes steps of `STEP` bytes: a symbol is the hash of the next STEP bytes, and the entry of a suffix is the
symbol before it, so h rounds of refinement order the merged suffixes by their first h * STEP bytes.  The round at which
a border appears between two neighbours is their common prefix; neighbours without a border after length / STEP rounds
share `length` bytes: a repeated interval.  Symbols are compared by 64-bit hashes.

Null, empty and short texts: nothing is removed.  Equal rows: each is a copy of the other, so both go.  Input columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from .passages import Unit, without_repeats
from .stage import table
from .text import BYTE_VALUE, Rolling, dense, order_of

LENGTH = 200
STEP = 50
GRAM = 32
GROUP_SIZE = 2 << 20              # bytes of one gram that a shard holds
PART_BYTES = 128 << 10          # text of one part, which is sorted alone


class Part:
    """Suffixes of some passages in steps of `step` bytes.  A passage of m bytes has elements 0..m; the last `step` of
    them end the chains i, i + step, i + 2 step, ..."""

    def __init__(self, symbols: np.ndarray, place: np.ndarray, size: np.ndarray, step: int):
        self.symbols = symbols                                        # 0 at the end of a chain
        n = len(symbols)
        ends = symbols == 0
        n_ends = int(ends.sum())
        rank = np.where(ends, np.cumsum(ends) - 1, symbols + n_ends)
        ahead, longest = step, int(size.max(initial=0)) + 1
        index = np.arange(n)
        order = order_of(rank)
        while ahead <= longest:
            follows = np.where(place + ahead <= size, rank[np.minimum(index + ahead, n - 1)], 0)
            order = order_of(follows)
            order = order[order_of(rank[order])]
            a, b = rank[order], follows[order]
            fresh = np.ones(n, np.int64)
            fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh) - 1
            ahead *= 2
        self.suffixes = order
        self.transform = np.where(place[order] >= step, symbols[np.maximum(order - step, 0)], 0)


def merge(parts: list[Part], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the parts' transforms after some rounds: the suffix (numbered over all parts) and, before each,
    the common prefix with its predecessor in steps (`rounds` stands for as many or more)."""
    sizes = [len(p.suffixes) for p in parts]
    shift = np.cumsum([0, *sizes[:-1]])
    suffixes = np.concatenate([p.suffixes + s for p, s in zip(parts, shift)])
    transform = np.concatenate([p.transform for p in parts])
    source = np.repeat(np.arange(len(parts)), sizes)
    block = np.zeros(len(source), np.int64)
    common = np.full(len(source), rounds, np.int64)
    for done in range(rounds):
        symbol = np.empty(len(source), np.int64)
        symbol[order_of(source)] = transform
        turn = order_of(symbol)                    # stable: the last round decides between equal symbols
        source, symbol, before = source[turn], symbol[turn], block[turn]
        border = np.ones(len(source), bool)
        border[1:] = (symbol[1:] != symbol[:-1]) | (before[1:] != before[:-1])
        common[border & (common == rounds)] = done
        block = np.cumsum(border)
    merged = np.empty(len(source), np.int64)
    merged[order_of(source)] = suffixes
    return merged, common


def repeated_places(bodies: list[bytes], length: int, step: int, part_bytes: int) -> list[np.ndarray]:
    """For each passage the starts of those of its strings of `length` bytes that occur again in any passage."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    grams = Rolling(BYTE_VALUE[np.frombuffer(b"".join(bodies), np.uint8)]).every(step)
    at = np.concatenate([[0], np.cumsum(sizes + 1)])                  # elements: one more than bytes in each passage
    place = np.arange(at[-1]) - np.repeat(at[:-1], sizes + 1)
    size = np.repeat(sizes, sizes + 1)
    inside = place + step <= size
    symbols = np.zeros(at[-1], np.int64)
    symbols[inside] = dense(grams[(np.repeat(offsets[:-1], sizes + 1) + place)[inside]]) + 1
    cuts = np.searchsorted(at, np.arange(0, at[-1], part_bytes))
    cuts = np.unique(np.append(cuts, len(bodies)))
    parts = [Part(symbols[at[a]:at[b]], place[at[a]:at[b]], size[at[a]:at[b]], step) for a, b in zip(cuts[:-1], cuts[1:])]
    merged, common = merge(parts, length // step)
    same = common >= length // step
    hit = same.copy()
    hit[:-1] |= same[1:]
    element = np.sort(merged[hit])
    element = element[place[element] + length <= size[element]]
    owner = np.searchsorted(at, element, "right") - 1
    return np.split(place[element], np.searchsorted(owner, np.arange(1, len(bodies))))


def _judge(pdf: pd.DataFrame, unit: Unit) -> pd.DataFrame:
    out: dict[str, list] = {"id": [], "key": [], "begin": [], "stop": []}
    found = repeated_places(pdf["body"].tolist(), unit.length, STEP, PART_BYTES)
    for id_, key, n, first, starts in zip(pdf["id"], pdf["key"], pdf["n"], pdf["first"], found):
        if n > 1 or not len(starts):                # copies of a whole passage are known already
            continue
        gap = np.flatnonzero(np.diff(starts) > 1)
        for a, b in zip(starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)]):
            out["id"].append(id_)
            out["key"].append(key)
            out["begin"].append(first + a)
            out["stop"].append(first + b + unit.length)
    return pd.DataFrame(out).astype({"begin": "int32", "stop": "int32", "id": "int64", "key": "int64"})


def suffix_array_dedup(docs: DataFrame, length: int = LENGTH, group_size: int = GROUP_SIZE,
                       carry: tuple[str, ...] = (), **limits: int) -> DataFrame:
    """doc_id, n (bytes), n_removed, spans (removed runs) and kept (bytes) for each row of docs,
    and the columns named in `carry` as _0, _1, ...

    `length` must be a multiple of STEP.
    """
    if length % STEP or length <= GRAM:
        raise ValueError(f"length must be a multiple of {STEP}")
    return without_repeats(docs, Unit(False, length, GRAM, _judge, False, group_size), carry, **limits)


def _decode(kept: pd.Series) -> pd.Series:
    return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))


def whole_characters(kept: Column) -> Column:
    """Text of the bytes that form whole characters."""
    return F.pandas_udf(_decode, StringType())(kept)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", F.col("n").alias("n_bytes"), "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (SELECT doc_id, unnest(range(n - 199)) AS s FROM d WHERE n >= 200),
windows AS (SELECT doc_id, s, md5(substr(x, 2 * s + 1, 400)) AS h FROM starts JOIN d USING (doc_id)),
again AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hits AS (SELECT DISTINCT doc_id, s FROM windows JOIN again USING (h)),
steps AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS p FROM hits),
runs AS (SELECT doc_id, s, sum(CASE WHEN p IS NULL OR s > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM steps),
gaps AS (SELECT doc_id, r, min(s) AS a, max(s) + 200 AS b FROM runs GROUP BY doc_id, r),
parts AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM gaps),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
                string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
         FROM parts JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
