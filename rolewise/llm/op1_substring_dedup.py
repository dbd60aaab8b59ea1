"""Substring dedup: remove every word inside a run of `length` words that also starts in a document with a smaller doc_id.

Words are `[^\\x20\\x09-\\x0D]+`, unchanged.  Candidate passages reach shards by content (`passages`).  A shard is a
compressed FM-index: the Burrows-Wheeler transform of its passages in a wavelet matrix of packed bits, a suffix array,
and range minima of the passages' document ids.  Each passage is streamed against it by backward search; a match counts
while its interval holds a smaller document id.  A search from place e back to the place p where it fails is a matching
statistic: no run over [p, e) counts, so the next start is p + 1, and most places are never visited.  Found stretches are
tried in longer steps.  Many passages are searched in lockstep.

Null and empty texts have no words and lose none; a null doc_id counts as the largest; equal doc_ids lose nothing to each
other.  Input columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .passages import Unit, without_repeats
from .stage import table
from .text import dense, order_of, word_hashes, words

LENGTH = 50
GRAM = 16
GROUP_SIZE = 256 << 10           # words of one gram that a shard holds
LEAP = 16                        # a found stretch is tried this many words further at once


class Wavelet:
    """Wavelet matrix: rank of a symbol before any place, one packed bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.bits = max(1, int(largest).bit_length())
        self.levels = []
        for b in range(self.bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            pad = np.zeros(-len(bit) % 64 + 64, np.uint8)
            packed = np.packbits(np.concatenate([bit.astype(np.uint8), pad]), bitorder="little").view(np.uint64)
            before = np.zeros(len(packed), np.int32)
            before[1:] = np.cumsum(np.bitwise_count(packed[:-1]))
            zeros = int(len(bit) - bit.sum())
            self.levels.append((b, packed, before, zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol occurs before left and before right."""
        base = np.zeros(len(left), np.int64)
        for b, packed, before, zeros in self.levels:
            one = ((symbol >> b) & 1).astype(bool)
            ends = []
            for x in (base, left, right):
                ones = before[x >> 6] + np.bitwise_count(packed[x >> 6] & ((np.uint64(1) << (x & 63).astype(np.uint64)) - np.uint64(1)))
                ends.append(np.where(one, zeros + ones, x - ones))
            base, left, right = ends
        return left - base, right - base


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the length that decides."""
    n, rank, ahead = len(text), dense(text) + 1, 1
    order = order_of(rank)
    while ahead < n and rank.max() < n:
        follows = np.zeros(n, np.int64)
        follows[:-ahead] = rank[ahead:]
        order = order_of(follows)
        order = order[order_of(rank[order])]
        a, b = rank[order], follows[order]
        fresh = np.ones(n, np.int64)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        ahead *= 2
    return order


class Index:
    """FM-index of passages of words, each with the id of its document.  Symbol 0 stands before each passage."""

    def __init__(self, passages: list[np.ndarray], ids: np.ndarray):
        sizes = np.array([len(p) for p in passages])
        self.begin = np.cumsum(np.concatenate([[0], sizes[:-1] + 1])) + 1
        self.text = np.zeros(int((sizes + 1).sum()) + 1, np.int64)
        self.text[np.arange(len(self.text) - 1 - len(passages)) + np.repeat(np.arange(1, len(passages) + 1), sizes)] = np.concatenate(passages)
        order = suffix_array(self.text)
        self.wavelet = Wavelet(self.text[order - 1], int(self.text.max()))
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(self.text))])
        owner = np.append(np.repeat(ids, sizes + 1), np.iinfo(np.int64).max)
        self.ids = np.unique(owner)
        self.least = [np.searchsorted(self.ids, owner[order]).astype(np.int32)]      # minima over 1, 2, 4, ... suffixes
        while len(self.least[-1]) > (1 << (len(self.least) - 1)):
            span, m = 1 << (len(self.least) - 1), self.least[-1]
            self.least.append(np.minimum(m, np.append(m[span:], np.full(span, len(self.ids) - 1, np.int32))))
        self.flat = np.concatenate(self.least)
        self.least = self.least[:1]

    def least_id(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        level = np.frexp((right - left).astype(float))[1] - 1
        n = len(self.least[0])
        return self.ids[np.minimum(self.flat[level * n + left], self.flat[level * n + right - (1 << level)])]

    def extend(self, symbol: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with one more symbol in front."""
        a, b = self.wavelet.rank(symbol, left, right)
        return self.smaller[symbol] + a, self.smaller[symbol] + b

    def windows_elsewhere(self, ids: np.ndarray, sizes: np.ndarray, length: int, leap: int = LEAP) -> list[np.ndarray]:
        """For each passage the starts of its windows that occur in a passage of a smaller id."""
        n = len(self.text)
        start = np.zeros(len(ids), np.int64)                      # of the window that is tried
        extra = np.zeros(len(ids), np.int64)                      # words that the try goes beyond it
        last = sizes - length
        at, stop = np.full(len(ids), length), np.full(len(ids), length)
        left, right = np.zeros(len(ids), np.int64), np.full(len(ids), n)
        leaps = np.full(len(ids), leap)
        marks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        live = np.flatnonzero(last >= 0)
        while len(live):
            symbol = self.text[self.begin[live] + at[live] - 1]
            a, b = self.extend(symbol, left[live], right[live])
            good = a < b
            good[good] = self.least_id(a[good], b[good]) < ids[live[good]]
            at[live] -= good
            left[live], right[live] = a, b
            won, lost = live[good & (at[live] == start[live])], live[~good]
            if len(won):
                marks.append((won, start[won], stop[won] - length))
                start[won] = stop[won] - length + 1
                extra[won] = leaps[won]
            if len(lost):
                leapt = extra[lost] > 0                           # the long try failed at `at`: shorter ones may do
                leaps[lost] = np.where(leapt, extra[lost] // 2, leap)
                start[lost] = np.where(leapt, start[lost], at[lost])
                extra[lost] = np.where(leapt, extra[lost] // 2, 0)
            again = np.concatenate([won, lost])
            if len(again):
                extra[again] = np.minimum(extra[again], np.maximum(last[again] - start[again], 0))
                stop[again] = start[again] + length + extra[again]
                at[again], left[again], right[again] = stop[again], 0, n
            live = live[start[live] <= last[live]]
        out: list[list[np.ndarray]] = [[] for _ in ids]
        for who, a, b in marks:
            for w, x, y in zip(who, a, b):
                out[w].append((x, y + length))
        return out


def _judge(pdf: pd.DataFrame, unit: Unit) -> pd.DataFrame:
    bodies = pdf["body"].tolist()
    offsets = np.cumsum([0, *map(len, bodies)])
    data = np.frombuffer(b"".join(bodies), np.uint8)
    starts, stops, per_row = words(data, offsets)
    symbols = dense(word_hashes(data, starts, stops)) + 1
    passages = np.split(symbols, per_row[1:-1])
    ids = pdf["id"].to_numpy()
    found = Index(passages, ids).windows_elsewhere(ids, np.diff(per_row), unit.length)
    rows = [(i, k, f + a, f + b) for i, k, f, spans in zip(ids, pdf["key"], pdf["first"], found) for a, b in spans]
    return pd.DataFrame(rows, columns=["id", "key", "begin", "stop"]).astype({"id": "int64", "key": "int64", "begin": "int32", "stop": "int32"})


def substring_dedup(docs: DataFrame, length: int = LENGTH, group_size: int = GROUP_SIZE,
                    carry: tuple[str, ...] = (), **limits: int) -> DataFrame:
    """doc_id, n (words), n_removed, spans (removed runs of words) and kept (bytes) for each row of docs,
    and the columns named in `carry` as _0, _1, ..."""
    if length <= GRAM:
        raise ValueError(f"length must be above {GRAM}")
    return without_repeats(docs, Unit(True, length, GRAM, _judge, True, group_size), carry, **limits)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", F.col("n").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (SELECT doc_id, s, md5(array_to_string(w[s + 1:s + 50], ' ')) AS h
            FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS s FROM d WHERE len(w) >= 50)),
least AS (SELECT h, min(doc_id) AS m FROM windows GROUP BY h HAVING count(*) > 1),
hits AS (SELECT DISTINCT doc_id, s FROM windows JOIN least USING (h) WHERE doc_id > m),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM hits),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body, count(*) AS n FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
