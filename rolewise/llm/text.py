"""Whole Arrow batches of text at a time: bytes, words, hashes of any substring, window minimizers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1                    # odd, so powers have inverses modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 1 << 20                            # texts are worked on in slices of about this size
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
NOT_SPACE = ~SPACE                               # [^\x20\x09-\x0D]+ ; bytes from 0x80 on belong to words
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20                         # A-Z only


def _mix_table() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUE = _mix_table()
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1024)
        have = np.ones(size, U64)
        have[1:] = U64(base)
        have = np.cumprod(have, dtype=U64)
        if size <= 8 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


class Rolling:
    """Hash of any stretch of a sequence of 64-bit values in constant time."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * powers(BASE, len(values)), out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        raw = (self.sums[stops] - self.sums[starts]) * powers(INVERSE, len(self.sums))[starts]
        return mix(raw + (stops - starts).astype(U64) * U64(0xA0761D6478BD642F))

    def every(self, width: int) -> np.ndarray:
        """Hashes of all stretches of one width, by start."""
        n = len(self.sums) - 1 - width + 1
        if n <= 0:
            return np.zeros(0, U64)
        return mix((self.sums[width:] - self.sums[:n]) * powers(INVERSE, n))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    body = column.buffers()[2]
    if body is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts sum to about `size` bytes; a longer text stays whole."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, begin = np.cumsum(lengths), 0
        while begin < batch.num_rows:
            done = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE):
    """Starts and stops of the words in bytes, and for each row the number of words before it."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | border[1:-1]
    stop[:-1] &= ~inside[1:] | border[1:-1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    return Rolling(BYTE_VALUE[data]).of(starts, stops)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each stretch of `width` values, by start."""
    if len(values) < width:
        return values[:0]
    span, least = 1, values
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    n = len(values) - width + 1
    return np.minimum(least[:n], least[width - span:width - span + n])


def minimizers(values: np.ndarray, offsets: np.ndarray, length: int, k: int) -> dict[str, np.ndarray]:
    """Windows of `length` values of one row, gathered by the place of their least k-gram.

    The place follows from a window's content alone, so equal windows have it at the same distance from their start.
    A row of the result is a run of windows with one place: `row`, the `first` and `last` start (from the row's begin),
    `gram` (hash of the k-gram), `context` (hash of all values the run covers and of where the k-gram lies in them),
    `lead` (distance of the k-gram from `first`).
    """
    empty = {n: np.zeros(0, np.int64) for n in ("row", "first", "last", "lead")} | {n: np.zeros(0, U64) for n in ("gram", "context")}
    if len(values) < length:
        return empty
    rolling = Rolling(values)
    grams = rolling.every(k)
    bits = max(1, int(len(grams)).bit_length())
    keys = (grams >> U64(bits) << U64(bits)) | np.arange(len(grams), dtype=U64)
    place = (sliding_min(keys, length - k + 1) & U64((1 << bits) - 1)).astype(np.int64)
    sizes = np.diff(offsets)
    whole = np.flatnonzero(sizes >= length)
    if not len(whole):
        return empty
    lengths = sizes[whole] - length + 1
    ends = np.cumsum(lengths)
    starts = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(offsets[whole], lengths)
    row = np.repeat(whole, lengths)
    at = place[starts]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    first, last, at, row = starts[head], starts[tail], at[head], row[head]
    context = mix(rolling.of(first, last + length) + (at - first).astype(U64) * U64(0xE7037ED1A0B428DB))
    return {"row": row, "first": first - offsets[row], "last": last - offsets[row], "lead": at - first,
            "gram": grams[at], "context": context}


def covered(n: int, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the stretches."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, stops, -1)
    return np.cumsum(edge[:-1]) > 0


def sha256(body: bytes) -> str:
    return hashlib.sha256(body).hexdigest()


def lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column from row offsets and values."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def dense(values: np.ndarray) -> np.ndarray:
    """Ranks of the values, without gaps."""
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def order_of(ranks: np.ndarray) -> np.ndarray:
    """Stable order of small whole numbers; 16 bits at a time, which numpy sorts by radix."""
    order = np.argsort((ranks & 0xFFFF).astype(np.uint16), kind="stable")
    high, shift = int(ranks.max(initial=0)) >> 16, 16
    while high:
        order = order[np.argsort(((ranks >> shift) & 0xFFFF).astype(np.uint16)[order], kind="stable")]
        high, shift = high >> 16, shift + 16
    return order
