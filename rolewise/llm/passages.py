"""Repeated passages of a fixed length: the Spark side shared by the two operators on them.

Every window of `length` symbols (bytes or words) has one place in it, its least k-gram, that follows from its content
alone.  So equal windows meet under one `gram`, and only grams that occur twice need a closer look:

1. one scan gives the runs of windows with one place, a few per hundred symbols, each with a hash of its whole content;
2. runs whose gram occurs once go.  Equal runs (same gram and content) become one entry of the index with its count and
   its first document, so a passage in a third of all rows is one entry;
3. entries whose gram has several contents are cut out of the texts and dealt to shards by gram; a shard indexes its
   entries and reports which windows occur in others.  A gram with more text than a shard may hold is split by window
   offset: each half has a longer stretch in common, whose hash is its new group, so no shard grows with a hot passage;
4. stretches come back to the texts, which are cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .stage import discard, shards, staged
from .text import BYTE_VALUE, Rolling, lists, minimizers, mix, slices, utf8, word_hashes, words

NO_ID = (1 << 63) - 1            # stands for a null doc_id, so null counts as the largest
SHARD_BYTES = 512 << 10          # text that one shard indexes at a time
PACKED_BYTES = 512 << 10         # compressed texts that a task unpacks at a time

SCAN = "id long, key long, gram array<long>, context array<long>, first array<int>, last array<int>, lead array<int>"
ENTRY = "grp long, size long, m int, id long, n long, key long, first int, lead int, lo int, hi int, body binary"
SPAN = "id long, key long, begin int, stop int"
CUT = "doc_id long, n long, n_removed long, spans array<struct<begin:int,stop:int>>, kept binary"
_ENTRY_KINDS = dict(grp=pa.int64(), size=pa.int64(), m=pa.int32(), id=pa.int64(), n=pa.int64(), key=pa.int64(),
                    first=pa.int32(), lead=pa.int32(), lo=pa.int32(), hi=pa.int32(), body=pa.binary())


@dataclass(frozen=True)
class Unit:
    """What a symbol is, how long windows are, and how a shard judges its entries."""

    words: bool                                               # symbols are words, else bytes
    length: int
    k: int
    judge: Callable[[pd.DataFrame, "Unit"], pd.DataFrame]     # entries of a shard -> spans
    other_document: bool                                      # a window counts only if a smaller id has it
    group_size: int                                           # a group of more symbols is split by window offset

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.words:
            return BYTE_VALUE[data], offsets
        starts, stops, per_row = words(data, offsets)
        return word_hashes(data, starts, stops), per_row

    def cut(self, body: bytes, parts: list[bytes] | None, begin: int, stop: int) -> bytes:
        return b" ".join(parts[begin:stop]) if self.words else body[begin:stop]


def keyed(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id with null as the largest, a key that tells rows of one doc_id apart unless they are equal, the carried
    columns as _0, _1, ..., and text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("doc_id", "text").alias("key"),
                       *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carry)], F.col("text").cast("string").alias("text"))


def _scan(unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = minimizers(*unit.symbols(*utf8(batch.column("text"))), unit.length, unit.k)
            offsets = np.searchsorted(found["row"], np.arange(batch.num_rows + 1))
            cols = [lists(offsets, found[n].view(np.int64), pa.int64()) for n in ("gram", "context")]
            cols += [lists(offsets, found[n].astype(np.int32), pa.int32()) for n in ("first", "last", "lead")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), *cols],
                                             ["id", "key", "gram", "context", "first", "last", "lead"])
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed before they are shuffled."""
    zip_ = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches):
        texts = [zip_.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(texts, pa.binary())], [*rest, "z"])


def packed(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, key, the carried columns as _0, _1, ..., and z, the compressed text (null as empty)."""
    rows = keyed(docs, carry)
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "text")
    return rows.mapInArrow(_pack, f"{schema}, z binary")


def _entries(unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in slices(batches, "z", PACKED_BYTES):
            for row in batch.to_pylist():
                body = unzip.decompress(row["z"])
                parts = body.split() if unit.words else None
                out: dict[str, list] = {n: [] for n in _ENTRY_KINDS}
                for e in row["entries"]:
                    for name, value in (("grp", e["gram"]), ("size", e["size"]), ("m", e["last"] - e["first"] + unit.length), ("id", row["id"]), ("n", e["n"]), ("key", row["key"]),
                                        ("first", e["first"]), ("lead", e["lead"]), ("lo", 0), ("hi", unit.length - unit.k),
                                        ("body", unit.cut(body, parts, e["first"], e["last"] + unit.length))):
                        out[name].append(value)
                yield _entry_batch(out)
    return run


def _entry_batch(out: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in _ENTRY_KINDS.items()], list(_ENTRY_KINDS))


def _halve(unit: Unit):
    """Each entry of a large group twice: for the windows that begin far before the gram and for those near it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in _ENTRY_KINDS}
            for e in batch.to_pylist():
                parts = e["body"].split() if unit.words else None
                size = len(parts) if unit.words else len(e["body"])
                middle = (e["lo"] + e["hi"]) // 2
                for lo, hi in ((e["lo"], middle), (middle + 1, e["hi"])):
                    begin, end = max(0, e["lead"] - hi), min(size - unit.length, e["lead"] - lo)
                    if lo > hi or begin > end:
                        continue
                    common = unit.cut(e["body"], parts, e["lead"] - lo, e["lead"] + unit.length - hi)
                    data = np.frombuffer(common, np.uint8)
                    tag = np.array([e["grp"] & (1 << 64) - 1, lo * 65537 + hi], np.uint64)
                    value = Rolling(np.concatenate([mix(tag), BYTE_VALUE[data]])).of(np.array([0]), np.array([len(data) + 2]))
                    for name, v in (("grp", int(value.view(np.int64)[0])), ("size", 0), ("m", end - begin + unit.length), ("id", e["id"]), ("n", e["n"]), ("key", e["key"]),
                                    ("first", e["first"] + begin), ("lead", e["lead"] - begin), ("lo", lo), ("hi", hi),
                                    ("body", unit.cut(e["body"], parts, begin, end + unit.length))):
                        out[name].append(v)
            yield _entry_batch(out)
    return run


def _split_large(entries: DataFrame, unit: Unit) -> tuple[DataFrame, DataFrame]:
    """Entries in groups that one shard can hold, and those whose large group is one single window."""
    fits, single = F.col("size") <= unit.group_size, F.col("lo") == F.col("hi")
    small, windows, large = entries.filter(fits), entries.filter(~fits & single), entries.filter(~fits & ~single)
    while not large.isEmpty():
        halves = staged(large.mapInArrow(_halve(unit), ENTRY)).drop("size")
        sizes = staged(halves.groupBy("grp").agg(F.sum("m").alias("size"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c"))
        halves = staged(halves.join(sizes, "grp"))
        small, windows = small.unionByName(halves.filter(fits)), windows.unionByName(halves.filter(~fits & single))
        large = halves.filter(~fits & ~single)
    return small, windows


def spans(docs: DataFrame, unit: Unit, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Stretches (id, key, begin, stop) of repeated windows; they may overlap."""
    spark = docs.sparkSession
    scan = staged(keyed(docs).mapInArrow(_scan(unit), SCAN))
    runs = scan.select(
        "id", "key", F.inline(F.arrays_zip("gram", "context", "first", "last", "lead")))
    again = staged(runs.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"))
    live = staged(runs.join(again, "gram", "left_semi"))
    discard(scan, again)
    index = staged(live.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "key", "first", "last", "lead")).alias("o"))
        .select("gram", "context", "n", "o.*"))
    length = F.lit(unit.length)
    known = index.filter("n > 1").select("gram", "context", F.col("id").alias("least"))
    whole = live.join(known, ["gram", "context"])
    if unit.other_document:
        whole = whole.filter("id > least")
    found = whole.select("id", "key", F.col("first").alias("begin"), (F.col("last") + length).alias("stop"))
    several = staged(index.groupBy("gram").agg(F.count(F.lit(1)).alias("c"), F.sum(F.col("last") - F.col("first") + length).alias("size"))
                     .filter("c > 1").select("gram", "size"))
    wanted = index.join(several, "gram").groupBy("id", "key").agg(
        F.collect_list(F.struct("gram", "size", "n", "first", "last", "lead")).alias("entries"))
    whole_entries = entries = staged(packed(docs).join(wanted, ["id", "key"]).mapInArrow(_entries(unit), ENTRY))
    discard(several)
    amount = entries.agg(F.sum(F.length("body"))).first()[0] or 0
    entries, windows = _split_large(entries, unit)
    judged = entries.groupBy(F.pmod("grp", F.lit(shards(spark, amount, shard_bytes))).alias("shard")).applyInPandas(
        lambda pdf: unit.judge(pdf, unit), SPAN)
    totals = windows.groupBy("grp").agg(F.sum("n").alias("total"), F.min("id").alias("least"))
    same = windows.join(totals, "grp").filter("id > least" if unit.other_document else "total > 1")
    found = staged(found.unionByName(judged).unionByName(
        same.select("id", "key", F.col("first").alias("begin"), (F.col("first") + length).alias("stop"))))
    discard(live, index, whole_entries)
    return found


def _remove(unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in slices(batches, "z", PACKED_BYTES):
            out: dict[str, list] = {n: [] for n in ("doc_id", "n", "n_removed", "spans", "kept")}
            for id_, z, spans_ in zip(*(batch.column(c).to_pylist() for c in ("id", "z", "spans"))):
                body = unzip.decompress(z)
                parts = body.split() if unit.words else None
                n = len(parts) if unit.words else len(body)
                at, kept, gaps = 0, [], []
                for s in sorted(spans_ or [], key=lambda s: s["begin"]):
                    if gaps and s["begin"] <= gaps[-1][1]:
                        gaps[-1][1] = max(gaps[-1][1], s["stop"])
                    else:
                        gaps.append([s["begin"], s["stop"]])
                for begin, stop in gaps:
                    kept.append(unit.cut(body, parts, at, begin))
                    at = stop
                kept.append(unit.cut(body, parts, at, n))
                out["doc_id"].append(None if id_ == NO_ID else id_)
                out["n"].append(n)
                out["n_removed"].append(sum(b - a for a, b in gaps))
                out["spans"].append([{"begin": a, "stop": b} for a, b in gaps])
                out["kept"].append(b" ".join(x for x in kept if x) if unit.words else b"".join(kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32())])), pa.binary())
            rest = [c for c in batch.schema.names if c not in ("id", "key", "z", "spans")]
            yield pa.RecordBatch.from_arrays([*[pa.array(v, t) for v, t in zip(out.values(), kinds)], *[batch.column(c) for c in rest]],
                                             [*out, *rest])
    return run


def without_repeats(docs: DataFrame, unit: Unit, carry: tuple[str, ...] = (), **limits: int) -> DataFrame:
    """One row for each row of docs: doc_id, n (symbols), n_removed, spans (maximal removed runs), kept (bytes), and the
    carried columns as _0, _1, ..."""
    found = spans(docs, unit, **limits).groupBy("id", "key").agg(F.collect_set(F.struct("begin", "stop")).alias("spans"))
    rows = packed(docs, carry).join(found, ["id", "key"], "left")
    rest = "".join(f", {c} {t}" for c, t in rows.dtypes if c.startswith("_"))
    return rows.mapInArrow(_remove(unit), CUT + rest)
