"""Mixing sources to target weights: blocks of words, multinomial draws for each output shard, pseudorandom permutations.

Sizes are numbers of words (`[^\\x20\\x09-\\x0D]+`; null: 0).  Sources in code point order, null last, weigh 5, 2, 1, repeating.
Targets share all words by weight, stop at REPEAT times a source's size, and what is above is shared again.

The words of a source are one stream (documents in an order that follows from their ids), packed into blocks of `block`
words.  Output shards hold `SLOTS` slots of a block each; a shard draws how many go to each source: the whole part of the
expected number, and a multinomial draw, seeded by the shard, for the rest.  The slots of a source are numbered through
all shards; slot t takes block p(t mod blocks), where p is a keyed permutation of the source's blocks, another for each
round t div blocks.  So a round takes each block once, no block comes more often than REPEAT times, and a rerun agrees.
Documents are cut at the blocks' borders, the pieces of a block are put together, and slots and blocks meet by a join on
(source, block): `corpus` has the text of each output slot.  A piece keeps its white space, pieces are parted by a line break.

Running totals are taken in two levels, so a source that holds a third of all rows is many tasks.  Slots and texts are
written and joined by shuffles; only a size and a share for each source are held whole (16 bytes a source).  Null and
empty texts have size 0 and are never taken; a null source is a source; repeated rows are separate documents; a very long
text is cut into many blocks; ties in the order are rows that are equal in all columns.  An empty table, or one without a
word, gives an empty mix.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .numbering import numbered
from .stage import discard, staged, table
from .text import SLICE_BYTES, mix as mixed_bits, slices, utf8, words

BLOCK = 32
SLOTS = 4096
REPEAT = 3
WEIGHTS = (5.0, 2.0, 1.0)
BUCKET_ROWS = 20_000
PACK = 64                   # blocks that travel together
PACKS_AT_ONCE = 32          # handled in one piece


def _starts(df: DataFrame, group: str, bucket: Column, order: list, value: str) -> DataFrame:
    """Running total before each row within its group, in the order of (bucket, order), as `start`; `seq` numbers the
    rows of a bucket."""
    df = df.withColumn("bucket", bucket)
    inside = Window.partitionBy(group, "bucket").orderBy(*order)
    df = df.withColumns({"seq": F.row_number().over(inside),
                         "start": F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value)})
    totals = df.groupBy(group, "bucket").agg(F.sum(value).alias("total"))
    before = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(group, "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return df.join(totals, [group, "bucket"]).withColumn("start", (F.col("start") + F.col("base")).cast("long")).drop("base")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, repeat: int = REPEAT) -> DataFrame:
    """src (number in order), source, source_size, n_docs, target; written."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    sources = numbered(sources.withColumn("all", F.lit(0)), "all", [F.col("source").asc_nulls_last()],
                       sources.sparkSession.sparkContext.defaultParallelism).withColumnRenamed("pos", "src").drop("all", "n")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int"))
    sources = staged(sources.withColumn("weight", weight))
    most = F.col("source_size") * float(repeat)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, -1.0
    while total and level != before:           # words for each unit of weight; rises while sources reach their most
        before, full = level, most < F.col("weight") * level
        used, free = sources.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        level = (total - (used or 0.0)) / free if free else before
    return staged(sources.withColumn("target", F.least(most, F.col("weight") * F.lit(float(level)))).drop("weight"))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed permutations of 0..n-1: four Feistel rounds on the next power of four, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo]
        left, right = x >> h, x & m
        for turn in range(4):
            left, right = right, left ^ (mixed_bits(right + k + np.uint64(turn * 0x632BE59B)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _draw(share: np.ndarray, n_slots: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard in pdf["shard"]:
                slots = min(SLOTS, n_slots - shard * SLOTS)
                count = np.floor(slots * share).astype(np.int64)
                rest = np.maximum(slots * share - count, 0)
                left = int(slots - count.sum())
                if left > 0 and rest.sum() > 0:
                    count += np.random.default_rng([seed, shard]).multinomial(left, rest / rest.sum())
                some = np.flatnonzero(count)
                yield pd.DataFrame({"shard": shard, "src": some, "count": count[some]})
    return run


def _place(blocks: np.ndarray, repeat: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), 64):
                part = pdf.iloc[a:a + 64]
                count = part["count"].to_numpy()
                src = np.repeat(part["src"].to_numpy(), count)
                slot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(part["start"].to_numpy(), count)
                shard = np.repeat(part["shard"].to_numpy(), count)
                keep = slot < repeat * blocks[src]
                src, slot, shard = src[keep], slot[keep], shard[keep]
                key = mixed_bits(src.astype(np.uint64) * np.uint64(0x9E3779B9) + (slot // blocks[src]).astype(np.uint64) + np.uint64(seed))
                yield pd.DataFrame({"shard": shard, "src": src, "slot": slot, "block": permuted(slot % blocks[src], blocks[src], key)})
    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each text counted, the text compressed."""
    squeeze = zstandard.ZstdCompressor().compress
    for batch in slices(batches):
        data, offsets = utf8(batch.column("text"))
        size, body, at = np.diff(words(data, offsets)[2]), data.tobytes(), offsets.tolist()
        yield pa.RecordBatch.from_arrays([*batch.select(["row", "doc_id", "source", "key"]).columns, pa.array(size, pa.int64()),
                                          pa.array([squeeze(body[x:y]) for x, y in zip(at, at[1:])], pa.binary())],
                                         ["row", "doc_id", "source", "key", "size", "packed"])


def _sized(docs: DataFrame) -> DataFrame:
    """row (its number), doc_id, source, packed text, its size and a key of it for each row, written."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return staged(named.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "text", F.xxhash64("text").alias("key")).mapInArrow(
        _packed, "row long, doc_id long, source string, key long, size long, packed binary"))


def _stream(sized: DataFrame, sources: DataFrame, n_buckets: int) -> DataFrame:
    """Rows without their text, with src and start.  Rows that are equal in all columns are the only ties of the order."""
    known = sources.select("src", F.col("source").alias("_source"))
    stream = sized.select("row", "doc_id", "source", "size", "key").join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = _starts(stream, "src", F.pmod(F.xxhash64("doc_id", "size"), F.lit(n_buckets)), ["doc_id", "size", "key", "row"], "size")
    return placed.drop("key", "bucket", "seq")


@dataclass
class Mix:
    """Written tables.  texts: row, packed text, size; stream: row, doc_id, source, size, src, start (place in the source's stream); sources
    (targets); slots: shard, src, slot, block: which block of which source each output slot takes."""
    texts: DataFrame
    stream: DataFrame
    sources: DataFrame
    slots: DataFrame


def mix(docs: DataFrame, block: int = BLOCK, weights: tuple = WEIGHTS, repeat: int = REPEAT, seed: int = 17) -> Mix:
    """Plan of the mix.  The driver holds one size and one share for each source, no slot and no document."""
    spark = docs.sparkSession
    sized = _sized(docs)
    sources = targets(sized, weights, repeat)
    known = sources.select("source_size", "n_docs", "target").orderBy("src").toPandas()
    size = known["source_size"].to_numpy(float)
    blocks = np.maximum(1, np.ceil(size / block)).astype(np.int64)
    wanted = np.divide(known["target"].to_numpy(float), size, out=np.zeros(len(known)), where=size > 0) * blocks
    n_slots = int(round(wanted.sum()))
    drawn = staged(spark.range(-(-n_slots // SLOTS)).withColumnRenamed("id", "shard").mapInPandas(
        _draw(wanted / max(wanted.sum(), 1e-300), n_slots, seed), "shard long, src long, count long"))
    counted = _starts(drawn, "src", F.floor(F.col("shard") / SLOTS), ["shard"], "count")
    slots = staged(counted.mapInPandas(_place(blocks, repeat, seed), "shard long, src long, slot long, block long"))
    discard(drawn)
    return Mix(sized, staged(_stream(sized, sources, int(known["n_docs"].sum()) // BUCKET_ROWS + 1)), sources, slots)


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of packed texts and the offsets of the texts in them."""
    open_up = zstandard.ZstdDecompressor().decompress
    texts = [open_up(x) for x in column.to_pylist()]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _parts(data: np.ndarray, offsets: np.ndarray, start: np.ndarray, width: int):
    """Texts whose words stand from `start` on in a stream, cut every `width` words: row, number of the stretch, place and
    number of the part's words, its bytes."""
    begin, stop, per_row = words(data, offsets)
    first = start // width
    n = (start + np.diff(per_row) - 1) // width - first + 1
    row = np.repeat(np.arange(len(start)), n)
    number = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    low = per_row[row] + np.maximum(number * width - start[row], 0)
    high = np.minimum(per_row[row] + (number + 1) * width - start[row], per_row[row + 1])
    body = data.tobytes()
    return row, number, start[row] + low - per_row[row], high - low, [body[a:b] for a, b in zip(begin[low].tolist(), stop[high - 1].tolist())]


def _cut(width: int):
    """Each text as packed parts: the words of it that lie in one pack of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor().compress
        for batch in slices(batches, "packed", SLICE_BYTES // 2):
            row, number, begin, count, texts = _parts(*_unpacked(batch.column("packed")), batch.column("start").to_numpy(zero_copy_only=False), width)
            picked = batch.select(["src", "row", "doc_id"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(number), pa.array(begin), pa.array(count), pa.array(map(squeeze, texts), pa.binary())],
                                             ["src", "row", "doc_id", "pack", "begin", "words", "packed"])
    return run


def _deal(block: int):
    """The slots of each pack with the text of their block, and the documents in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, PACKS_AT_ONCE):
                batch = whole.slice(a, PACKS_AT_ONCE)
                parts, of = batch.column("parts").flatten(), pc.list_parent_indices(batch.column("parts")).to_numpy()
                begin, doc, of_row = (parts.field(c) for c in ("begin", "doc_id", "row"))
                row, number, _, count, texts = _parts(*_unpacked(parts.field("packed")), begin.to_numpy(), block)
                key = list(zip(of[row].tolist(), number.tolist()))
                held = {}
                for i, k in enumerate(key):
                    held.setdefault(k, []).append(i)
                slots, of_slot = batch.column("slots").flatten(), pc.list_parent_indices(batch.column("slots"))
                mine = [held[k] for k in zip(of_slot.to_pylist(), slots.field("block").to_pylist())]
                flat = np.array([i for m in mine for i in m], np.int64)
                ends = np.concatenate([[0], np.cumsum([len(m) for m in mine])]).astype(np.int32)
                pieces = pa.StructArray.from_arrays([of_row.take(pa.array(row[flat])), doc.take(pa.array(row[flat])), pa.array(count[flat])],
                                                    ["row", "doc_id", "words"])
                yield pa.RecordBatch.from_arrays([
                    slots.field("shard"), slots.field("slot"), batch.column("src").take(of_slot), slots.field("block"),
                    pa.array([b"\n".join([texts[i] for i in m]) for m in mine], pa.binary()).cast(pa.string()), pa.ListArray.from_arrays(pa.array(ends), pieces)],
                    ["shard", "slot", "src", "block", "text", "pieces"])
    return run


def _corpus(plan: Mix, block: int) -> DataFrame:
    """Slots and blocks meet by a shuffle: both grow with the input, so neither is broadcast.  PACK neighbouring blocks
    travel together, as compressed parts of documents, to the slots that take one of them."""
    texts = plan.texts.filter("size > 0").select("row", "packed").hint("merge").join(plan.stream.select("row", "src", "doc_id", "start"), "row")
    parts = texts.select("src", "row", "doc_id", "start", "packed").mapInArrow(
        _cut(block * PACK), "src long, row long, doc_id long, pack long, begin long, words long, packed binary")
    packs = parts.groupBy("src", "pack").agg(F.sort_array(F.collect_list(F.struct("begin", "row", "doc_id", "words", "packed"))).alias("parts"))
    asked = plan.slots.groupBy("src", F.floor(F.col("block") / PACK).cast("long").alias("pack")).agg(F.collect_list(F.struct("shard", "slot", "block")).alias("slots"))
    dealt = asked.hint("merge").join(packs, ["src", "pack"]).mapInArrow(
        _deal(block), "shard long, slot long, src long, block long, text string, pieces array<struct<row:long,doc_id:long,words:long>>")
    return dealt.join(plan.sources.select("src", "source"), "src")


def corpus(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """The mixed corpus, a row for each output slot: shard, slot (numbered by source), src, source, block, text, and
    pieces (doc_id and words of the documents in it; `row` tells repeated rows apart)."""
    return _corpus(mix(docs, block, **options), block)


def taken(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words of the document in the mix) for each row of docs,
    counted in the written corpus."""
    plan = mix(docs, block, **options)
    written = staged(_corpus(plan, block))
    sums = staged(written.select(F.inline("pieces")).groupBy("row").agg(F.sum("words").alias("taken")))
    discard(written, plan.texts, plan.slots)
    return plan.stream.join(sums, "row", "left").join(plan.sources.select("src", "source_size", "target"), "src").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("source")
