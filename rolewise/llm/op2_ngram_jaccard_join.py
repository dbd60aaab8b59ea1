"""N-gram Jaccard join: documents whose sets of word shingles overlap by a given share, by R-trees of count vectors.

A-Z is lower-cased, words are `[^\\x20\\x09-\\x0D]+`, a set holds the distinct shingles of `WORDS` words (all words as one if
there are fewer).  Two sets link when 100 * intersection >= percent * union.

1. Equal sets are one class, whatever their number; only classes are compared.
2. In any order of all shingles two linked sets share at least min(c, c') among their first n - ceil(percent * n) + c,
   where c is EXTRA percent of a set's size, 1 at least.  So a class goes that shares fewer of these with other classes
   than the c of its smallest possible partner; twice, because fewer classes share less.  The order is by hash, with shingles that are seen to be frequent last (a hint that changes the work, never the result).  A class
   belongs to the family of the least such shingle that it shares with any class.  Linked classes are of one family, or
   their families meet under a shingle that both have; shingles under which the same families meet count once.
3. Shingles are hashed into groups, and the counts of the groups are a class's coordinates.  An R-tree keeps the largest
   coordinates and the range of sizes of each box; the sum of coordinate minima bounds the overlap, so boxes whose bound is
   below what their sizes need go.  Trees of the families' boxes leave the pairs of families that can hold a link; then trees of the classes leave the pairs that are verified on the sets.  Every pair of
   classes is judged in one task only, which returns the number of links and a spanning set of them, not the pairs.
   Families and meetings of more than BLOCK members are cut into blocks by size; pairs of blocks whose sizes can link are tasks.
4. Spanning links make components by label propagation with pointer jumping.

The result has one row for each row of docs; links are kept between classes, never expanded to copies.  Null texts and
texts without words have an empty set and no links; a null doc_id counts as the largest; repeated rows are linked copies.
Sets and shingles are told apart by 64-bit hashes.  Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .passages import NO_ID, keyed, packed
from .stage import discard, shards, staged, table
from .text import LOWER, SLICE_BYTES, Rolling, lists, mix, slices, utf8, word_hashes, words

WORDS = 5
PERCENT = 75
BLOCK = 512                      # members that a task holds on a side
EXTRA = 12                       # percent of a set by which its first shingles are more than the least number
HINTS = 200_000                  # most shingles that the order puts last
HINT_SETS, HINT_TOKENS = 30, 4 << 20   # from so many sets on; counted among so many shingles at a time
GROUPS = 32                      # least number of coordinates of a family's box
SHARD_ROWS = 1500                # rows in a shard
FAN = 16                         # children of a box
PAIR_CELLS = 1 << 21             # coordinates compared at a time

SETS = "id long, key long, n long, cls long, prefix array<long>"
LINKS = "cls long, root long, degree long"


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in ascending order, row after row, and the offsets of the rows."""
    data = LOWER[data]
    starts, stops, per_row = words(data, offsets)
    hashes, counts = word_hashes(data, starts, stops), np.diff(per_row)
    n = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), n)
    begin = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(per_row[:-1], n)
    values = Rolling(hashes).of(begin, begin + np.minimum(counts, WORDS)[row])
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[new], row[new]
    return values, np.searchsorted(row, np.arange(len(counts) + 1))


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that at least three sets among HINT_TOKENS shingles have; they are sorted in place, in one buffer."""
    buffer, size = np.empty(HINT_TOKENS + SLICE_BYTES, np.uint64), 0     # memory is taken as it fills
    for batch in _with_end(slices(batches)):
        if batch is not None:
            found = shingle_sets(*utf8(batch.column("text")))[0]
            if size + len(found) > len(buffer):                      # a longer text stays whole
                buffer = np.concatenate([buffer[:size], np.empty(len(found), np.uint64)])
            buffer[size:size + len(found)] = found
            size += len(found)
        if size and (batch is None or size >= HINT_TOKENS):
            held, size = buffer[:size], 0
            held.sort()
            often = held[2:][held[2:] == held[:-2]]                  # two less of each than there are
            values, counts = np.unique(often, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts + 2)], ["h", "n"])


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most HINTS frequent shingles in ascending order, and their places in the order of all shingles."""
    seen = keyed(docs).mapInArrow(_frequent, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = seen.filter(F.col("n") >= HINT_SETS).orderBy(F.desc("n"), "h").limit(HINTS).select("h").collect()
    values = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], (len(values) - order).astype(np.int64)      # the most frequent last


def _scan(percent: int, frequent: np.ndarray, late: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, offsets = shingle_sets(*utf8(batch.column("text")))
            n = np.diff(offsets)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)))])
            cls = mix((sums[offsets[1:]] - sums[offsets[:-1]]) + n.astype(np.uint64))
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
                place = np.repeat(np.arange(len(n)), n) * (len(frequent) + 1) + np.where(frequent[at] == values, late[at], 0)
                values = values[np.argsort(place, kind="stable")]
            first = np.where(n > 0, np.minimum(n, n - -(-n * percent // 100) + np.maximum(1, -(-n * EXTRA // 100))), 0)
            row = np.repeat(np.arange(len(n)), first)
            ends = np.cumsum(first)
            prefix = values[np.arange(len(row)) - np.repeat(ends - first, first) + np.repeat(offsets[:-1], first)]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(cls.view(np.int64)),
                lists(np.concatenate([[0], ends]), prefix.view(np.int64), pa.int64())], ["id", "key", "n", "cls", "prefix"])
    return run


class RTree:
    """Boxes (largest group counts, range of sizes), packed bottom-up: by size, then by the coordinate that varies most."""

    def __init__(self, top: np.ndarray, low: np.ndarray, high: np.ndarray):
        wide = int(np.argmax(top.std(axis=0)))
        self.order = np.lexsort((top[:, wide], low))
        self.levels = [(top[self.order], low[self.order], high[self.order])]
        while len(self.levels[-1][1]) > 1:
            top, low, high = self.levels[-1]
            cuts = np.arange(0, len(low), FAN)
            self.levels.append((np.maximum.reduceat(top, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)))

    def join(self, top: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, box) whose bound allows a link."""
        query, node = np.arange(len(low)), np.zeros(len(low), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            tops, lows, highs = self.levels[level]
            if level < len(self.levels) - 1:
                query = np.repeat(query, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                inside = node < len(lows)
                query, node = query[inside], node[inside]
            fits = (100 * highs[node] >= percent * low[query]) & (100 * high[query] >= percent * lows[node])
            query, node = query[fits], node[fits]
            good = np.ones(len(query), bool)
            step = max(1, PAIR_CELLS // top.shape[1])
            for a in range(0, len(query), step):
                q, v = query[a:a + step], node[a:a + step]
                overlap = np.minimum(top[q], tops[v]).sum(axis=1, dtype=np.int64)
                good[a:a + step] = (100 + percent) * overlap >= percent * (low[q] + lows[v])
            query, node = query[good], node[good]
        return query, self.order[node]


def _cells(flat: np.ndarray, row: np.ndarray, rows: int, groups: int) -> np.ndarray:
    cell = row * groups + (flat & np.uint64(groups - 1)).astype(np.int64)
    return np.bincount(cell, minlength=rows * groups).reshape(rows, groups).astype(np.int32)


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> list[tuple[int, np.ndarray]]:
    """For sets on the left: the sets on the right that link with them."""
    sizes = np.array([len(s) for s in left + right], np.int64)
    groups = 1 << int(np.clip(np.ceil(np.log2(np.median(sizes) / 4 + 1)), 3, 12))      # about four shingles a group
    points = _cells(np.concatenate(left + right), np.repeat(np.arange(len(sizes)), sizes), len(sizes), groups)
    k = len(left)
    who, other = RTree(points[k:], sizes[k:], sizes[k:]).join(points[:k], sizes[:k], sizes[:k], percent)
    order = np.argsort(who, kind="stable")
    who, other, out = who[order], other[order], []
    for part in np.split(np.arange(len(who)), np.flatnonzero(np.diff(who)) + 1) if len(who) else ():
        mine, good = left[who[part[0]]], []
        for some in np.array_split(other[part], len(part) // 256 + 1):
            flat = np.concatenate([right[j] for j in some])
            at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
            ends = np.cumsum([len(right[j]) for j in some])
            hits = np.concatenate([[0], np.cumsum(mine[at] == flat)])
            both = hits[ends] - hits[np.concatenate([[0], ends[:-1]])]
            good.append(some[100 * both >= percent * (len(mine) + sizes[k + some] - both)])
        out.append((int(who[part[0]]), np.concatenate(good)))
    return out


def _fold(cells: np.ndarray, groups: int) -> np.ndarray:
    """Counts in fewer groups: groups are told apart by the low bits of the hash."""
    return cells.reshape(-1, groups).sum(axis=0) if len(cells) > groups else cells


def _can_link(boxes: list[np.ndarray], low: np.ndarray, high: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of boxes allow a link, by their sizes and by the coordinate minima in the groups that both have."""
    good = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
    sizes = np.array([len(x) for x in boxes])
    groups = np.minimum(sizes[a], sizes[b])
    for g in np.unique(groups[good]):
        some = np.flatnonzero(good & (groups == g))
        used, at = np.unique(np.concatenate([a[some], b[some]]), return_inverse=True)
        cells, k = np.array([_fold(boxes[x], g) for x in used]), len(some)
        for c in range(0, k, max(1, PAIR_CELLS // int(g))):
            d = min(k, c + max(1, PAIR_CELLS // int(g)))
            overlap = np.minimum(cells[at[c:d]], cells[at[k + c:k + d]]).sum(axis=1, dtype=np.int64)
            good[some[c:d]] = (100 + percent) * overlap >= percent * (low[a[some[c:d]]] + low[b[some[c:d]]])
    return good


def _pair_families(percent: int):
    """Pairs of families under one shingle whose boxes can hold a link."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names, f = np.unique(pdf["f"].to_numpy(), return_inverse=True)
        one = np.unique(f, return_index=True)[1]
        boxes = [np.frombuffer(x, np.int32) for x in pdf["box"].to_numpy()[one]]
        low, high = pdf["low"].to_numpy()[one], pdf["high"].to_numpy()[one]
        side, pairs = pdf["side"].to_numpy(), []
        for rows in pdf.groupby(["t", "i", "j"]).indices.values():
            left, right = f[rows[side[rows] <= 0]], f[rows[side[rows] == 1]]
            if not len(right):
                right = left if (side[rows] == 0).all() else right
            if not len(left) or not len(right):
                continue
            if len(left) <= FAN and len(right) <= FAN:            # one leaf
                pairs.append((np.repeat(left, len(right)), np.tile(right, len(left))))
            else:
                g = min(len(boxes[x]) for x in np.concatenate([left, right]))
                tops = [np.array([_fold(boxes[x], g) for x in s]) for s in (left, right)]
                a, b = RTree(tops[1], low[right], high[right]).join(tops[0], low[left], high[left], percent)
                pairs.append((left[a], right[b]))
        if not pairs:
            return pd.DataFrame({"fa": [], "fb": []}, dtype="int64")
        a, b = (np.concatenate(x).astype(np.int64) for x in zip(*pairs))
        key = np.unique((np.minimum(a, b) * len(names) + np.maximum(a, b))[a != b])
        a, b = key // len(names), key % len(names)
        good = _can_link(boxes, low, high, a, b, percent)
        return pd.DataFrame({"fa": names[a[good]], "fb": names[b[good]]}, dtype="int64")
    return run


def _meet(percent: int):
    """Links of each class in the tasks of a shard: how many rows it links with, and the least class it reaches."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        unzip, sets, out = zstandard.ZstdDecompressor(), {}, []
        copies = dict(zip(pdf["cls"], pdf["copies"]))
        for cls, z in zip(pdf["cls"], pdf["z"]):
            if cls not in sets:
                body = np.frombuffer(unzip.decompress(z), np.uint8)
                sets[cls] = shingle_sets(body, np.array([0, len(body)]))[0]
        for _, task in pdf.groupby(["f", "i", "j"]):
            left = task.loc[task["side"] <= 0, "cls"].tolist()
            same = bool((task["side"] == 0).all())
            right = left if same else task.loc[task["side"] == 1, "cls"].tolist()
            degree: dict[int, int] = {}
            root = {c: c for c in left + right}

            def find(c: int) -> int:
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            for a, found in linked([sets[c] for c in left], [sets[c] for c in right], percent) if left and right else ():
                x = left[a]
                for y in (right[b] for b in found):
                    if x != y:
                        degree[x] = degree.get(x, 0) + copies[y]
                        if not same:
                            degree[y] = degree.get(y, 0) + copies[x]
                        p, q = find(x), find(y)
                        root[max(p, q)] = min(p, q)
            out += [(c, find(c), n) for c, n in degree.items()]
        return pd.DataFrame(out, columns=["cls", "root", "degree"], dtype="int64")
    return run


def _box(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    unzip = zstandard.ZstdDecompressor()
    for pdf in batches:
        cells = []
        for z in pdf["z"]:
            body = np.frombuffer(unzip.decompress(z), np.uint8)
            values = shingle_sets(body, np.array([0, len(body)]))[0]
            groups = max(GROUPS, 1 << int(len(values) // 4).bit_length())
            cells.append(_cells(values, np.zeros(len(values), np.int64), 1, groups)[0])
        yield _largest(pd.DataFrame({"f": pdf["f"], "low": pdf["n"], "high": pdf["n"], "box": [c.tobytes() for c in cells]}))


def _largest(pdf: pd.DataFrame) -> pd.DataFrame:
    """One box for each family, in as many groups as all its members have."""
    out = []
    for f, rows in pdf.groupby("f").indices.items():
        boxes = [np.frombuffer(x, np.int32) for x in pdf["box"].to_numpy()[rows]]
        g = min(map(len, boxes))
        out.append((f, pdf["low"].to_numpy()[rows].min(), pdf["high"].to_numpy()[rows].max(),
                    np.max([_fold(x, g) for x in boxes], axis=0).astype(np.int32).tobytes()))
    return pd.DataFrame(out, columns=["f", "low", "high", "box"])


def _blocks(rows: DataFrame, group: str, low: str, high: str, tie: str, percent: int, carry: list[str]) -> DataFrame:
    """Rows of a group dealt to tasks (i, j): blocks of BLOCK rows by size, each pair of blocks whose sizes can link.
    side is 0 in a block's own task, else -1 for block i and 1 for block j."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(low, tie)) - 1
    rows = rows.withColumn("i", F.floor(rank / BLOCK).cast("int"))
    spans = staged(rows.groupBy(group, "i").agg(F.min(low).alias("l"), F.max(high).alias("h_")))
    other = spans.select(group, F.col("i").alias("j"), F.col("l").alias("l2"), F.col("h_").alias("h2"))
    fits = (F.col("i") <= F.col("j")) & (F.col("h_") * 100 >= F.col("l2") * percent) & (F.col("h2") * 100 >= F.col("l") * percent)
    pairs = staged(spans.join(other, group).filter(fits).select(group, "i", "j"))
    first = rows.join(pairs, [group, "i"]).select(group, "i", "j", F.when(F.col("i") == F.col("j"), 0).otherwise(-1).alias("side"), *carry)
    second = rows.withColumnRenamed("i", "j").join(pairs.filter("i < j"), [group, "j"]).select(group, "i", "j", F.lit(1).alias("side"), *carry)
    return first.unionByName(second)


def _components(links: DataFrame) -> DataFrame:
    """cls and label, the least cls that links reach, for all classes with links."""
    links = links.select(F.col("cls").alias("a"), F.col("root").alias("b"))
    both = staged(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("cls"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(labels, F.col("b") == F.col("cls")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("cls") == F.col("a")).select("cls", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = staged(lower)
        jump = lower.select(F.col("cls").alias("to"), F.col("label").alias("further"))
        labels = staged(lower.join(jump, F.col("label") == F.col("to"), "left").select(
            "cls", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        if labels.filter("label <> old").isEmpty():
            return labels.select("cls", "label")
        labels = labels.select("cls", "label")


def jaccard_classes(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """rows (id, key, n, cls), classes (cls, n, id, copies) and links (cls, root, degree): a class is linked, directly or
    not, with its root, and its degrees add up to the linked rows outside the class."""
    spark = docs.sparkSession
    sets = staged(keyed(docs).mapInArrow(_scan(percent, *frequent_shingles(docs)), SETS))
    rows = staged(sets.select("id", "key", "n", "cls"))
    firsts = staged(sets.filter("n > 0").groupBy("cls").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "key", "n")).alias("o"), F.min_by("prefix", "id").alias("prefix"))
        .select("cls", "copies", "o.*", "prefix"))
    discard(sets)
    classes = staged(firsts.drop("prefix"))
    tokens = firsts.select("cls", "n", F.explode("prefix").alias("h"))
    shared = lambda rows: staged(rows.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("h"))).filter("m > 1").drop("m"))
    live, least = shared(tokens), F.greatest(F.lit(1), F.ceil(F.col("n") * (EXTRA * percent) / 10_000))
    for _ in range(2):
        enough = live.groupBy("cls").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).filter(F.col("k") >= least)
        before, live = live, shared(live.join(enough.select("cls"), "cls", "left_semi"))
        discard(before)
    discard(firsts)
    family = staged(live.groupBy("cls").agg(F.min("h").alias("f"), F.min("n").alias("n")))
    under = whole_under = staged(live.select("h", "cls").join(family.select("cls", "f"), "cls").select("h", "f").distinct())
    signs = under.groupBy("h").agg(F.count(F.lit(1)).alias("d"), F.bit_xor(F.xxhash64("f")).alias("x"), F.bit_xor(F.xxhash64("f", F.lit(1))).alias("y"))
    lead = signs.filter("d > 1").groupBy("d", "x", "y").agg(F.min("h").alias("h")).select("h", "d")
    lead = staged(lead)
    under = staged(whole_under.join(lead, "h"))
    discard(live, whole_under, lead)
    members = packed(docs).join(classes.join(family.select("cls", "f"), "cls").select("id", "key", "cls", "copies", "n", "f"), ["id", "key"])
    members = staged(members.groupBy("cls").agg(F.first(F.struct("f", "n", "copies", "z")).alias("o")).select("cls", "o.*"))
    families = staged(members.groupBy("f").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("low"), F.max("n").alias("high")))

    n_shards = shards(spark, members.count(), SHARD_ROWS)
    wide = members.join(under.select("f").distinct(), "f").select("f", "n", "z")
    boxes = wide.mapInPandas(_box, "f long, low long, high long, box binary")
    boxes = staged(boxes.groupBy(F.pmod("f", F.lit(n_shards)).alias("part")).applyInPandas(_largest, "f long, low long, high long, box binary"))
    small = under.filter(F.col("d") <= BLOCK).select(F.col("h").alias("t"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "f")
    large = under.filter(F.col("d") > BLOCK).select("h", "f").join(boxes.select("f", "low", "high"), "f")
    large = _blocks(large, "h", "low", "high", "f", percent, ["f"]).withColumnRenamed("h", "t")
    shard = F.pmod(F.xxhash64("t", "i", "j"), F.lit(n_shards))
    paired = small.unionByName(large).join(boxes, "f").groupBy(shard.alias("shard")).applyInPandas(_pair_families(percent), "fa long, fb long").distinct()

    sized = [families.select(F.col("f").alias(x), F.col("size").alias(f"size_{x}"), F.col("low").alias(f"low_{x}"), F.col("high").alias(f"high_{x}")) for x in ("fa", "fb")]
    paired = paired.join(sized[0], "fa").join(sized[1], "fb").filter(
        (F.col("high_fa") * 100 >= F.col("low_fb") * percent) & (F.col("high_fb") * 100 >= F.col("low_fa") * percent))
    larger = F.col("size_fa") >= F.col("size_fb")                    # the larger family stays, the smaller one travels
    paired = staged(paired.select(F.when(larger, F.col("fa")).otherwise(F.col("fb")).alias("host"), F.when(larger, F.col("fb")).otherwise(F.col("fa")).alias("f")))
    row = ["cls", "copies", "z"]
    own = _blocks(members.select("f", "n", "cls"), "f", "n", "n", "cls", percent, ["cls"])
    hosts = paired.select(F.col("host").alias("f")).distinct()
    rank = lambda group: F.floor((F.row_number().over(Window.partitionBy(group).orderBy("n", "cls")) - 1) / BLOCK).cast("int")
    home = staged(members.join(hosts, "f").select("f", "n", "cls").withColumn("i", rank("f")))
    guest = staged(members.select("f", "n", "cls").join(paired, "f").select(F.col("host").alias("f"), "n", "cls").withColumn("j", rank("f")))
    at_home = home.groupBy("f", "i").agg(F.min("n").alias("l"), F.max("n").alias("h_"))
    visits = guest.groupBy("f", "j").agg(F.min("n").alias("l2"), F.max("n").alias("h2"))
    meets = staged(at_home.join(visits, "f").filter((F.col("h_") * 100 >= F.col("l2") * percent) & (F.col("h2") * 100 >= F.col("l") * percent)).select("f", "i", "j"))
    away = home.join(meets, ["f", "i"]).select("f", "i", (-1 - F.col("j")).alias("j"), F.lit(-1).alias("side"), "cls").unionByName(
        guest.join(meets, ["f", "j"]).select("f", "i", (-1 - F.col("j")).alias("j"), F.lit(1).alias("side"), "cls"))
    tasks = own.join(families.filter("size > 1").select("f"), "f").unionByName(away).join(members.select(*row), "cls")
    links = staged(tasks.groupBy(F.pmod(F.xxhash64("f", "i", "j"), F.lit(n_shards)).alias("shard")).applyInPandas(_meet(percent), LINKS))
    discard(family, under, members, families, boxes, paired, home, guest, meets)
    return rows, classes, links


def jaccard_join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, key, n_shingles, component_id and n_links (linked rows, copies included) for each row of docs."""
    rows, classes, links = jaccard_classes(docs, percent)
    labels = _components(links)
    least = labels.join(classes, "cls").groupBy("label").agg(F.min("id").alias("least"))
    degree = links.groupBy("cls").agg(F.sum("degree").alias("degree"))
    found = classes.join(labels.join(least, "label").select("cls", "least"), "cls", "left").join(degree, "cls", "left").select(
        "cls", F.coalesce("least", "id").alias("least"), (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    component = F.coalesce("least", "id")
    return rows.join(staged(found), "cls", "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "key", F.col("n").alias("n_shingles"),
        F.when(component != NO_ID, component).alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with all their columns, without those that have an earlier one (by doc_id) in their component.
    Rows with an empty set stay."""
    rows, classes, links = jaccard_classes(docs, percent)
    group = F.coalesce("label", "cls")
    first = classes.join(_components(links), "cls", "left").groupBy(group.alias("group")).agg(F.min(F.struct("id", "key")).alias("o"))
    keep = first.select("o.*", F.lit(True).alias("single")).unionByName(
        rows.filter("n = 0").select("id", "key", F.lit(False).alias("single")).distinct())
    names = [c for c in docs.columns if c != "text"]
    marked = docs.withColumn("_no_text", F.col("text").isNull())
    held = packed(marked, (*names, "_no_text")).join(keep, ["id", "key"])
    order = F.row_number().over(Window.partitionBy("id", "key").orderBy("id"))
    held = held.withColumn("order", order).filter(~F.col("single") | (F.col("order") == 1))
    held = held.select("z", *[f"_{i}" for i in range(len(names) + 1)])
    return held.mapInArrow(_unpack(docs.columns, {c: f"_{i}" for i, c in enumerate(names)}, f"_{len(names)}"), docs.schema)


def _unpack(names: list[str], carried: dict[str, str], no_text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in slices(batches, "z", 512 << 10):
            texts = [None if no else unzip.decompress(z).decode() for z, no in zip(batch.column("z").to_pylist(), batch.column(no_text).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(carried[c]) for c in names], names)
    return run


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text")).drop("key")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[s + 1:s + 5], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, CAST(coalesce(k.n_links, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a) k USING (doc_id)
"""
