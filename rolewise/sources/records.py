"""CSV records of files whose quoted fields hold line breaks, cut by many tasks.

A line may begin outside or inside a quoted field, and a task that reads the middle of a file cannot know which.  But each
line is a map from the state at its begin to the state at its end, and maps compose: the first scan reduces each split
(file, block) to one map, the splits of a file are put in order, and so the state at the begin of every split is known.
The second scan cuts records.  What a split holds of a record that began before it, and of one that goes on behind it, are
fragments: at most two a split, put together by the split in which the record began.

A quote opens a field only at the field's begin, as CSV readers have it, so a lone inch mark within a field changes
nothing.  Charsets are found for each file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# One field after a delimiter or at a line's begin: quoted and closed, or not quoted.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
_FROM_OUTSIDE = rf"(?s)\A{_FIELD}(?:,{_FIELD})*+\z"
_FROM_INSIDE = rf'(?s)\A[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELD})*+\z'
# What a line does to the state: bit 0 is the state behind it from outside, bit 1 from inside (1 = inside).
_BOM = "\u00ef\u00bb\u00bf"
_KEEP, _FLIP = 2, 1         # 0 and 3 end in one state whatever the begin

# Characters that Windows-1252 puts where Latin-1 has control codes; five codes are unassigned.
_CODES = [bytes([b]) for b in range(0x80, 0xA0)]
UNASSIGNED = "".join(b.decode("latin-1") for b in _CODES if b.decode("cp1252", "ignore") == "")
LATIN = "".join(b.decode("latin-1") for b in _CODES if b.decode("cp1252", "ignore"))
WINDOWS = "".join(b.decode("cp1252", "ignore") for b in _CODES)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, line (its bytes read as Latin-1, so none is lost), end (its line break), step and valid (it is UTF-8), in
    the order of the file within each task."""
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    value = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    value = F.when(F.col("block") == 0, F.regexp_replace(value, f"^{_BOM}", "")).otherwise(value)
    pieces = F.split(value, "\r", -1)
    n, last = F.size("p"), F.element_at("p", -1)
    ended = F.transform("p", lambda p, i: F.struct(p.alias("line"), F.when(i == n - 1, "\n").when((i == n - 2) & (last == ""), "\r\n").otherwise("\r").alias("end")))
    kept = F.when((n > 1) & (last == ""), F.slice(ended, F.lit(1), n - 1)).otherwise(ended)
    cut = raw.select("file", "block", F.is_valid_utf8("value").alias("valid"), pieces.alias("p")).select(
        "file", "block", "valid", F.explode(kept).alias("l")).select("file", "block", "valid", "l.line", "l.end")
    plain = ~F.contains("line", F.lit('"'))
    step = F.when(plain, _KEEP).otherwise((~F.col("line").rlike(_FROM_OUTSIDE)).cast("int") + 2 * (~F.col("line").rlike(_FROM_INSIDE)).cast("int"))
    return cut.withColumn("step", step.cast("int"))


def _runs(batch: pa.RecordBatch) -> list[tuple[str, int, int, int]]:
    """Stretches of one split: file, block, begin, stop."""
    if not batch.num_rows:
        return []
    block = batch.column("block").to_numpy()
    file = pc.dictionary_encode(batch.column("file")).indices.to_numpy()
    edge = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
    begins = [0, *edge.tolist()]
    return [(batch.column("file")[a].as_py(), int(block[a]), a, b) for a, b in zip(begins, [*begins[1:], batch.num_rows])]


def _composed(steps: np.ndarray) -> int:
    """One map for a run of lines."""
    fixed = np.flatnonzero((steps == 0) | (steps == 3))
    after = steps[fixed[-1] + 1:] if len(fixed) else steps
    odd = int((after == _FLIP).sum()) & 1
    if len(fixed):
        return (int(steps[fixed[-1]]) ^ (3 if odd else 0))
    return _FLIP if odd else _KEEP


def _then(first: int, second: int) -> int:
    return (second >> (first & 1) & 1) | ((second >> (first >> 1 & 1) & 1) << 1)


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split: its map, and its number of lines that are not UTF-8, hold unassigned codes, or leave a field open."""
    open_run = None
    for batch in batches:
        steps, counts = batch.column("step").to_numpy(), [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("not_utf8", "not_windows")]
        for file, block, a, b in _runs(batch):
            mine = [_composed(steps[a:b]), *[int(c[a:b].sum()) for c in counts], int((steps[a:b] & 1).sum())]
            if open_run and open_run[:2] == [file, block]:
                open_run[2] = _then(open_run[2], mine[0])
                open_run[3:] = [x + y for x, y in zip(open_run[3:], mine[1:])]
            else:
                if open_run:
                    yield _row(open_run)
                open_run = [file, block, *mine]
    if open_run:
        yield _row(open_run)


def _row(values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(("file", "block", "map", "not_utf8", "not_windows", "opened"), [[v] for v in values])))


def splits(spark: SparkSession, path: str) -> DataFrame:
    """A row for each split: file, block, inside (it begins inside a quoted field), encoding of its file, opened (lines
    of the file that leave a field open if they begin outside; none: a line is a record)."""
    facts = lines(spark, path).select("file", "block", "step", (~F.col("valid")).alias("not_utf8"), F.col("line").rlike(f"[{UNASSIGNED}]").alias("not_windows"))
    reduced = facts.mapInArrow(_reduce, "file string, block long, map long, not_utf8 long, not_windows long, opened long")
    whole = Window.partitionBy("file")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.last(F.when(F.col("map").isin(0, 3), F.struct("block", "map")), ignorenulls=True).over(before)
    flips = F.coalesce(F.sum(F.when(F.col("map") == _FLIP, 1).otherwise(0)).over(before), F.lit(0))
    ordered = reduced.withColumns({"fixed": fixed, "flips": flips})
    at_fixed = F.coalesce(F.last(F.when(F.col("map").isin(0, 3), F.col("flips")), ignorenulls=True).over(before), F.lit(0))
    inside = F.coalesce((F.col("fixed.map") == 3).cast("int"), F.lit(0)).bitwiseXOR(((F.col("flips") - at_fixed) % 2).cast("int")) == 1
    encoding = F.when(F.sum("not_utf8").over(whole) == 0, "utf-8").when(F.sum("not_windows").over(whole) == 0, "cp1252").otherwise("latin-1")
    return ordered.select("file", "block", inside.alias("inside"), encoding.alias("encoding"), F.sum("opened").over(whole).alias("opened"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records: file, block, part (0 whole, 1 begins here and goes on, 2 goes on from an earlier split), first, text."""
    held: list[str] = []
    where, state, part, first = None, 0, 0, False

    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": pa.array([r[0][0] for r in rows], pa.string()), "block": pa.array([r[0][1] for r in rows], pa.int64()),
                                           "part": pa.array([r[1] for r in rows], pa.int32()), "first": pa.array([r[2] for r in rows], pa.bool_()),
                                           "text": pa.array([r[3] for r in rows], pa.string())})

    for batch in batches:
        rows = []
        for file, block, a, b in _runs(batch):
            if where != (file, block):
                if held:                                    # open at the end of its split
                    rows.append((where, 1 if part == 0 else 2, first, "".join(held)))
                where, held = (file, block), []
                state = int(batch.column("inside")[a].as_py())
                part, first = 2 if state else 0, block == 0
            text = batch.column("text").slice(a, b - a).to_pylist()
            for line, step in zip(text, batch.column("step").slice(a, b - a).to_pylist()):
                held.append(line)
                state = step >> state & 1
                if not state:
                    body = "".join(held)
                    if part or body.strip():                # blank lines are no records
                        rows.append((where, part, first, body))
                        first = False
                    held, part = [], 0
        if rows:
            yield out(rows)
    if held:
        yield out([(where, 1 if part == 0 else 2, first, "".join(held))])


def records(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """file, first (the file's header) and text of each record, blank lines left out.  `known`: the rows of `splits`.

    The table of splits is broadcast: a row of some 100 bytes for each split (128 MB of input by default).  A split that
    was cut elsewhere in the first scan is an error, not a loss."""
    said = lines(spark, path).join(F.broadcast(known), ["file", "block"], "left")
    same = F.when(F.col("inside").isNull(), F.raise_error(F.lit("the input was split in another way than in the first scan; read it again")).cast("boolean"))
    said = said.withColumn("inside", same.otherwise(F.col("inside")))
    text = F.when(F.col("encoding") == "utf-8", F.encode("line", "ISO-8859-1").cast("string")).when(
        F.col("encoding") == "cp1252", F.translate("line", LATIN, WINDOWS)).otherwise(F.col("line"))
    cut = said.select("file", "block", "step", "inside", F.concat(text, F.col("end")).alias("text")).mapInArrow(
        _cut, "file string, block long, part int, first boolean, text string")
    # The owner of a continued part is the last split before it that leaves a record open at its end.
    pieces = cut.filter("part > 0")
    owner = F.last(F.when(F.col("part") == 1, F.col("block")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block", F.desc("part")).rowsBetween(Window.unboundedPreceding, 0))
    joined = pieces.withColumn("owner", owner).groupBy("file", "owner").agg(
        F.bool_or(F.col("first") & (F.col("part") == 1)).alias("first"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "").alias("text"))
    whole = cut.filter("part = 0").select("file", "first", "text").unionByName(joined.select("file", "first", "text"))
    return whole.withColumn("text", F.regexp_replace("text", r"(\r\n|\n|\r)\z", ""))
