"""Exact, linearly interpolated quantiles of many columns at any row count.

Spark's exact ``percentile`` keeps every distinct value of a column in one task.  That is right for
small tables, so it is used up to a fixed number of cells.  Beyond it the order statistics are found
by narrowing: each pass is one scan that counts the rows of a bracket in bins, with the smallest and
largest value of each bin; the bin that holds a wanted rank is the next bracket.  The first pass bins
on a logarithmic scale, so that far outliers cost no extra pass.  A pass shuffles one row per task
and bin; ties of any size only raise a count.
"""

from __future__ import annotations

import math
import sys
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from .columns import to_long

DIRECT_CELLS = 2_000_000   # rows x columns up to which `percentile` may be asked directly
BINS = 1_024
FINAL_ROWS = 2_000         # a bracket with at most this many rows is read off directly
AT_ONCE = 24               # brackets that share one scan
MANY_PROBS = 8             # more quantiles than this are read off one exact ranking instead


@dataclass
class _Bracket:
    """Rows of a column from `lo` to `hi`, and the ranks (of the whole column) wanted among them."""

    name: str
    lo: float
    hi: float
    below: int
    size: int
    ranks: set[int] = field(default_factory=set)


def exact_quantiles(df: DataFrame, columns: dict[str, Column], probs: list[float],
                    n_rows: int | None = None, direct_cells: int = DIRECT_CELLS
                    ) -> dict[str, list[float | None]]:
    """Quantiles of double expressions, NULLs left out; a column without values gives NULLs."""
    if not columns:
        return {}
    if n_rows is None:
        n_rows = df.count()
    if n_rows * len(columns) <= direct_cells:
        spec = F.array(*[F.lit(float(p)) for p in probs])
        row = df.agg(*[F.percentile(e, spec).alias(f"q{i}")
                       for i, e in enumerate(columns.values())]).first()
        return {n: list(row[f"q{i}"] or [None] * len(probs)) for i, n in enumerate(columns)}
    return (_by_narrowing if len(probs) <= MANY_PROBS else _by_rank)(df, columns, probs)


def _by_rank(df, columns, probs):
    """All quantiles of a column from the exact running count over its distinct values."""
    from .ranks import running_counts

    counts = (to_long(df, columns).filter("value is not null").groupBy("name", "value")
              .agg(F.count("*").alias("n")))
    sizes = {r["name"]: r["n"] for r in counts.groupBy("name").agg(F.sum("n").alias("n")).collect()}
    targets = {n: sorted({k for p in probs for k in _ranks(p, size)[:2]}) for n, size in sizes.items()}
    if not targets:
        return {n: [None] * len(probs) for n in columns}
    table = df.sparkSession.createDataFrame(list(targets.items()), "name string, ranks array<long>")
    hits = (running_counts(counts, ["name"], "value", {"n": "before"}).join(F.broadcast(table), "name")
            .select("name", "value", F.explode(F.filter(
                "ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))).alias("rank")))
    at = {(r["name"], r["rank"]): r["value"] for r in hits.collect()}      # two values per quantile
    out = {}
    for name in columns:
        found = []
        for p in probs if name in sizes else []:
            below, above, share = _ranks(p, sizes[name])
            lo, hi = at[name, below], at[name, above]
            found.append(_between(lo, hi, share))
        out[name] = found or [None] * len(probs)
    return out


def _by_narrowing(df, columns, probs):
    names = list(columns)
    row = df.agg(*[a for i, n in enumerate(names) for a in (
        F.count(columns[n]).alias(f"n{i}"), F.min(columns[n]).alias(f"a{i}"),
        F.max(columns[n]).alias(f"z{i}"))]).first()
    sizes = {n: row[f"n{i}"] for i, n in enumerate(names)}
    open_ = [_Bracket(n, row[f"a{i}"], row[f"z{i}"], 0, sizes[n],
                      {k for p in probs for k in _ranks(p, sizes[n])[:2]})
             for i, n in enumerate(names) if sizes[n]]
    known: dict[tuple[str, int], float] = {}
    logarithmic = True
    while True:
        known.update({(b.name, k): b.lo for b in open_ if b.lo == b.hi for k in b.ranks})
        open_ = [b for b in open_ if b.lo < b.hi]
        wide = [b for b in open_ if b.size > FINAL_ROWS]
        if not wide:
            break
        open_ = [b for b in open_ if b.size <= FINAL_ROWS]
        for i in range(0, len(wide), AT_ONCE):
            open_ += _narrow(df, columns, wide[i:i + AT_ONCE], logarithmic, known)
        logarithmic = False
    for i in range(0, len(open_), AT_ONCE):
        _read_off(df, columns, open_[i:i + AT_ONCE], known)
    out = {}
    for n in names:
        out[n] = []
        for p in probs:
            lo, hi, share = _ranks(p, sizes[n])
            a, b = known.get((n, lo)), known.get((n, hi))
            out[n].append(None if a is None else _between(a, b, share))
    return out


def _ranks(prob: float, size: int) -> tuple[int, int, float]:
    """The two zero-based ranks to interpolate between, and the weight of the upper one."""
    rank = prob * (size - 1)
    return math.floor(rank), math.ceil(rank), rank - math.floor(rank)


def _bin(value: Column, lo: float, hi: float, logarithmic: bool) -> Column:
    """Bin number 0..BINS-1, never falling as the value grows; `lo` and `hi` differ in it.  The first and the last bin
    are for the infinities alone, so the others are finite."""
    infinite = F.when(value == -math.inf, 0).when(value == math.inf, BINS - 1)
    lo, hi = max(lo, -sys.float_info.max), min(hi, sys.float_info.max)
    if logarithmic:
        value = F.signum(value) * F.log1p(F.abs(value))
        lo, hi = (math.copysign(math.log1p(abs(v)), v) for v in (lo, hi))
    scale = hi / 2 - lo / 2
    if not 0 < scale < math.inf:
        return infinite.when(value > lo, BINS - 2).otherwise(1)
    inner = F.floor((value / 2 - F.lit(lo / 2)) / F.lit(scale) * (BINS - 2)) + 1
    return infinite.otherwise(F.greatest(F.lit(1), F.least(F.lit(BINS - 2), inner)))


def _between(a: float, b: float, share: float) -> float:
    return a if a == b else a + (b - a) * share


def _inside(columns, brackets, value) -> dict[str, Column]:
    return {str(i): F.when(columns[b.name].between(b.lo, b.hi), value(columns[b.name], b))
            for i, b in enumerate(brackets)}


def _narrow(df, columns, brackets, logarithmic, known) -> list[_Bracket]:
    """Brackets one bin wide for the wanted ranks; ranks at the edge of a bin become known."""
    long = to_long(df, _inside(columns, brackets, lambda v, b: F.struct(
        _bin(v, b.lo, b.hi, logarithmic).cast("int").alias("bin"), v.alias("v")))).filter("value is not null")
    bins = defaultdict(list)
    for r in (long.groupBy("name", "value.bin").agg(F.count(F.lit(1)).alias("n"), F.min("value.v").alias("a"),
                                                    F.max("value.v").alias("z")).collect()):
        bins[int(r["name"])].append((r["bin"], r["n"], r["a"], r["z"]))     # at most BINS per bracket
    out = []
    for i, b in enumerate(brackets):
        below = b.below
        for _, n, a, z in sorted(bins[i]):
            wanted = {k for k in b.ranks if below <= k < below + n}
            known.update({(b.name, k): v for k, v in ((below, a), (below + n - 1, z)) if k in wanted})
            wanted -= {below, below + n - 1}
            if wanted:
                out.append(_Bracket(b.name, a, z, below, n, wanted))
            below += n
    return out


def _read_off(df, columns, brackets, known) -> None:
    """All rows of small brackets, sorted on the driver: at most FINAL_ROWS each."""
    long = to_long(df, _inside(columns, brackets, lambda v, b: v)).filter("value is not null")
    values = defaultdict(list)
    for r in long.collect():
        values[int(r["name"])].append(r["value"])
    for i, b in enumerate(brackets):
        ordered = sorted(values[i])
        known.update({(b.name, k): ordered[k - b.below] for k in b.ranks})


def grouped_ranks(df: DataFrame, group: Column, value: Column, range_rows: int | None = None) -> DataFrame:
    """Rows (group, value, n, before, total_n): every distinct value of a group with its count, the rows of the group below
    it and all rows of the group.  Rows without a group or a value are left out."""
    from .ranks import RANGE_ROWS, running_sums

    pairs = df.select(group.alias("group"), value.alias("value")).dropna()
    size = pairs.agg(F.approx_count_distinct(F.struct("group", "value"))).first()[0]
    counts = pairs.groupBy("group", "value").agg(F.count(F.lit(1)).alias("n"))
    return running_sums(counts, ["group"], ["value"], {"n": "before"}, size, range_rows or RANGE_ROWS)


def grouped_quantiles(ranked: DataFrame, probs: list[float]) -> DataFrame:
    """Rows (group, n, q0, q1, ...) from `grouped_ranks`: exact, linearly interpolated quantiles of every group."""
    aggs = [F.first("total_n").alias("n")]
    for i, p in enumerate(probs):
        rank = F.lit(float(p)) * (F.col("total_n") - 1)
        for name, place in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            here = (F.col("before") <= place) & (place < F.col("before") + F.col("n"))
            aggs.append(F.max(F.when(here, F.col("value"))).alias(f"_{name}{i}"))
    found = ranked.groupBy("group").agg(*aggs)
    out = []
    for i, p in enumerate(probs):
        rank, lo, hi = F.lit(float(p)) * (F.col("n") - 1), F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (rank - F.floor(rank))).alias(f"q{i}"))
    return found.select("group", "n", *out)
