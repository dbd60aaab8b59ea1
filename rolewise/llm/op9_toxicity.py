"""Toxicity: a logistic classifier of words, trained so that swapping an identity term leaves the score alone.

Words are as in decontamination (letters, digits and all characters beyond ASCII, A-Z lower-cased).  A feature is a word or a
beginning of a word (PREFIXES bytes, for inflected forms); it counts once if it occurs and once more if it occurs OFTEN
times.  The vocabulary is learnt: of the CANDIDATES features in most toxic texts, those whose share among toxic texts exceeds
that among all by `MIN_Z` standard errors, the strongest MAX_WORDS, and all identity terms.  For each labelled text with identity terms, copies with
each term swapped for the others of its family are made: the features of the term (word and beginnings) go where nothing else in the
text has them, those of the other come.  Squared changes of the whole log odds are penalised by `PENALTY`; so a neutral mention of
a group carries no weight that a mention of another would not.

Training reads text and label of rows whose crc32(doc_id as text) mod 5 is not 0: a bounded sample, the SAMPLE_DOCS labelled
ids of the smallest hashes, whole texts.  Several labels of one id count by their mean.  Null labels and null ids are not
learnt from.  Null and empty texts have no words and get the score of the intercept; with labels of one kind or none every
score is the smoothed share of toxic labels.  Repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .op4_decontamination import TERM, term_hashes
from .stage import table
from .text import BYTE_VALUE, LOWER, Rolling, mix, slices, utf8, words

SAMPLE_DOCS = 20_000
MAX_WORDS, MIN_Z, MIN_DOCS = 2048, 4.0, 5
CANDIDATES = 200_000
PREFIXES, OFTEN = (5, 6, 7, 8, 9, 10), 3
PENALTY, RIDGE, STEPS = 1.0, 1e-3, 400

# Families of identity terms, plain words.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual"), ("transgender", "cisgender"), ("black", "white", "asian", "latino"),
    ("immigrant", "native"), ("immigrants", "natives"), ("young", "old"), ("disabled", "abled"),
)


def _hash_of(terms: list[str]) -> np.ndarray:
    column = pa.array(terms, pa.string())
    return term_hashes(*utf8(column))[0]


class Known:
    """Sorted feature hashes, with a bitmap that turns most others away."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 if it is unknown."""
        out = np.full(len(hashes), -1, np.int64)
        some = np.flatnonzero(self.bitmap[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.searchsorted(self.hashes, hashes[some])
        at[at == len(self.hashes)] = 0
        out[some] = np.where(self.hashes[at] == hashes[some], at, -1) if len(self.hashes) else -1
        return out


def features(column, known: Known | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, feature and number of occurrences; features are places in `known`, or hashes without it."""
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, stops, per_row = words(data, offsets, TERM)
    rolling, row = Rolling(BYTE_VALUE[data]), np.repeat(np.arange(len(per_row) - 1), np.diff(per_row))
    rows, found = [], []
    for size in (None, *PREFIXES):
        long = np.arange(len(starts)) if size is None else np.flatnonzero(stops - starts > size)
        hashes = rolling.of(starts[long], stops[long] if size is None else starts[long] + size)
        if size is not None:
            hashes = mix(hashes + np.uint64(size))
        if known is not None:
            hashes = known.place(hashes)
            long, hashes = long[hashes >= 0], hashes[hashes >= 0]
        rows.append(row[long])
        found.append(hashes)
    row, found = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    heads = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (found[1:] != found[:-1]))) if len(row) else np.zeros(0, np.int64)
    return row[heads], found[heads], np.diff(np.append(heads, len(row)))


def _toxic_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found, n = np.unique(features(batch.column("text"))[1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["h", "n"])


def _count(known: Known):
    """For each candidate: texts and toxic texts in which it occurs, and in which it occurs often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, found, times = features(batch.column("text"), known)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[row]
            often, size = times >= OFTEN, len(known.hashes)
            sums = [np.bincount(found, w, size) for w in (np.ones(len(row)), toxic, often, often * toxic)]
            some = np.flatnonzero(sums[0])
            yield pa.RecordBatch.from_arrays([pa.array(known.hashes[some].view(np.int64)), *[pa.array(x[some].astype(np.int64)) for x in sums]],
                                             ["h", "n", "k", "n_often", "k_often"])
    return run


def _families(known: Known, families: tuple) -> dict[int, tuple[set, list[set]]]:
    """For the place of each identity term: the known features of the term, and those of each other of its family."""
    out: dict[int, tuple[set, list[set]]] = {}
    for family in families:
        row, found, _ = features(pa.array(family, pa.string()), known)
        own = [set(found[row == i].tolist()) for i in range(len(family))]
        for i, place in enumerate(known.place(_hash_of(list(family))).tolist()):
            out.setdefault(place, (own[i], []))[1].extend(own[:i] + own[i + 1:])
    return out


def _changes(found: np.ndarray, times: np.ndarray, family_of: dict, size: int) -> list[list[tuple[int, int]]]:
    """For each swap of an identity term in a text: columns that come (1) or go (-1) when all its occurrences are swapped."""
    have, out = dict(zip(found.tolist(), times.tolist())), []
    for term in have.keys() & family_of.keys():
        own, others = family_of[term]
        for other in others:
            change = []
            for f, by in [(f, -have[term]) for f in own - other] + [(f, have[term]) for f in other - own]:
                old = have.get(f, 0)
                change += [(f + size * often, int(old + by >= least) - int(old >= least)) for often, least in ((0, 1), (1, OFTEN))
                           if (old + by >= least) != (old >= least)]
            out.append(change)
    return out


def _rows(known: Known, family_of: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, found, times = features(batch.column("text"), known)
            column = np.concatenate([found, found[times >= OFTEN] + len(known.hashes)])
            row = np.concatenate([row, row[times >= OFTEN]])
            order = np.argsort(row, kind="stable")
            parts = np.split(column[order], np.searchsorted(row[order], np.arange(1, batch.num_rows)))
            present, size = [p[p < len(known.hashes)] for p in parts], len(known.hashes)
            count = np.split(times, np.cumsum([len(p) for p in present])[:-1])
            swaps = [_changes(f, t, family_of, size) for f, t in zip(present, count)]
            flat = [[(i, *c) for i, swap in enumerate(s) for c in swap] for s in swaps]
            yield pa.RecordBatch.from_arrays([
                batch.column("toxic"), pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())),
                *[pa.array([[c[j] for c in s] for s in flat], pa.list_(pa.int32())) for j in range(3)]], ["toxic", "words", "swap", "place", "sign"])
    return run


def fit(row: np.ndarray, column: np.ndarray, size: int, y: np.ndarray, swaps: tuple[np.ndarray, np.ndarray, np.ndarray], penalty: float = PENALTY, ridge: float = RIDGE,
        steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights of `size` features, and intercept, for texts whose features are the pairs (row, column).
    swaps: number of a swap, a feature that it changes, and whether it comes (1) or goes (-1)."""
    w, b = np.zeros(size), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    m, v, t = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    swap, place, sign = swaps
    n_swaps = int(swap[-1]) + 1 if len(swap) else 0
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[column], len(y)) + b, -30, 30)))
        g = np.bincount(column, (p - y)[row], size) / len(y) + ridge * w
        if n_swaps:
            change = np.bincount(swap, sign * w[place], n_swaps)     # of the log odds by a swap
            g += 2 * penalty / n_swaps * np.bincount(place, sign * change[swap], size)
        g = np.append(g, (p - y).mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


class Model:
    """Weights of the features' presence, then of their frequent occurrence."""

    def __init__(self, known: Known, weights: np.ndarray, intercept: float):
        self.known, self.weights, self.intercept = known, weights, intercept

    def scores(self, column) -> np.ndarray:
        row, found, times = features(column, self.known)
        weight = self.weights[found] + np.where(times >= OFTEN, self.weights[found + len(self.known.hashes)], 0.0)
        odds = self.intercept + np.bincount(row, weight, len(column))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, families: tuple = IDENTITY_TERMS, sample_docs: int = SAMPLE_DOCS) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic; both already without what must not be learnt from."""
    picked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        (F.avg("toxic") >= 0.5).cast("long").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    rows = docs.join(F.broadcast(picked), "doc_id").select("toxic", "text")      # at most sample_docs small rows
    total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n, k = int(total[0]), int(total[1])
    if k == 0 or k == n:
        return Model(Known(np.zeros(0, np.uint64)), np.zeros(0), float(np.log((k + 0.5) / (n - k + 0.5))))
    seen = rows.filter("toxic = 1").mapInArrow(_toxic_features, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    seen = seen.filter(F.col("n") >= MIN_DOCS).orderBy(F.desc("n"), "h").limit(CANDIDATES).select("h").collect()
    candidates = Known(np.array([r[0] for r in seen], np.int64).view(np.uint64))
    counts = rows.mapInArrow(_count(candidates), "h long, n long, k long, n_often long, k_often long").groupBy("h").agg(
        *[F.sum(c).alias(c) for c in ("n", "k", "n_often", "k_often")])
    share = k / n
    z = lambda n, k: (F.col(k) - F.col(n) * share) / F.sqrt(F.greatest(F.col(n), F.lit(1)) * (share * (1 - share)))
    best = counts.withColumn("z", F.greatest(z("n", "k"), z("n_often", "k_often"))).filter(F.col("z") >= MIN_Z)
    chosen = [r[0] for r in best.orderBy(F.desc("z"), "h").limit(MAX_WORDS).select("h").collect()]
    terms = [_hash_of(list(family)) for family in families]
    known = Known(np.concatenate([np.array(chosen, np.int64).view(np.uint64), *terms]))
    size = len(known.hashes)
    sample = rows.mapInArrow(_rows(known, _families(known, families)),
                             "toxic long, words array<int>, swap array<int>, place array<int>, sign array<int>").collect()
    y = np.array([r["toxic"] for r in sample], float)
    before = np.cumsum([0, *(max(r["swap"], default=-1) + 1 for r in sample)])
    swap = np.array([s + a for r, a in zip(sample, before.tolist()) for s in r["swap"]], np.int64)
    place, sign = (np.array([c for r in sample for c in r[k]], np.int64) for k in ("place", "sign"))
    row = np.repeat(np.arange(len(sample)), [len(r[1]) for r in sample])
    column = np.array([c for r in sample for c in r[1]], np.int64)
    return Model(known, *fit(row, column, 2 * size, y, (swap, place, sign)))


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = model.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted for each row of docs; only text is read for them."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_predict(model), f"doc_id {kind}, score double, predicted int")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs.filter(~held_out()), table(spark, sf_dir, "labels", "doc_id", "toxic").filter(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
