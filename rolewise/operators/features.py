"""Feature encodings by role."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.columns import (as_double, field_types, present, q, row_hash, safe_name, to_long,
                                 unique_name)
from ..functions.dates import parse_timestamp
from ..functions.quantiles import exact_quantiles
from ..functions.ranks import RANGE_ROWS, running_sums
from ..functions.tables import lookup, spread, staged
from ..functions.words import STOP_WORDS, tokens
from .kmeans import assign, distance, fit_best
from .roles import Roles

GEO_CLUSTERS = 8
TEXT_COLUMNS = 2
TEXT_TERMS = 20
TEXT_MIN_ROWS = 20
TEXT_MIN_DOCS = 2
ENCODINGS = ("frequency", "target")
LOG_SCHEMA = "source_column string, action string, output_column string, detail string"


@dataclass
class Features:
    table: DataFrame
    columns: list[str]
    deferred: list[str] = field(default_factory=list)
    log: list[tuple] = field(default_factory=list)
    geo_centres: list[list[float]] | None = None

    def log_frame(self) -> DataFrame:
        return self.table.sparkSession.createDataFrame(self.log, LOG_SCHEMA)


# --- categories -----------------------------------------------------------------------------

def levels(df: DataFrame, names: list[str]) -> dict[str, list[str]]:
    """Sorted levels of low-cardinality columns; one aggregate, bounded by the role."""
    if not names:
        return {}
    row = df.agg(*[F.array_sort(F.collect_set(q(n).cast("string"))).alias(f"l{i}")
                   for i, n in enumerate(names)]).first()
    return {n: row[i] for i, n in enumerate(names)}


def one_hot(df: DataFrame, names: list[str]) -> tuple[DataFrame, list[tuple]]:
    """0/1 column per level, all levels kept; missing values are 0 everywhere."""
    found, log, columns = levels(df, names), [], {}
    taken = {c.lower() for c in df.columns}
    for n in names:
        for level in found[n]:
            out = unique_name(safe_name(f"{n}_{level}"), taken)
            columns[out] = F.coalesce((q(n).cast("string") == level).cast("int"), F.lit(0))
            log.append((n, "one_hot", out, level))
    kept = [q(c) for c in df.columns if c not in names]
    return df.select(*kept, *[e.alias(o) for o, e in columns.items()]), log


def level_codes(df: DataFrame, name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows (label, code, n): every value as text, its place in text order from 0, and its rows; any number of values."""
    values = df.select(q(name).cast("string").alias("label")).dropna()
    size = values.agg(F.approx_count_distinct("label")).first()[0]
    counts = values.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn("_one", F.lit(1))
    return running_sums(counts, [], ["label"], {"_one": "code"}, size, range_rows).select("label", F.col("code").cast("long").alias("code"), "n")


def one_hot_sparse(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """One-hot for columns of any number of levels: `<name>_code` and the sparse vector `<name>_levels`, with the levels of
    each column as a table.  Missing values have no code and a vector of zeros; a column without any value gets no vector."""
    found = {}
    for n in names:
        found[n] = staged(level_codes(df, n))
        size = found[n].agg(F.count(F.lit(1)).alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
        table = found[n].select(F.col("label").alias("_label"), F.col("code").alias(f"{n}_code"), F.col("n").alias("_n"))
        df = lookup(df.withColumn("_label", q(n).cast("string")), table, ["_label"], "_n", size["k"], size["n"]).drop("_label")
        if size["k"]:
            encoder = OneHotEncoder(inputCol="_place", outputCol=f"{n}_levels", dropLast=True, handleInvalid="keep")
            model = encoder.fit(found[n].select(F.col("code").cast("double").alias("_place")))
            place = F.coalesce(q(f"{n}_code"), F.lit(size["k"])).cast("double")         # one past the last: all zeros
            df = model.transform(df.withColumn("_place", place)).drop("_place")
    return df, found


def value_shares(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """Share per value among rows that have one, with the number of values and of such rows."""
    counts = (df.filter(q(name).isNotNull()).groupBy(q(name).alias(name))
              .agg(F.count(F.lit(1)).alias("_n")))
    size = counts.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("n")).first()
    total = size["n"] or 0
    return counts.withColumn("_share", F.col("_n") / F.lit(float(total or 1))), size["k"], total


def frequency_encode(df: DataFrame, name: str, fit_on: DataFrame | None = None,
                     keep: bool = False) -> DataFrame:
    """`<name>_freq`: the share of the value among rows that have one, 0 for unseen or missing."""
    shares, k, n = value_shares(df if fit_on is None else fit_on, name)
    out = lookup(df, shares, [name], "_n", k, n)
    out = out.withColumn(f"{name}_freq", F.coalesce("_share", F.lit(0.0))).drop("_share")
    return out if keep else out.drop(name)


def target_encode(df: DataFrame, names: list[str], target: str, fold: Column | None = None,
                  is_train: Column | None = None, n_folds: int = 5, seed: int = 42) -> DataFrame:
    """Mean-target encoding: training rows from the other folds, test rows from all training rows.

    Sums and counts per value and fold are one small table per column; the value total minus the
    own fold gives the out-of-fold mean, so no fold is scanned again.
    """
    train = F.lit(True) if is_train is None else is_train
    fold = F.pmod(row_hash(df, None, seed), F.lit(n_folds)) if fold is None else fold
    out = df.withColumns({"_train": train, "_fold": fold.cast("int"),
                          "_y": q(target).cast("double")})
    base = out.filter("_train").agg(F.avg("_y").alias("m"), F.count(F.lit(1)).alias("n")).first()
    for n in names:
        parts = (out.filter("_train").filter(q(n).isNotNull()).groupBy(q(n).alias(n), F.col("_fold"))
                 .agg(F.sum("_y").alias("_fs"), F.count("_y").alias("_fc")))
        stats = parts.groupBy(q(n).alias(n)).agg(
            F.sum("_fs").alias("_s"), F.sum("_fc").alias("_c"),
            F.map_from_entries(F.collect_list(F.struct("_fold", F.struct("_fs", "_fc")))).alias("_own"))
        size = stats.count()
        out = lookup(out, stats.withColumn("_n", F.col("_c")), [n], "_n", size, base["n"])
        own = F.try_element_at(F.col("_own"), F.col("_fold"))
        seen = F.when(F.col("_train"), F.col("_c") - F.coalesce(own["_fc"], F.lit(0))).otherwise(F.col("_c"))
        total = F.when(F.col("_train"), F.col("_s") - F.coalesce(own["_fs"], F.lit(0.0))).otherwise(F.col("_s"))
        mean = F.when(seen > 0, total / seen)
        out = out.withColumn(n, F.coalesce(mean, F.lit(base["m"]))).drop("_s", "_c", "_own")
    return out.drop("_train", "_fold", "_y")


# --- dates ----------------------------------------------------------------------------------

def datetime_parts(name: str, stamp: Column) -> dict[str, Column]:
    """Calendar parts and their cyclical forms (Monday is 0); the weekend flag is never missing."""
    weekday = F.weekday(stamp)
    month = F.month(stamp)

    def wave(fn, part, period):
        return fn(F.lit(2 * math.pi) * part / F.lit(float(period)))

    return {
        f"{name}_year": F.year(stamp), f"{name}_month": month, f"{name}_day": F.day(stamp),
        f"{name}_dayofweek": weekday,
        f"{name}_is_weekend": F.coalesce((weekday >= 5).cast("int"), F.lit(0)),
        f"{name}_month_sin": wave(F.sin, month, 12), f"{name}_month_cos": wave(F.cos, month, 12),
        f"{name}_dayofweek_sin": wave(F.sin, weekday, 7),
        f"{name}_dayofweek_cos": wave(F.cos, weekday, 7),
    }


def expand_datetime(df: DataFrame, name: str, fill: bool = True, keep: bool = False
                    ) -> tuple[DataFrame, list[str]]:
    """Replace a date column by its parts; missing dates get the median of each part (0 if none).

    A part has at most a few thousand values, so its exact median is a small count map.
    """
    types = field_types(df)
    parts = datetime_parts(name, parse_timestamp(present(name, types[name]), types[name]))
    if fill:
        row = df.agg(F.count(F.when(parts[f"{name}_year"].isNull(), 1)).alias("gaps"), *[
            F.percentile(e.cast("double"), F.lit(0.5)).alias(f"m{i}")
            for i, e in enumerate(parts.values())]).first()
        if row["gaps"]:
            parts = {n: F.coalesce(e.cast("double"), F.lit(row[f"m{i}"] or 0.0))
                     for i, (n, e) in enumerate(parts.items())}
    kept = [q(c) for c in df.columns if keep or c != name]
    return df.select(*kept, *[e.alias(n) for n, e in parts.items()]), list(parts)


# --- places ---------------------------------------------------------------------------------

def add_geo(df: DataFrame, lat: str, lon: str, n_rows: int, centres: list[list[float]] | None = None,
            restarts: int = 10) -> tuple[DataFrame, list[list[float]] | None]:
    """Spatial cluster and distance to its centre; places that are missing get -1 and the median."""
    types = field_types(df)
    point = {"_lat": as_double(lat, types[lat]), "_lon": as_double(lon, types[lon])}
    base = df.withColumns(point)
    if centres is None:
        complete = base.filter("_lat is not null and _lon is not null").select("_lat", "_lon")
        n = complete.count()
        if n < GEO_CLUSTERS:
            return df, None
        centres = fit_best(complete, ["_lat", "_lon"], GEO_CLUSTERS, restarts, n_rows=n).centres
    out = base.withColumns({
        "geo_cluster": F.coalesce(assign(["_lat", "_lon"], centres), F.lit(-1)),
        "geo_dist_to_centroid": distance(["_lat", "_lon"], centres)})
    gaps = base.filter("_lat is null or _lon is null").limit(1).count()
    if gaps:
        middle = exact_quantiles(out, {"d": F.col("geo_dist_to_centroid")}, [0.5], n_rows)["d"][0]
        out = out.fillna({"geo_dist_to_centroid": middle or 0.0})
    return out.drop("_lat", "_lon"), centres


# --- text -----------------------------------------------------------------------------------

def term_table(df: DataFrame, name: str, n_terms: int = TEXT_TERMS, min_docs: int = TEXT_MIN_DOCS,
               stop_words: tuple[str, ...] = STOP_WORDS, n_rows: int | None = None) -> DataFrame:
    """The most frequent terms with total count, document count and smoothed idf; ties by term.

    Every text emits its tokens once for the total and its distinct tokens once for the document
    count, so the only shuffle is of per-task counts by term and no text is moved.
    """
    n = df.count() if n_rows is None else n_rows
    text = spread(df.select(F.coalesce(q(name).cast("string"), F.lit("")).alias("text")), n)
    words = text.select(tokens(F.col("text")).alias("words"))
    marked = F.concat(
        F.transform("words", lambda w: F.struct(w.alias("term"), F.lit(0).alias("doc"))),
        F.transform(F.array_distinct("words"), lambda w: F.struct(w.alias("term"), F.lit(1).alias("doc"))))
    counts = (words.select(F.explode(marked).alias("t")).select("t.term", "t.doc")
              .groupBy("term").agg(F.sum(1 - F.col("doc")).alias("n_total"),
                                   F.sum("doc").alias("n_docs"))
              .filter(F.col("n_docs") >= min_docs))
    if stop_words:
        counts = counts.filter(~F.col("term").isin(*stop_words))
    idf = F.log(F.lit(1.0 + n) / (F.lit(1.0) + F.col("n_docs"))) + F.lit(1.0)
    return counts.orderBy(F.desc("n_total"), "term").limit(n_terms).withColumn("idf", idf)


def tfidf(df: DataFrame, name: str, terms: list[tuple[str, float]], keep: bool = False
          ) -> tuple[DataFrame, list[tuple]]:
    """One L2-normalised weight column per (term, idf); the texts are read once, without a shuffle."""
    vocabulary = [t for t, _ in sorted(terms)]
    idf = dict(terms)
    taken = {c.lower() for c in df.columns}
    outputs = {t: unique_name(safe_name(f"{name}_tfidf_{t}"), taken) for t in vocabulary}
    kept = F.filter(tokens(F.coalesce(q(name).cast("string"), F.lit(""))),
                    lambda w: w.isin(*vocabulary))
    weighted = df.withColumn("_words", kept).withColumn("_weights", F.array(*[
        _occurrences("_words", t) * F.lit(idf[t]) for t in vocabulary]))
    normed = weighted.withColumn("_norm", F.sqrt(F.aggregate(
        "_weights", F.lit(0.0), lambda total, w: total + w * w)))
    columns = [F.when(F.col("_norm") > 0, F.col("_weights")[i] / F.col("_norm")).otherwise(F.lit(0.0))
               .alias(outputs[t]) for i, t in enumerate(vocabulary)]
    base = [q(c) for c in df.columns if keep or c != name]
    return normed.select(*base, *columns), [(name, "tfidf", outputs[t], t) for t in vocabulary]


def _occurrences(words: str, term: str) -> Column:
    return F.size(F.filter(words, lambda w: w == F.lit(term)))


# --- the whole step -------------------------------------------------------------------------

def engineer(cleaned: DataFrame, roles: Roles, vectorize_text: bool = True,
             encoding: str = "frequency", stop_words: tuple[str, ...] = STOP_WORDS,
             fit_on: DataFrame | None = None, text_columns: int = TEXT_COLUMNS,
             n_rows: int | None = None) -> Features:
    """Encode every column by its role; `fit_on` restricts what encodings are learnt from."""
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}")
    n = cleaned.count() if n_rows is None else n_rows
    log: list[tuple] = []
    out, log_rows = one_hot(cleaned, roles.low)
    log += log_rows
    deferred = list(roles.high) if encoding == "target" and roles.target else []
    for name in roles.high:
        if name in deferred:
            log.append((name, "target_deferred", name, None))
            continue
        out = frequency_encode(out, name, fit_on)
        log.append((name, "frequency", f"{name}_freq", None))
    for name in roles.datetimes:
        out, parts = expand_datetime(out, name)
        log += [(name, "datetime", p, None) for p in parts]
    centres = None
    if roles.has_geo:
        out, centres = add_geo(out, roles.lat, roles.lon, n)
        if centres:
            log += [(f"{roles.lat},{roles.lon}", "geo", c, None)
                    for c in ("geo_cluster", "geo_dist_to_centroid")]
    done: set[str] = set()
    if vectorize_text and n >= TEXT_MIN_ROWS:
        for name in roles.texts[:text_columns]:
            found = term_table(cleaned if fit_on is None else fit_on, name, stop_words=stop_words,
                               n_rows=n).collect()            # at most TEXT_TERMS rows
            if found:
                out, rows = tfidf(out, name, [(r["term"], r["idf"]) for r in found])
                log += rows
                done.add(name)
    unusable = [c for c in roles.of("identifier", "constant", "text", "unsupported") if c not in done]
    log += [(c, "drop", None, None) for c in unusable]
    out = out.drop(*[q(c) for c in unusable])
    return Features(out, [c for c in out.columns if c != roles.target], deferred, log, centres)
