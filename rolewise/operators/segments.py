"""Segments of the whole table over its numeric columns."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_double, field_types, q, row_hash
from ..functions.tables import hash_sample
from .kmeans import KMeansFit, assign, fit_sweep

MIN_ROWS = 20
MIN_COLUMNS = 2
CLUSTER_COUNTS = tuple(range(2, 9))
SCORE_ROWS = 5_000
MIN_SPREAD = 1e-8
SEARCH_SCHEMA = "k int, cost double, silhouette double, chosen boolean"


@dataclass
class Segments:
    k: int
    silhouette: float
    columns: list[str]
    moments: dict[str, tuple[float, float]]
    fit: KMeansFit
    search: list[tuple]
    labelled: DataFrame

    def sizes(self) -> DataFrame:
        return self.labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))

    def search_frame(self) -> DataFrame:
        return self.labelled.sparkSession.createDataFrame(self.search, SEARCH_SCHEMA)


def filled(df: DataFrame, names: list[str]) -> dict[str, Column]:
    types = field_types(df)
    return {n: F.coalesce(as_double(n, types[n]), F.lit(0.0)) for n in names}


def usable_columns(df: DataFrame, names: list[str]) -> dict[str, tuple[float, float]]:
    """Columns with some spread, NULLs read as 0: mean and population deviation."""
    cols = filled(df, names)
    if not cols:
        return {}
    row = df.agg(*[a for i, c in enumerate(cols.values()) for a in (
        F.stddev_samp(c).alias(f"s{i}"), F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"p{i}"))]).first()
    return {n: (row[f"m{i}"], row[f"p{i}"]) for i, n in enumerate(cols)
            if row[f"s{i}"] is not None and row[f"s{i}"] > MIN_SPREAD}


def standardise(df: DataFrame, moments: dict[str, tuple[float, float]], keep: list[str] = (),
                prefix: str = "") -> DataFrame:
    cols = filled(df, list(moments))
    scaled = [((cols[n] - F.lit(m)) / F.lit(s)).alias(f"{prefix}{n}") for n, (m, s) in moments.items()]
    return df.select(*[q(k) for k in keep], *scaled)


def silhouette_scores(df: DataFrame, columns: list[str], labels: list[str],
                      sample_size: int | None = SCORE_ROWS, keys: list[str] | None = None,
                      n_rows: int | None = None) -> dict[str, float | None]:
    """Mean silhouette of several labellings of the same rows, on at most `sample_size` rows.

    The sample is a constant number of rows, so it is sent to the tasks once; each task scores its
    share of it against all of it, for every labelling, from one distance block.
    """
    sample = df.select(*[q(c) for c in dict.fromkeys([*(keys or []), *columns, *labels])])
    sample = hash_sample(sample, sample_size or SCORE_ROWS, keys, n_rows=n_rows)
    points = sample.select(*[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
                           *[q(c).cast("long").alias(f"l{i}") for i, c in enumerate(labels)]).toPandas()
    if points.empty:
        return dict.fromkeys(labels)
    width = len(columns)
    x = points.iloc[:, :width].to_numpy(dtype=float)
    codes = points.iloc[:, width:].to_numpy(dtype=np.int64)
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((x, codes))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_x, all_codes = shared.value
        for batch in batches:
            rows = batch["row"].to_numpy()
            square = ((all_x[rows] ** 2).sum(1)[:, None] + (all_x ** 2).sum(1)[None, :]
                      - 2.0 * all_x[rows] @ all_x.T)
            apart = np.sqrt(np.maximum(square, 0.0))
            apart[np.arange(len(rows)), rows] = 0.0
            for which in range(all_codes.shape[1]):
                groups, member = np.unique(all_codes[:, which], return_inverse=True)
                sizes = np.bincount(member)
                totals = apart @ np.eye(len(groups))[member]
                own = member[rows]
                at = np.arange(len(rows))
                a = totals[at, own] / np.maximum(sizes[own] - 1, 1)
                means = totals / sizes
                means[at, own] = np.inf
                b = means.min(1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    s = np.where(sizes[own] > 1, (b - a) / np.maximum(a, b), 0.0)
                yield pd.DataFrame({"which": which, "s": [np.nan_to_num(s).sum()], "n": len(rows)})

    tasks = spark.sparkContext.defaultParallelism
    scores = (spark.range(0, len(x), 1, min(tasks, 64)).toDF("row")
              .mapInPandas(score, "which int, s double, n long")
              .groupBy("which").agg((F.sum("s") / F.sum("n")).alias("s")).collect())
    shared.unpersist()
    found = {r["which"]: r["s"] for r in scores}
    return {label: found[i] if len(np.unique(codes[:, i])) > 1 else None
            for i, label in enumerate(labels)}


def squared_silhouettes(df: DataFrame, columns: list[str], labels: list[str]) -> dict[str, float | None]:
    """Mean silhouette under squared Euclidean distance of several labellings, from all rows in two scans.

    The mean squared distance of a row to a cluster is its squared distance to the cluster's mean plus the cluster's
    variance, so counts, means and variances of the clusters (driver state: columns x clusters numbers) stand for all
    pairs.  Rows of a cluster of one score 0, as do rows with a = b = 0; a labelling of fewer than two clusters has no
    score.  Rows without a label and missing or non-finite values are not allowed.
    """
    rows = df.select(*[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
                     *[q(c).cast("long").alias(f"l{i}") for i, c in enumerate(labels)])
    x = [f"x{i}" for i in range(len(columns))]
    keyed = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.col(f"l{i}").alias("label")) for i in range(len(labels))]))
    spread = sum((F.var_pop(c) for c in x), F.lit(0.0))
    found = (rows.select(*x, keyed.alias("_k")).groupBy("_k.which", "_k.label")
             .agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in x]).alias("mean"), spread.alias("spread")).collect())
    clusters = {}
    for i in range(len(labels)):
        mine = sorted((r for r in found if r["which"] == i), key=lambda r: r["label"])
        clusters[i] = tuple(np.array([r[c] for r in mine]) for c in ("label", "n", "mean", "spread"))
    scored = [i for i, (codes, *_) in clusters.items() if len(codes) > 1]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points, at = batch[x].to_numpy(dtype=float), np.arange(len(batch))
            for i in scored:
                codes, sizes, means, spreads = clusters[i]
                own = np.searchsorted(codes, batch[f"l{i}"].to_numpy())
                apart = np.column_stack([((points - m) ** 2).sum(1) + v for m, v in zip(means, spreads)])
                a = apart[at, own] * sizes[own] / np.maximum(sizes[own] - 1, 1)
                apart[at, own] = np.inf
                b = apart.min(1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    s = np.where(sizes[own] > 1, (b - a) / np.maximum(a, b), 0.0)
                yield pd.DataFrame({"which": [i], "s": [np.nan_to_num(s).sum()], "n": [len(batch)]})

    sums = {}
    if scored:
        sums = {r["which"]: r["s"] for r in rows.mapInPandas(score, "which int, s double, n long").groupBy("which").agg(
            (F.sum("s") / F.sum("n")).alias("s")).collect()}
    return {label: sums.get(i) for i, label in enumerate(labels)}


def find_segments(df: DataFrame, names: list[str], keys: list[str] | None = None,
                  ks: tuple[int, ...] = CLUSTER_COUNTS, restarts: int = 10, seed: int = 42,
                  n_rows: int | None = None) -> Segments | None:
    """Cluster count by silhouette, smaller k on a tie; NULL result where the gates do not pass."""
    n = df.count() if n_rows is None else n_rows
    if len(names) < MIN_COLUMNS or n < MIN_ROWS:
        return None
    moments = usable_columns(df, names)
    if len(moments) < MIN_COLUMNS:
        return None
    columns = list(moments)
    with_key = df.withColumn("_row_key", row_hash(df, keys, seed))
    keys = [k for k in keys or [] if k not in ("row_key", "cluster")]
    scaled = standardise(with_key, moments, [*keys, "_row_key"], "z_").withColumnRenamed("_row_key", "row_key")
    z = [f"z_{c}" for c in columns]
    fits = fit_sweep(scaled, z, list(ks), restarts, seed, n)
    labelled = scaled.select("*", *[assign(z, f.centres).alias(f"k{k}") for k, f in fits.items()])
    scores = silhouette_scores(labelled, z, [f"k{k}" for k in fits], min(SCORE_ROWS, n - 1),
                               ["row_key"], n)
    scored = {k: scores[f"k{k}"] for k in sorted(fits) if scores[f"k{k}"] is not None}
    if not scored:
        return None
    best = max(scored, key=lambda k: (scored[k], -k))
    search = [(k, f.cost, scored.get(k), k == best) for k, f in sorted(fits.items())]
    out = scaled.select(*[q(k) for k in keys], "row_key", *z,
                        assign(z, fits[best].centres).alias("cluster"))
    return Segments(best, scored[best], columns, moments, fits[best], search, out)
