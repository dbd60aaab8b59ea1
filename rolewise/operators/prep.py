"""Preparation for models: labels, split, weights, feature selection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import as_double, field_types, q, row_hash, unit_interval
from ..functions.tables import spread, staged
from .association import anova_statistics
from .features import frequency_encode, level_codes, target_encode
from .profile import IMBALANCE_MIN

TEST_SHARE = 0.2
SEED = 42
MAX_FEATURES = 50
MIN_VARIANCE = 1e-8
CELLS = 1 << 20              # cells of the uniform number by which classes are cut
MAX_CLASSES = 10_000        # models keep state for each class on the driver; codes themselves have no limit
FOLDS = 5


@dataclass
class ModelFrame:
    """Rows ready for models: x0..xp, y, weight, is_train, fold, row_key."""

    table: DataFrame
    names: list[str]
    task: str
    labels: list[str] = field(default_factory=list)
    n_train: int = 0
    n_test: int = 0
    n_before: int = 0
    low_variance: list[str] = field(default_factory=list)
    unselected: list[str] = field(default_factory=list)
    encoded: list[str] = field(default_factory=list)
    is_imbalanced: bool = False
    weighted: bool = False
    min_class: int = 0

    @property
    def x(self) -> list[str]:
        return [f"x{i}" for i in range(len(self.names))]

    @property
    def train(self) -> DataFrame:
        return self.table.filter("is_train")

    @property
    def test(self) -> DataFrame:
        return self.table.filter("not is_train")


def label_codes(df: DataFrame, target: str) -> DataFrame:
    """Label, its code by string order, and its row count; any number of labels."""
    return level_codes(df, target)


def split_flag(df: DataFrame, unit: Column, test_share: float = TEST_SHARE) -> Column:
    """True for training rows.  `unit` is a uniform number per row, so no shuffle is needed."""
    return unit >= F.lit(test_share)


def train_test_split(df: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED,
                     keys: list[str] | None = None, unit: Column | None = None) -> DataFrame:
    """Adds `is_train`; the side of a row depends on its key only, not on its place."""
    unit = unit_interval(row_hash(df, keys, seed)) if unit is None else unit
    return df.withColumn("is_train", split_flag(df, unit, test_share))


def _class_parts(df: DataFrame, target: str, unit: Column, shares: list[float], name: str) -> DataFrame:
    """Adds the number of the part (0, 1, ...) of a row's class, cut at `shares` of the class's rows.

    Rows are ordered by the cell of their uniform number, rows of one cell stay together, and both ends of a class of
    two or more cells get rows.  Only counts per class and cell are shuffled, so neither a class of any size nor any
    number of classes meets in one place.
    """
    cell = F.floor(unit * CELLS).cast("long")
    cells = df.groupBy(q(target).alias("_class"), cell.alias("_cell")).agg(F.count(F.lit(1)).alias("n"))
    by_class = Window.partitionBy("_class")
    cells = cells.select("_class", "_cell", F.sum("n").over(by_class).alias("n"),
                         F.sum("n").over(by_class.orderBy("_cell")).alias("upto"))
    inner = F.col("upto") < F.col("n")
    cuts = cells.groupBy("_class").agg(*[F.coalesce(
        F.min(F.when(inner & (F.col("upto") >= F.greatest(F.lit(1), F.round(F.col("n") * F.lit(s)))), F.col("_cell"))),
        F.max(F.when(inner, F.col("_cell")))).alias(f"_cut{i}") for i, s in enumerate(shares)])
    part = sum((F.coalesce((F.col("_cell") > F.col(f"_cut{i}")).cast("int"), F.lit(1)) for i in range(len(shares))), F.lit(0))
    joined = df.withColumn("_cell", cell).join(cuts, q(target).eqNullSafe(F.col("_class")), "left")
    return joined.withColumn(name, part).drop("_cell", "_class", *[f"_cut{i}" for i in range(len(shares))])


def stratified_split(df: DataFrame, target: str, test_share: float = TEST_SHARE, seed: int = SEED,
                     keys: list[str] | None = None, unit: Column | None = None, flag: str = "is_train") -> DataFrame:
    """Adds the training flag with the share kept in every class; a class of one row is for training."""
    unit = unit_interval(row_hash(df, keys, seed)) if unit is None else unit
    return _class_parts(df, target, unit, [test_share], flag).withColumn(flag, F.col(flag) > 0)


def split_rows(df: DataFrame, target: str, task: str, test_share: float = TEST_SHARE, seed: int = SEED,
               keys: list[str] | None = None) -> DataFrame:
    """Adds `_row_key` and `_is_train`.  A table that has them already keeps them, so that a split made before features
    are learnt is the one that models see."""
    if "_row_key" not in df.columns:
        df = df.withColumn("_row_key", row_hash(df, keys, seed))
    if "_is_train" in df.columns:
        return df
    unit = unit_interval(F.xxhash64(F.lit(seed), "_row_key"))
    if task != "classification":
        return df.withColumn("_is_train", split_flag(df, unit, test_share))
    return stratified_split(df.withColumn("_kind", q(target).cast("string")), "_kind", test_share, unit=unit, flag="_is_train").drop("_kind")


def with_folds(df: DataFrame, task: str, folds: int, seed: int = SEED) -> DataFrame:
    """Adds `fold` to rows with row_key and y; every class is dealt evenly over the folds."""
    hashed = F.xxhash64(F.lit(seed + 7), "row_key")
    if task != "classification":
        return df.withColumn("fold", F.pmod(hashed, F.lit(folds)).cast("int"))
    return _class_parts(df, "y", unit_interval(hashed), [i / folds for i in range(1, folds)], "fold")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight rows / (classes * class rows) per label, with the imbalance ratio."""
    counts = df.filter(q(label).isNotNull()).groupBy(q(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
                       (F.max("n") / F.min("n")).alias("ratio")).first()
    n, k, ratio = total["n"] or 0, total["k"], total["ratio"]
    return counts.select("label", "n", (F.lit(float(n)) / (F.lit(float(k or 1)) * F.col("n"))).alias("weight"),
                         F.lit(ratio).cast("double").alias("imbalance_ratio"),
                         F.lit(bool(ratio and ratio >= IMBALANCE_MIN)).alias("is_imbalanced"))


def variances(df: DataFrame, names: list[str]) -> dict[str, float]:
    types = field_types(df)
    if not names:
        return {}
    row = df.agg(*[F.var_samp(F.coalesce(as_double(n, types[n]), F.lit(0.0))).alias(f"v{i}")
                   for i, n in enumerate(names)]).first()
    return {n: row[i] or 0.0 for i, n in enumerate(names)}


def target_correlations(df: DataFrame, names: list[str], target: str) -> dict[str, float]:
    """Pearson correlation of every column with the target in one aggregate."""
    types = field_types(df)
    y = as_double(target, types[target])
    row = df.agg(*[F.corr(F.coalesce(as_double(n, types[n]), F.lit(0.0)), y).alias(f"r{i}")
                   for i, n in enumerate(names)]).first()
    return {n: 0.0 if row[i] is None or row[i] != row[i] else row[i] for i, n in enumerate(names)}


def f_regression(df: DataFrame, names: list[str], target: str) -> DataFrame:
    """F of each column against a numeric target: r² / (1 - r²) * (n - 2)."""
    n = df.filter(q(target).isNotNull()).count()
    rows = [(c, r, _f_of(r, n)) for c, r in target_correlations(df, names, target).items()]
    return df.sparkSession.createDataFrame(rows, "feature string, r double, f double")


def _f_of(r: float, n: int) -> float:
    return float("inf") if abs(r) >= 1 else r * r / (1 - r * r) * (n - 2)


def f_classif(df: DataFrame, names: list[str], target: str) -> dict[str, float]:
    rows = anova_statistics(df, names, target).collect()              # one row per column
    return {r["feature"]: r["statistic"] or 0.0 for r in rows}


def top_correlated(df: DataFrame, names: list[str], target: str, k: int) -> list[str]:
    found = target_correlations(df, names, target)
    return sorted(names, key=lambda c: (-abs(found[c]), c))[:k]


def prepare(df: DataFrame, target: str, features: list[str], task: str,
            test_share: float = TEST_SHARE, seed: int = SEED, keys: list[str] | None = None,
            handle_imbalance: bool = True, feature_selection: bool = True,
            encode: list[str] = (), max_features: int = MAX_FEATURES, folds: int = FOLDS) -> ModelFrame:
    """Split, encode, coerce and select; the result is staged because every model reads it."""
    base = df if "_row_key" in df.columns else df.withColumn("_row_key", row_hash(df, keys, seed))
    labels: list[str] = []
    min_class, n_rows = 0, None
    if task == "classification":
        coded = staged(label_codes(base, target))
        if coded.count() > MAX_CLASSES:
            raise ValueError(f"target {target!r} has over {MAX_CLASSES} classes, too many for a model")
        rows = coded.orderBy("code").collect()
        labels, min_class = [r["label"] for r in rows], min((r["n"] for r in rows), default=0)
        n_rows = sum(r["n"] for r in rows)
        codes = coded.select(F.col("label").alias("_label"), F.col("code").cast("double").alias("_target"))
        base = base.withColumn("_label", q(target).cast("string")).join(F.broadcast(codes), "_label")
    else:
        base = base.withColumn("_target", as_double(target, field_types(df)[target])).filter("_target is not null")
    base = split_rows(base, target, task, test_share, seed)

    encodable = [c for c in encode if c in features]
    if encodable and len(labels) <= 2:
        inner = F.pmod(F.xxhash64(F.lit(seed + 11), "_row_key"), F.lit(FOLDS))
        base = target_encode(base, encodable, "_target", inner, F.col("_is_train"))
    for c in encodable if len(labels) > 2 else ():      # codes of several classes have no useful mean
        base = (frequency_encode(base, c, base.filter("_is_train")).withColumnRenamed(f"{c}_freq", c))

    types = field_types(base)
    flat = base.select(F.col("_row_key").alias("row_key"), F.col("_is_train").alias("is_train"), F.col("_target").alias("y"), *[
        F.coalesce(as_double(n, types[n]), F.lit(0.0)).alias(f"x{i}") for i, n in enumerate(features)])
    flat = with_folds(flat, task, folds, seed)
    flat = staged(spread(flat, base.count() if n_rows is None else n_rows))
    sizes = flat.agg(F.count(F.when(F.col("is_train"), 1)).alias("a"), F.count(F.lit(1)).alias("n")).first()
    train = flat.filter("is_train")
    names = dict(zip([f"x{i}" for i in range(len(features))], features))
    kept, dropped, unselected = list(names), [], []
    if feature_selection:
        variance = variances(train, kept)
        dropped = [c for c in kept if variance[c] <= MIN_VARIANCE]
        kept = [c for c in kept if c not in dropped]
        if len(kept) > max_features:
            if task == "classification":
                score = f_classif(train, kept, "y")
            else:
                score = {c: abs(r) for c, r in target_correlations(train, kept, "y").items()}
            best = set(sorted(kept, key=lambda c: (-score.get(c, 0.0), kept.index(c)))[:max_features])
            unselected = [c for c in kept if c not in best]
            kept = [c for c in kept if c in best]

    weighted, imbalanced = flat.withColumn("weight", F.lit(1.0)), False
    if task == "classification":
        weights = class_weights(train, "y").collect()                 # one row per class
        imbalanced = bool(weights and weights[0]["is_imbalanced"])
        if handle_imbalance and imbalanced:
            table = df.sparkSession.createDataFrame([(r["label"], r["weight"]) for r in weights],
                                                    "y double, _weight double")
            weighted = flat.join(F.broadcast(table), "y", "left").withColumn(
                "weight", F.coalesce("_weight", F.lit(1.0)))
    final = weighted.select("row_key", "is_train", "fold", "y", "weight", *[
        F.col(c).alias(f"x{i}") for i, c in enumerate(kept)])
    return ModelFrame(final, [names[c] for c in kept], task, labels, sizes["a"],
                      sizes["n"] - sizes["a"], len(features), [names[c] for c in dropped],
                      [names[c] for c in unselected], encodable, imbalanced,
                      handle_imbalance and imbalanced, min_class)
