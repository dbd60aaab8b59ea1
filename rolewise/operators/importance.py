"""Permutation importance and the illustrative shallow tree."""

from __future__ import annotations

import re

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ranks import running_sums
from .evaluate import class_metrics, confusion_counts, regression_metrics
from .models import SEED, Fitted, assembled

REPEATS = 5
TOP_FEATURES = 15
GOLDEN = 0.6180339887498949     # steps of this share of a circle never come close to each other
TREE_DEPTH = 3
NODE_SCHEMA = ("node int, parent int, depth int, feature string, threshold double, "
               "is_leaf boolean, prediction double, n long, share double")


def donor_rows(test: DataFrame, x: list[str], n_rows: int, repeats: int = REPEATS, order: Column | None = None) -> DataFrame:
    """Rows (repeat, row_key, y, x..., _donor): in each repeat every row with the features of another, each row giving once.

    Rows get exact positions in one global random order (by key hash, or `order`; equal keys by their place in the input).
    In a repeat a row takes the features of the row a fixed way ahead, round the end, met by a join on the position, so
    copies of a row neither share a group nor a task.  `n_rows` only sizes the ranges.
    """
    order = F.xxhash64(F.lit(SEED), "row_key") if order is None else order
    keyed = test.select("row_key", "y", *x).withColumns(
        {"_order": order, "_tie": F.monotonically_increasing_id(), "_one": F.lit(1)})
    placed = running_sums(keyed, [], ["_order", "row_key", "_tie"], {"_one": "_pos"}, n_rows).select(
        "row_key", "y", *x, "_pos", F.col("total__one").alias("_n"))
    ways = F.array(*[F.struct(F.lit(r).alias("repeat"), F.lit((r + 1) * GOLDEN % 1.0).alias("share")) for r in range(repeats)])
    ahead = F.floor((F.col("_n") - 1) * F.col("_way.share")) + 1
    asking = placed.withColumn("_way", F.explode(ways)).withColumn("_at", F.pmod(F.col("_pos") + ahead, F.col("_n")))
    giving = placed.select(F.col("_pos").alias("_at"), F.struct(*x).alias("_donor"))
    return asking.join(giving, "_at").select(F.col("_way.repeat").alias("repeat"), "row_key", "y", *x, "_donor")


def permutation_importance(fitted: Fitted, test: DataFrame, x: list[str], names: list[str], task: str,
                           n_rows: int, repeats: int = REPEATS, top: int = TOP_FEATURES, order: Column | None = None) -> DataFrame:
    """Mean loss of R² or weighted F1 when one feature is permuted, over all test rows.

    Each row is scored once per feature and repeat as it streams by; after the positions only per-variant sums shuffle.
    """
    rows = donor_rows(test, x, n_rows, repeats, order).withColumn("feature", F.explode(F.array(*[F.lit(i) for i in range(len(x))])))
    swapped = [F.when(F.col("feature") == i, F.col("_donor")[c]).otherwise(F.col(c)).alias(c) for i, c in enumerate(x)]
    permuted = fitted.apply(rows.select("feature", "repeat", "y", *swapped))
    base = fitted.apply(test.select("y", *x))
    by = ["feature", "repeat"]
    if task == "regression":
        whole = regression_metrics(base).first()["R2"]
        scores = regression_metrics(permuted, by=by).select(*by, F.col("R2").alias("score"))
    else:
        whole = class_metrics(confusion_counts(base)).first()["F1_weighted"]
        scores = class_metrics(confusion_counts(permuted, by=by), by).select(
            *by, F.col("F1_weighted").alias("score"))
    loss = scores.groupBy("feature").agg((F.lit(whole or 0.0) - F.avg("score")).alias("importance"),
                                         F.stddev_pop("score").alias("std"))
    lookup = test.sparkSession.createDataFrame(list(enumerate(names)), "feature int, name string")
    return (loss.join(F.broadcast(lookup), "feature")               # one row per feature
            .select(F.col("name").alias("feature"), "importance", "std")
            .orderBy(F.desc("importance"), "feature").limit(top))


_SPLIT = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")
_LEAF = re.compile(r"^(\s*)Predict: (\S+)$")


def read_tree(text: str) -> list[dict]:
    """Nodes of a tree from MLlib's own description, in preorder."""
    nodes: list[dict] = []
    path: list[tuple[int, bool]] = []            # (node, on the left side)
    for line in text.splitlines():
        split, leaf = _SPLIT.match(line), _LEAF.match(line)
        if split and split.group(2) == "If":
            node = {"id": len(nodes), "path": list(path), "feature": int(split.group(3)),
                    "threshold": float(split.group(5)), "prediction": None}
            nodes.append(node)
            path.append((node["id"], True))
        elif split:
            while not path[-1][1]:
                path.pop()
            path.append((path.pop()[0], False))
        elif leaf:
            nodes.append({"id": len(nodes), "path": list(path), "feature": None, "threshold": None,
                          "prediction": float(leaf.group(2))})
            while path and not path[-1][1]:
                path.pop()
    return nodes


def shallow_tree(train: DataFrame, x: list[str], names: list[str], task: str, n_rows: int) -> DataFrame:
    """A depth-3 tree as a node table with the share of training rows in each node."""
    kind = DecisionTreeRegressor if task == "regression" else DecisionTreeClassifier
    model = kind(featuresCol="features", labelCol="y", maxDepth=TREE_DEPTH, seed=SEED).fit(
        assembled(train, x).select("features", "y"))
    nodes = read_tree(model.toDebugString)
    counts = train.agg(*[F.count(F.when(_reaches(n, nodes, x), 1)).alias(f"n{n['id']}") for n in nodes]).first()
    rows = [(n["id"], n["path"][-1][0] if n["path"] else None, len(n["path"]),
             None if n["feature"] is None else names[n["feature"]], n["threshold"],
             n["feature"] is None, n["prediction"], counts[i], counts[i] / max(n_rows, 1))
            for i, n in enumerate(nodes)]
    return train.sparkSession.createDataFrame(rows, NODE_SCHEMA)


def _reaches(node: dict, nodes: list[dict], x: list[str]) -> Column:
    out = F.lit(True)
    for parent, left in node["path"]:
        value, threshold = F.col(x[nodes[parent]["feature"]]), nodes[parent]["threshold"]
        out = out & ((value <= threshold) if left else (value > threshold))
    return out
