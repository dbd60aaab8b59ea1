"""Model scores as aggregates; every function also scores many variants at once (`by`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import q, to_long
from ..functions.ranks import running_counts

REGRESSION_METRICS = ("MAE", "RMSE", "R2")
CLASS_METRICS = ("Accuracy", "F1_weighted", "Balanced_Accuracy")
PRIMARY = {"regression": "R2", "classification": "F1_weighted"}


def regression_metrics(df: DataFrame, y: str = "y", prediction: str = "prediction",
                       by: list[str] = ()) -> DataFrame:
    """MAE, RMSE and R² per group in one aggregate."""
    error = q(y) - q(prediction)
    total = F.var_pop(q(y)) * F.count(error)
    return df.groupBy(*[q(b) for b in by]).agg(
        F.avg(F.abs(error)).alias("MAE"), F.sqrt(F.avg(error * error)).alias("RMSE"),
        F.when(total > 0, F.lit(1.0) - F.sum(error * error) / total).alias("R2"))


def confusion_counts(df: DataFrame, y: str = "y", prediction: str = "prediction",
                     by: list[str] = ()) -> DataFrame:
    return (df.groupBy(*[q(b) for b in by], q(y).alias("actual"), q(prediction).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def class_metrics(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    """Accuracy, weighted F1 and balanced accuracy from confusion counts."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("actual").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("said"),
                 hit.cast("long").alias("hits")),
        F.struct(F.col("predicted").alias("c"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("said"), F.lit(0).cast("long").alias("hits")))
    per_class = (counts.select(*[q(b) for b in by], F.explode(sides).alias("s"))
                 .groupBy(*[q(b) for b in by], "s.c")
                 .agg(F.sum("s.support").alias("support"), F.sum("s.said").alias("said"),
                      F.sum("s.hits").alias("hits")))
    f1 = F.lit(2.0) * F.col("hits") / (F.col("support") + F.col("said"))
    return per_class.groupBy(*[q(b) for b in by]).agg(
        (F.sum("hits") / F.sum("support")).alias("Accuracy"),
        (F.sum(f1 * F.col("support")) / F.sum("support")).alias("F1_weighted"),
        F.avg(F.when(F.col("support") > 0, F.col("hits") / F.col("support"))).alias("Balanced_Accuracy"))


def confusion_matrix(df: DataFrame, labels: DataFrame, y: str = "y", prediction: str = "prediction"
                     ) -> DataFrame:
    """Counts for every pair of labels, zeros included; `labels` has one column `label`."""
    names = [r["label"] for r in labels.select("label").collect()]      # the classes
    pairs = labels.select(F.col("label").alias("actual"),
                          F.explode(F.array(*[F.lit(n) for n in names])).alias("predicted"))
    counts = confusion_counts(df, y, prediction)
    return (pairs.join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def roc_auc(df: DataFrame, label: str | Column = "y", score: str | Column = "score", by: list[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, per group (few): pairs ranked right plus half of the ties.

    Rows are first folded to counts per distinct score, then ranked range by range.
    """
    label = q(label) if isinstance(label, str) else label
    score = q(score) if isinstance(score, str) else score
    base = df.select(*[q(b) for b in by], F.when(label == 1, 1).otherwise(0).cast("long").alias("_pos"), score.alias("_score"))
    long = to_long(base, {"auc": F.col("_score").cast("double")}, [*by, "_pos"], "which", "value")
    counts = (long.filter("value is not null").groupBy(*by, "which", "value")
              .agg(F.sum("_pos").alias("pos"), F.sum(1 - F.col("_pos")).alias("neg")))
    ranked = running_counts(counts, [*by, "which"], "value", {"neg": "below"})
    won = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.groupBy(*by, "which").agg(
        F.when(pairs > 0, won / pairs).alias("ROC_AUC"), F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg")).drop("which")


def select_best(scores: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """Best and second model in a table (model, score); ties by name."""
    order = F.desc("score") if higher_is_better else F.asc("score")
    top = scores.filter("score is not null").orderBy(order, "model").limit(2).collect()
    rows = [(r["model"], float(r["score"]), i + 1) for i, r in enumerate(top)]
    return scores.sparkSession.createDataFrame(rows, "model string, score double, rank int")
