"""Evaluation tables computed from scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.rounding import round_to


def class_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """M4: n / (classes * n_class) on every row."""
    counts = df.groupBy(F.col(label).alias("_wl")).agg(F.count(F.lit(1)).alias("_wn"))
    totals = counts.agg(F.struct(F.sum("_wn").alias("n"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    table = counts.withColumn("_t", totals).select("_wl", (F.col("_t.n") / (F.col("_t.k") * F.col("_wn"))).alias(weight))
    # One row per class, and Spark ML takes 100 classes at most.
    return df.join(F.broadcast(table), F.col(label) == F.col("_wl")).drop("_wl")


def confusion(df: DataFrame, label: str, prediction: str, classes: int) -> DataFrame:
    """Counts on the full grid of actual and predicted class."""
    seen = df.groupBy(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(classes * classes).select(
        F.floor(F.col("id") / classes).cast("int").alias("actual"), (F.col("id") % classes).cast("int").alias("predicted"))
    return grid.join(seen, ["actual", "predicted"], "left").na.fill(0, ["n"])


def class_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class from a confusion table."""
    # The table has classes^2 rows; each class collects its row and its column.
    long = matrix.select(F.explode(F.array(
        F.struct(F.col("actual").alias("c"), F.lit("a").alias("r")), F.struct(F.col("predicted").alias("c"), F.lit("p").alias("r")),
    )).alias("e"), "actual", "predicted", "n")
    per = long.groupBy(F.col("e.c").alias("clase")).agg(
        F.sum(F.when((F.col("e.r") == "a") & (F.col("actual") == F.col("predicted")), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("e.r") == "a", F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("e.r") == "p", F.col("n")).otherwise(0)).alias("predicted"),
    )
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return per.select(
        "clase", zero(F.col("tp"), F.col("predicted")).alias("precision"), zero(F.col("tp"), F.col("support")).alias("recall"),
        zero(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"), "support", "tp", "predicted",
    )


def summary(matrix: DataFrame, average: str = "macro") -> DataFrame:
    """Macro F1 (or F1 of class 1 for ``'binary'``) and accuracy of a confusion table.

    The macro mean is over the classes that occur or are predicted.
    """
    rep = class_report(matrix)
    f1 = F.avg(F.when(F.col("support") + F.col("predicted") > 0, F.col("f1"))) if average == "macro" else F.max(F.when(F.col("clase") == 1, F.col("f1")))
    return rep.agg(f1.alias("f1"), (F.sum("tp") / F.sum("support")).alias("accuracy"))


def auc(df: DataFrame, positive: Column, score: Column) -> float:
    """Exact area under the ROC curve; ties count one half. Sorted and summed by Spark."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = df.select(positive.cast("double").alias("y"), score.cast("double").alias("s"))
    return BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(rows)


def auc_ovr_macro(df: DataFrame, label: str, scores: Sequence[Column]) -> float:
    """Mean over the classes of one class against the rest."""
    return sum(auc(df, F.col(label) == i, s) for i, s in enumerate(scores)) / len(scores)


def classification_metrics(df: DataFrame, label: str, prediction: str, scores: Sequence[Column]) -> DataFrame:
    """M9: macro AUC, macro F1 and accuracy as one row."""
    return summary(confusion(df, label, prediction, len(scores))).select(
        round_to(F.lit(auc_ovr_macro(df, label, scores)), 4).alias("auc_ovr_macro"),
        round_to("f1", 4).alias("f1_macro"), round_to("accuracy", 4).alias("accuracy"))


def binary_metrics(df: DataFrame, label: str, prediction: str, score: Column) -> DataFrame:
    """M11."""
    return summary(confusion(df, label, prediction, 2), "binary").select(
        round_to(F.lit(auc(df, F.col(label) == 1, score)), 4).alias("auc"),
        round_to("f1", 4).alias("f1"), round_to("accuracy", 4).alias("accuracy"))


def regression_metrics(df: DataFrame, actual_log: Column, predicted_log: Column) -> DataFrame:
    """R2 on the log scale and mean absolute error after the back-transform, in one pass."""
    rows = df.select(actual_log.alias("a"), predicted_log.alias("p"))
    sse, sst = F.sum(F.pow(F.col("a") - F.col("p"), F.lit(2.0))), F.var_pop("a") * F.count(F.lit(1))
    return rows.agg(
        round_to(1 - F.try_divide(sse, sst), 4).alias("r2_log"),
        F.avg(F.abs(F.expm1("a") - F.expm1("p"))).cast("bigint").alias("mae_owners"))
