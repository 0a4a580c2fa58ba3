"""Classifier quality from predictions."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_matrix(
    predictions: DataFrame, label: str = "tx_fraud", prediction: str = "prediction"
) -> DataFrame:
    """Number of rows per (label, prediction) that occurs."""
    return predictions.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom)


def class_metrics(
    predictions: DataFrame,
    positive_label: int | None = None,
    label: str = "tx_fraud",
    prediction: str = "prediction",
) -> DataFrame:
    """precision, recall, false-positive rate and F1 with each class as the positive one.

    ``positive_label`` restricts the result to one class: 1 gives the fraud
    metrics, 0 those of the legitimate class.
    """
    cells = confusion_matrix(predictions, label, prediction)
    classes = F.array(*[F.lit(float(c)) for c in ([positive_label] if positive_label is not None else [0, 1])])
    # The matrix has a handful of rows, so it can be repeated for each class.
    seen = cells.withColumn("positive_label", F.explode(classes))
    is_label = F.col("label") == F.col("positive_label")
    is_predicted = F.col("prediction") == F.col("positive_label")

    def n(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    counts = seen.groupBy("positive_label").agg(
        n(is_label & is_predicted).alias("tp"),
        n(~is_label & is_predicted).alias("fp"),
        n(is_label & ~is_predicted).alias("fn"),
        n(~is_label & ~is_predicted).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        F.col("positive_label").cast("int").alias("positive_label"),
        *["tp", "fp", "fn", "tn"],
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(fp, fp + tn).alias("fpr"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def acceptance(metrics: DataFrame, min_recall: float = 0.98, max_fpr: float = 0.05) -> DataFrame:
    """Add whether recall and false-positive rate meet their targets."""
    recall_ok = F.coalesce(F.col("recall") > min_recall, F.lit(False))
    fpr_ok = F.coalesce(F.col("fpr") <= max_fpr, F.lit(False))
    return metrics.withColumns(
        {"recall_ok": recall_ok, "fpr_ok": fpr_ok, "accepted": recall_ok & fpr_ok}
    )


def roc_auc(df: DataFrame, score: str, label: str = "tx_fraud", bins: int = 0) -> float:
    """Area under the ROC curve, equal scores counting half.

    ``bins = 0`` is exact; Spark's own default of 1000 down-samples the curve.
    Rows are first counted per distinct score, so that only those are sorted.
    """
    counts = (
        df.select(F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("label"))
        .dropna()
        .groupBy("score", "label")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="score",
        labelCol="label",
        weightCol="n",
        metricName="areaUnderROC",
        numBins=bins,
    )
    return evaluator.evaluate(counts)
