"""Class balance and classification metrics as plain aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def class_balance(indexed: DataFrame, *, label: str, index: str) -> DataFrame:
    """Rows per class: (class, label, num_rows).

    Rows are first counted per (class, label), which hashes; a minimum of text
    would make Spark sort the whole table. The second step sees one row per
    class and label.
    """
    counts = indexed.groupBy(F.col(index).alias("class"), F.col(label).alias("label")).agg(
        F.count(label).alias("n")
    )
    return counts.groupBy("class").agg(
        F.min("label").alias("label"), F.sum("n").alias("num_rows")
    )


def label_metrics(
    predictions: DataFrame, *, label: str, prediction: str, positive: float = 0.0
) -> DataFrame:
    """One row with accuracy, and precision, recall, true and false positive
    rate of one label.

    All five come from one pass over the rows; only one partial row per task
    is shuffled. A rate whose base is empty is 0.
    """
    actual = F.col(label).cast("double") == positive
    predicted = F.col(prediction).cast("double") == positive
    correct = F.col(label).cast("double") == F.col(prediction).cast("double")
    counts = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(correct).alias("hits"),
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )

    def rate(part: str, *base: str):
        whole = sum((F.col(b) for b in base), F.lit(0))
        return F.when(whole == 0, F.lit(0.0)).otherwise(F.col(part) / whole)

    return counts.select(
        rate("hits", "n").alias("accuracy"),
        rate("tp", "tp", "fp").alias("precision"),
        rate("tp", "tp", "fn").alias("recall"),
        rate("tp", "tp", "fn").alias("true_positive_rate"),
        rate("fp", "fp", "tn").alias("false_positive_rate"),
    )
