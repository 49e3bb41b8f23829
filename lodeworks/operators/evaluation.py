"""Metrics as one-row frames: one aggregate each, no evaluator round trips."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def squared_errors(df: DataFrame, actual: str, predicted: str, out: str = "sq_error") -> DataFrame:
    return df.withColumn(out, F.pow(F.col(actual) - F.col(predicted), F.lit(2)))


def rmse(df: DataFrame, actual: str, predicted: str, out: str = "rmse") -> DataFrame:
    return squared_errors(df, actual, predicted, "_sq").agg(F.sqrt(F.avg("_sq")).alias(out))


def f1_weighted(df: DataFrame, label: str, predicted: str, out: str = "f1") -> DataFrame:
    """F1 per class, averaged with the class supports as weights.

    The rows collapse to the confusion counts first; the rest works on at most
    one row per pair of classes.
    """
    return f1_of_counts(df.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("_n")), label, predicted, "_n", out)


def f1_of_counts(counts: DataFrame, label: str, predicted: str, n: str, out: str = "f1") -> DataFrame:
    """The same from the confusion counts: how many rows ``n`` have each label and prediction."""
    confusion = counts.select(F.col(label).alias("_l"), F.col(predicted).alias("_p"), F.col(n).alias("_n"))
    # Each confusion cell adds to its true class and to its predicted class.
    sides = F.array(
        F.struct(
            F.col("_l").cast("string").alias("cls"),
            F.col("_n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.when(F.col("_l") == F.col("_p"), F.col("_n")).otherwise(0).cast("bigint").alias("hit"),
        ),
        F.struct(
            F.col("_p").cast(counts.schema[label].dataType).cast("string").alias("cls"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("_n").alias("predicted"),
            F.lit(0).cast("bigint").alias("hit"),
        ),
    )
    per_class = (
        confusion.select(F.inline(sides))
        .groupBy("cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
    )
    f1 = 2 * F.col("hit") / (F.col("support") + F.col("predicted"))
    return per_class.agg((F.sum(F.col("support") * f1) / F.sum("support")).alias(out))


def loss_and_accuracy(
    df: DataFrame, label: str, probability: str = "probability", predicted: str = "prediction"
) -> DataFrame:
    """Cross-entropy loss and accuracy of a classifier, in one pass."""
    true_probability = F.get(vector_to_array(F.col(probability)), F.col(label).cast("int"))
    return df.agg(
        F.avg(-F.log(F.greatest(true_probability, F.lit(1e-15)))).alias("loss"),
        F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"),
    )


def mark_best(metrics: DataFrame, metric: str, ties: list[str], out: str = "is_best") -> DataFrame:
    """Flag the configuration with the lowest metric (ties: smallest settings first).

    A metric that is null or not a number is no score and never wins; without any score
    nothing is flagged. ``metrics`` has one row per configuration, so the sort is over
    a handful.
    """
    scored = metrics.where(F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double")))
    best = scored.orderBy(metric, *ties).limit(1).select(*ties, F.lit(True).alias(out))
    return metrics.join(best, ties, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))
