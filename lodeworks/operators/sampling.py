"""Repeatable splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.columns import bucket_of


def assign_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[int], seed: int, out: str = "split"
) -> DataFrame:
    """Add the split number of each row; shares follow the integer ``weights``."""
    bucket = bucket_of(keys, sum(weights), seed)
    upper, split = 0, F.lit(len(weights) - 1)
    conditions = []
    for number, weight in enumerate(weights[:-1]):
        upper += weight
        conditions.append((upper, number))
    for bound, number in reversed(conditions):
        split = F.when(bucket < bound, F.lit(number)).otherwise(split)
    return df.withColumn(out, split.cast("int"))


def split_frames(
    df: DataFrame, keys: Sequence[str], weights: Sequence[int], seed: int
) -> list[DataFrame]:
    """The splits as separate frames with the input's columns."""
    marked = assign_split(df, keys, weights, seed, out="_split")
    return [marked.where(F.col("_split") == i).drop("_split") for i in range(len(weights))]
