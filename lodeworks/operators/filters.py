"""Row selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_prefix(df: DataFrame, prefix: str, col: str = "token") -> DataFrame:
    return df.where(F.col(col).startswith(prefix))


def filter_contains(df: DataFrame, arr: str, value: str) -> DataFrame:
    """Rows whose array holds ``value``."""
    return df.where(F.array_contains(arr, value))


def filter_min_items(df: DataFrame, arr: str, min_exclusive: int) -> DataFrame:
    """Rows whose array is longer than ``min_exclusive``."""
    return df.where(F.size(arr) > min_exclusive)


def having_more(df: DataFrame, min_exclusive: float, col: str = "n") -> DataFrame:
    """Groups whose aggregate is strictly above the bound."""
    return df.where(F.col(col) > min_exclusive)


def select_clusters(df: DataFrame, ids: Iterable[int], cluster: str = "cluster") -> DataFrame:
    return df.where(F.col(cluster).isin(*ids))


def filter_impact(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows before and after a filter and the share kept (null without rows), in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_before"), F.count_if(predicate).alias("n_after")
    )
    return counts.select("*", F.try_divide("n_after", "n_before").alias("kept_ratio"))
