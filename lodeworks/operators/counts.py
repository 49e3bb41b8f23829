"""Counting, sums, ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Every aggregate here has a map-side partial step, so a key that holds most of
# the rows reaches the shuffle as one row per task.


def count_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def sum_by(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(out))


def count_rows(df: DataFrame, out: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def count_distinct(df: DataFrame, col: str, out: str = "n", approximate: bool = False) -> DataFrame:
    """Number of distinct values; the sketch avoids the shuffle of all values."""
    counted = F.approx_count_distinct(col) if approximate else F.count_distinct(F.col(col))
    return df.agg(counted.alias(out))


def sort_counts(counts: DataFrame, key: str, by: str = "n") -> DataFrame:
    """Largest first; equal counts in key order."""
    return counts.orderBy(F.desc(by), key)


def top_k(counts: DataFrame, k: int, key: str, by: str = "n") -> DataFrame:
    """The first ``k`` of the sorted counts, without a full sort."""
    return sort_counts(counts, key, by).limit(k)
