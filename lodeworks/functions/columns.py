"""Numeric and indicator expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_of(keys: Sequence[str], buckets: int, seed: int) -> Column:
    """Bucket ``0..buckets-1`` from the row's key and the seed alone.

    The bucket does not depend on how the input is partitioned or on retries,
    unlike a random split, and any SQL engine can recompute it.
    """
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(buckets)).cast("int")


def thermometer_columns(col: Column, levels: int, prefix: str) -> dict[str, Column]:
    """``prefix_0: x > 0`` and ``prefix_{i+1}: x > 2**i`` for ``i`` below ``levels``."""
    bounds = [0] + [2**i for i in range(levels)]
    return {f"{prefix}_{i}": col > F.lit(b) for i, b in enumerate(bounds)}


def multi_hot_columns(arr: Column, items: Sequence[str], names: Sequence[str]) -> dict[str, Column]:
    """One boolean per item: does the array hold it? A null array holds nothing."""
    return {name: F.coalesce(F.array_contains(arr, item), F.lit(False)) for name, item in zip(names, items, strict=True)}


def scaled(col: Column, divisor: float) -> Column:
    return col.cast("double") / F.lit(float(divisor))
