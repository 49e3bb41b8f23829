"""Equi-joins. The side sizes decide the strategy at run time (AQE), or a measured size does; never a guess."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.counts import count_by
from lodeworks.sources.scratch import materialize


def join_on(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join on shared column names."""
    return left.join(right, on=on if isinstance(on, str) else list(on), how="inner")


def hot_keys(df: DataFrame, on: str, share: float = 0.01, fraction: float = 0.01, seed: int = 1) -> list:
    """Values of ``on`` that hold about ``share`` of a sample of the rows, at most ``2 / share`` of them."""
    sampled = df.where(F.col(on).isNotNull()).select(on)
    sampled = materialize(sampled.sample(fraction, seed) if fraction < 1 else sampled, "sample")
    bound = share / 2 * sampled.count()  # half, as a sample may miss some
    return [r[on] for r in count_by(sampled, on).where(F.col("n") > max(1.0, bound)).orderBy(F.desc("n")).limit(int(2 / share)).collect()]


def skew_join(left: DataFrame, right: DataFrame, on: str, share: float = 0.01, fraction: float = 0.01,
              max_bytes: int = 64 << 20) -> DataFrame:
    """Inner join on one column whose hot keys, found by a sample of ``left``, are joined apart.

    The right rows of hot keys are few if keys of ``right`` hardly repeat: they are
    measured, and broadcast up to ``max_bytes``, so that the left rows of a hot key stay
    where they are. All other rows are shuffled as usual; so is everything if the rows
    are too many. Which keys are hot decides the plan, not the rows.
    """
    keys = hot_keys(left, on, share, fraction)
    if not keys:
        return join_on(left, right, on)
    hot = F.col(on).isin(keys)
    few = materialize(right.where(hot), "hot")
    size = few.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    if size > max_bytes:
        return join_on(left, right, on)
    cold = F.col(on).isNotNull() & ~hot
    return join_on(left.where(hot), F.broadcast(few), on).unionByName(join_on(left.where(cold), right.where(cold), on))


def left_join_fill(left: DataFrame, right: DataFrame, on: str, value: str, fill: int = 0) -> DataFrame:
    """Left outer join; ``value`` of the right side becomes ``fill`` where nothing matches."""
    joined = left.join(right.select(on, value), on=on, how="left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(fill)))


def two_period_counts(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Keys of the first period with their counts in both, by join of two counts."""
    return left_join_fill(
        count_by(first, key, out="n_first"), count_by(second, key, out="n_second"), key, "n_second"
    )


def two_period_trend(
    first: DataFrame,
    second: DataFrame,
    key: str,
    min_exclusive: int,
    total_min: int | None = None,
) -> DataFrame:
    """Keys with more than ``min_exclusive`` rows in the first period, and their total over both.

    Both periods go through one conditional aggregate: a single shuffle of
    partial counts and no join.
    """
    both = first.select(key, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionAll(
        second.select(key, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    counts = both.groupBy(key).agg(F.sum("_a").alias("n_first"), F.sum("_b").alias("n_second"))
    popular = counts.where(F.col("n_first") > min_exclusive).withColumn(
        "n_total", F.col("n_first") + F.col("n_second")
    )
    return popular if total_min is None else popular.where(F.col("n_total") > total_min)
