"""Distinct counts over any range of days from one stored sketch per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

LG_K = 12  # a sketch has 2**LG_K cells; the standard error is about 1.04 / sqrt of that


def daily(df: DataFrame, ts: str, col: str, lg_k: int = LG_K) -> DataFrame:
    """``day, sketch``: values of ``col`` by day of ``ts``. Partial sketches are made where the rows lie; nulls count nowhere."""
    known = df.where(F.col(ts).isNotNull())
    return known.groupBy(F.to_date(ts).alias("day")).agg(F.hll_sketch_agg(col, lg_k).alias("sketch"))


def between(sketches: DataFrame, first: Column | str, last: Column | str) -> DataFrame:
    """``estimate``: distinct values from day ``first`` to day ``last``, by uniting their sketches."""
    lower, upper = (F.to_date(F.lit(d)) if isinstance(d, str) else d for d in (first, last))
    chosen = sketches.where(F.col("day").between(lower, upper))
    return chosen.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("estimate"))


def _back() -> WindowSpec:
    """From the last day back: a row a day, so one task holds them."""
    return Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def since(sketches: DataFrame) -> DataFrame:
    """``day, estimate``: distinct values from each day on, by uniting sketches from the last day back."""
    return sketches.select("day", F.hll_sketch_estimate(F.hll_union_agg("sketch").over(_back())).alias("estimate"))


def exact_since(df: DataFrame, ts: str, col: str) -> DataFrame:
    """``day, n``: the same counts exactly: a value counts from every day up to its last."""
    known = df.where(F.col(ts).isNotNull()).select(F.to_date(ts).alias("day"), F.col(col).alias("value"))
    last = known.where(F.col("value").isNotNull()).groupBy("value").agg(F.max("day").alias("day"))
    ended = last.groupBy("day").agg(F.count(F.lit(1)).alias("ended"))
    days = known.select("day").distinct().join(ended, "day", "left")
    return days.select("day", F.coalesce(F.sum("ended").over(_back()), F.lit(0)).alias("n"))


def within_bound(estimate: Column, exact: Column, lg_k: int = LG_K, sigmas: float = 4.0) -> Column:
    """Whether an estimate is within so many standard errors of the exact number."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(sigmas * 1.04 / 2 ** (lg_k / 2)))
