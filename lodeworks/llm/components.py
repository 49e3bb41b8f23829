"""Connected components of an edge table, by alternating star rounds.

Each round turns neighbourhoods into stars around their smallest node: first every node
points its greater neighbours at the smallest node it sees, then its smaller ones. The
rounds end when nothing changes; the number of rounds grows with the logarithm of the
component sizes. Each round is stored, so plans stay short and a lost executor costs
one round at most. Nothing is collected but a row count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.sources.scratch import materialize


def _smallest(edges: DataFrame) -> DataFrame:
    """For each ``u``, the smallest of it and its ``v``; stored, so that joins with it can split hot nodes."""
    least = edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("least"))
    return materialize(least, "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = materialize(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
    seen = both.where("v > u").join(_smallest(both), F.col("u") == F.col("node"))
    return seen.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = materialize(edges, "down")  # u > v
    seen = down.join(_smallest(down), F.col("u") == F.col("node"))
    pairs = F.array(F.struct(F.col("v").alias("u"), F.col("least").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("least").alias("v")))
    return seen.select(F.inline(pairs)).where("u > v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u, v``, in any direction) but the roots themselves."""
    now = materialize(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = materialize(_small_star(_large_star(now)), "star")
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
