"""k-means from stated starting rows, in rounds that skip the distances they can do without.

Every row keeps its cluster, an upper bound of the distance to its centre and a lower
bound of the distance to any other. When the centres have moved, the upper bound grows
by the way of the row's own centre and the lower one falls by the longest way of any; a
row whose upper bound stays below its lower bound, or below half the way from its centre
to the next centre, keeps its cluster and no distance is computed. Assignments are those
of plain rounds. A round is one pass over the stored rows, which also sums the new
centres: a task hands on one row of sums for each of its clusters, so a cluster with most
rows is no heavier than the others.

The centres are on the driver (k times the number of dimensions). Ties go to the lowest
cluster. A cluster without rows keeps its centre. Rows whose vector is null, has nulls or
numbers that are not finite, or another length than the first centre, get no cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.sources.readers import rows_to_df
from lodeworks.sources.scratch import materialize
from lodeworks.sources.workers import importable

SLACK = 1e-9  # bounds are loosened by this share, for rounding
STATE = ("cluster", "upper", "lower")


@dataclass(frozen=True)
class Clustering:
    assigned: DataFrame  # the rows, with ``cluster`` and ``distance`` to the centre of the round before
    centers: DataFrame  # cluster, size, center
    rounds: DataFrame  # round, moved, n_distances, inertia


def first_rows(df: DataFrame, key: str, vector: str, k: int) -> np.ndarray:
    """The vectors of the ``k`` smallest keys: the stated start."""
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).orderBy(key).select(vector).limit(k).collect()
    return np.array([r[0] for r in rows], np.float64)


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Distances of all points and centres, a centre at a time: no table of all differences."""
    return np.sqrt(np.stack([((points - c) ** 2).sum(axis=1) for c in centers], axis=1))


def _assign(points: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centers: np.ndarray,
            near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters and bounds after a round, and the number of distances computed. ``near``: half the way to the next centre."""
    cluster, upper, lower, work = cluster.copy(), upper.copy(), lower.copy(), 0
    safe = np.maximum(lower, near[np.maximum(cluster, 0)])
    asked = np.flatnonzero((cluster < 0) | (upper >= safe * (1 - SLACK)))
    known = asked[cluster[asked] >= 0]
    if len(known):  # perhaps the distance itself is short enough
        upper[known] = np.sqrt(((points[known] - centers[cluster[known]]) ** 2).sum(axis=1))
        work += len(known)
        asked = asked[(cluster[asked] < 0) | (upper[asked] >= safe[asked] * (1 - SLACK))]
    if len(asked):
        all_ = _distances(points[asked], centers)
        work += all_.size
        own = all_.argmin(axis=1)
        cluster[asked], upper[asked] = own, all_[np.arange(len(asked)), own]
        all_[np.arange(len(asked)), own] = np.inf
        lower[asked] = all_.min(axis=1)
    return cluster, upper, lower, work


def _round(rows: DataFrame, at: int, width: int, centers: np.ndarray, ways: np.ndarray) -> DataFrame:
    """``rows`` with new states; the sums of each cluster of a task stand in the last of its rows of a batch."""
    between = _distances(centers, centers)
    np.fill_diagonal(between, np.inf)
    near = between.min(axis=1) / 2
    held = rows.sparkSession.sparkContext.broadcast((centers, ways, near))
    sums = "struct<size:bigint,moved:bigint,work:bigint,squares:double,total:array<double>,cluster:int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers, ways, near = held.value
        for batch in batches:
            points = batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            cluster, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False) for c in STATE)
            known = np.maximum(cluster, 0)
            new, upper, lower, work = _assign(points, cluster, (upper + ways[known]) * (1 + SLACK),
                                              (lower - ways.max(initial=0.0)) * (1 - SLACK), centers, near)
            squares = ((points - centers[new]) ** 2).sum(axis=1)
            parts: list[dict | None] = [None] * batch.num_rows
            for i, c in enumerate(np.unique(new).tolist()):
                own = new == c
                parts[i] = {"size": int(own.sum()), "moved": int((cluster[own] != c).sum()), "work": 0 if i else work,
                            "squares": float(squares[own].sum()), "total": points[own].sum(axis=0).tolist(), "cluster": c}
            columns = [pa.array(new.astype(np.int32)), pa.array(upper), pa.array(lower)]
            columns = [*[c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in (*STATE, "sums")], *columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.struct([
                ("size", pa.int64()), ("moved", pa.int64()), ("work", pa.int64()), ("squares", pa.float64()),
                ("total", pa.list_(pa.float64())), ("cluster", pa.int32())]))], names=names)

    kept = [f for f in rows.schema.fields if f.name not in (*STATE, "sums")]
    names = [*[f.name for f in kept], *STATE, "sums"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, f"{schema}, cluster int, upper double, lower double, sums {sums}")


def lloyd(df: DataFrame, vector: str, start: np.ndarray, rounds: int = 20) -> Clustering:
    """At most ``rounds`` rounds from the centres ``start``; they end when no row changes its cluster."""
    if rounds < 1 or not len(start):
        raise ValueError("at least one starting row and one round")
    clash = set(df.columns) & {*STATE, "sums", "distance"}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are names of results")
    spark = df.sparkSession
    importable(spark)
    centers = np.asarray(start, np.float64)
    width = centers.shape[1]
    fits = (F.size(vector) == width) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x) == float("inf")))
    fits = F.coalesce(fits, F.lit(False))
    state = df.where(fits).withColumns({"cluster": F.lit(-1), "upper": F.lit(0.0), "lower": F.lit(0.0)})
    ways, log = np.zeros(len(centers)), []
    sizes = np.zeros(len(centers), np.int64)
    for number in range(1, rounds + 1):
        used = centers
        state = materialize(_round(state, df.columns.index(vector), width, centers, ways), "clustered")
        summed = state.where("sums is not null").select("sums.*")
        totals = summed.groupBy("cluster").agg(F.sum("size"), F.sum("moved"), F.sum("work"), F.sum("squares")).collect()
        places = summed.select("cluster", F.posexplode("total")).groupBy("cluster", "pos").agg(F.sum("col").alias("v")).collect()
        sizes, moved = np.zeros(len(centers), np.int64), 0
        centers = centers.copy()
        for c, size, gone, _, _ in totals:
            sizes[c], moved = size, moved + gone
        for c, pos, value in places:
            centers[c, pos] = value / sizes[c]
        ways = np.sqrt(((centers - used) ** 2).sum(axis=1))
        log.append((number, moved, sum(t[3] for t in totals), float(sum(t[4] for t in totals))))
        if not moved:
            break
    apart = F.zip_with(F.col(vector), F.col("_center"), lambda a, b: (a - b) * (a - b))
    before = rows_to_df(spark, [(i, c.tolist()) for i, c in enumerate(used)], "_c int, _center array<double>")
    found = state.join(F.broadcast(before), F.col("cluster") == F.col("_c")).select(
        *df.columns, "cluster", F.sqrt(F.aggregate(apart, F.lit(0.0), lambda a, x: a + x)).alias("distance"))
    others = df.where(~fits).withColumns({"cluster": F.lit(None).cast("int"), "distance": F.lit(None).cast("double")})
    return Clustering(
        found.unionByName(others),
        rows_to_df(spark, [(i, int(n), c.tolist()) for i, (n, c) in enumerate(zip(sizes, centers, strict=True))],
                   "cluster int, size bigint, center array<double>"),
        rows_to_df(spark, log, "round int, moved bigint, n_distances bigint, inertia double"))
