"""k-means and what describes its clusters."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.counts import count_by
from lodeworks.operators.features import assemble
from lodeworks.sources.readers import rows_to_df
from lodeworks.sources.scratch import cached, materialize

MAX_IDS = 10_000  # cluster ids up to this many become a literal filter
BLOCK_VALUES = 4_000_000  # numbers of centres or cluster sums on the driver at a time


def collapse_points(df: DataFrame, cols: Sequence[str], weight: str = "w") -> DataFrame:
    """Distinct feature rows with their multiplicity.

    Indicator features take few distinct values, so billions of rows become a
    small weighted set with the same k-means objective.
    """
    return count_by(df, *cols, out=weight)


def fit_vectors(df: DataFrame, k: int, seed: int = 123, weight: str | None = None) -> KMeansModel:
    """Fit on the ``features`` column, each row counting ``weight`` times."""
    km = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster")
    if weight is not None:
        km = km.setWeightCol(weight)
    with cached(df.select("features", *([weight] if weight else []))) as (vectors,):
        return km.fit(vectors)


def fit_kmeans(
    df: DataFrame, cols: Sequence[str], k: int, seed: int = 123, collapse: bool = False
) -> KMeansModel:
    """Fit on the columns. ``collapse`` merges equal rows first (for indicator features)."""
    if collapse:
        return fit_vectors(assemble(collapse_points(df, cols), cols), k, seed, weight="w")
    return fit_vectors(assemble(df.select(*cols), cols), k, seed)


def assign_clusters(model: KMeansModel, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``features`` and ``cluster``."""
    return model.transform(assemble(df, cols))


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    return count_by(assigned, cluster, out="size")


def cluster_centers(df: DataFrame, model: KMeansModel) -> DataFrame:
    """``cluster, dim, value`` of the fitted centres (k times the dimension rows)."""
    rows = [
        (i, d, float(v)) for i, center in enumerate(model.clusterCenters()) for d, v in enumerate(center)
    ]
    return rows_to_df(df.sparkSession, rows, "cluster int, dim int, value double")


def cluster_means(assigned: DataFrame, vector: str, cluster: str = "cluster") -> DataFrame:
    """``cluster, dim, value`` of the mean vectors under a given assignment.

    Vectors are summed whole on the map side; only the k means are exploded.
    """
    means = assigned.groupBy(cluster).agg(
        Summarizer.mean(array_to_vector(F.col(vector))).alias("_mean")
    )
    return means.select(cluster, F.posexplode(vector_to_array("_mean")).alias("dim", "value"))


def cluster_profile(
    assigned: DataFrame,
    flags: Sequence[str],
    cluster: str = "cluster",
    model: KMeansModel | None = None,
) -> DataFrame:
    """``cluster, size, <flag>_ratio...`` and, with a model, the ``center`` vector.

    One aggregate over all clusters; a cluster without rows simply has no row.
    """
    ratios = [F.avg(F.col(f).cast("double")).alias(f"{f}_ratio") for f in flags]
    profile = assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), *ratios)
    if model is None:
        return profile
    centers = rows_to_df(
        assigned.sparkSession,
        [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())],
        f"{cluster} int, center array<double>",
    )
    return profile.join(centers, cluster)


def clusters_above(profile: DataFrame, flag: str, min_ratio: float) -> DataFrame:
    """Clusters in which the flag's share reaches ``min_ratio``."""
    return profile.where(F.col(f"{flag}_ratio") >= min_ratio)


def rows_of(
    assigned: DataFrame, chosen: DataFrame, cluster: str = "cluster", max_ids: int = MAX_IDS
) -> DataFrame:
    """Rows in the chosen clusters. Up to ``max_ids`` ids become a literal filter, so the
    rows are neither shuffled nor gathered on a cluster that holds most of them; more
    are joined, with the same rows."""
    listed = chosen.select(F.col(cluster).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    ids = [row[0] for row in listed.limit(max_ids + 1).collect()]
    if len(ids) > max_ids:
        return assigned.join(materialize(listed, "chosen"), F.col(cluster) == F.col("_id"), "left_semi")
    return assigned.where(F.col(cluster).isin(ids)) if ids else assigned.limit(0)


def investigate(
    assigned: DataFrame, flags: Sequence[str], flag: str, min_ratio: float, arr: str, cluster: str = "cluster"
) -> DataFrame:
    """``cluster, item, n, size, <flag>_ratio``: how often each item of ``arr`` is in the clusters whose
    share of ``flag`` reaches ``min_ratio``."""
    chosen = materialize(clusters_above(cluster_profile(assigned, flags, cluster), flag, min_ratio), "chosen")
    rows = rows_of(assigned, chosen, cluster).select(cluster, F.array_distinct(arr).alias("_items"))
    items = rows.select(cluster, F.explode("_items").alias("item")).groupBy(cluster, "item").agg(F.count(F.lit(1)).alias("n"))
    return items.join(chosen.select(cluster, "size", f"{flag}_ratio"), cluster)


def cluster_features(
    assigned: DataFrame, cols: Sequence[str], cluster: str = "cluster", keep_zero: bool = False
) -> DataFrame:
    """``cluster, feature, n``: rows of the cluster with the indicator set."""
    sums = assigned.groupBy(cluster).agg(*[F.count_if(F.col(c)).alias(c) for c in cols])
    long = sums.unpivot([cluster], list(cols), "feature", "n")
    return long if keep_zero else long.where(F.col("n") > 0)


def dominant_feature(features: DataFrame, sizes: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``cluster, feature, n, share`` of the most common indicator (ties: first name)."""
    # max over (count, reversed name order) is a plain partial aggregate, no window
    best = features.groupBy(cluster).agg(
        F.max("n").alias("n"), F.min(F.struct(-F.col("n"), F.col("feature"))).alias("_best")
    )
    return best.join(sizes, cluster).select(
        cluster,
        F.col("_best.feature").alias("feature"),
        "n",
        (F.col("n") / F.col("size")).alias("share"),
    )


def silhouette(assigned: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, one row ``silhouette``.

    Closed form over per-cluster sums: one pass, never pair by pair.
    """
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol=cluster)
    return rows_to_df(assigned.sparkSession, [(evaluator.evaluate(assigned),)], "silhouette double")


def silhouette_of_copies(
    assigned: DataFrame, weight: str, features: str = "features", cluster: str = "cluster",
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """The silhouette of the rows behind collapsed points, each standing for ``weight`` copies.

    A copy's own cluster without itself still holds its other copies, which a
    weighted evaluator would leave out. The distances of a point to all members
    of a cluster sum to ``N |x|^2 + S - 2 x.Y`` with the cluster's row count N,
    sum of squared norms S and vector sum Y (k rows, the size of the model).
    """
    vectors, w = F.col(features), F.col(weight).cast("double")
    measured = Summarizer.metrics("sum", "normL2").summary(vectors, w).alias("_m")
    sums = materialize(assigned.groupBy(F.col(cluster).alias("_c")).agg(measured, F.sum(w).alias("_n")).select(
        "_c", "_n", vector_to_array("_m.sum").alias("_y"), vector_to_array("_m.normL2").alias("_q")), "sums")
    # Clusters come to the driver a block at a time; what a row has seen of them is folded by columns.
    scored = assigned.select(w.alias("_w"), F.col(cluster).alias("_c"), vector_to_array(vectors).alias("_x"))
    folded = [_within(block)(F.col("_x"), F.col("_c")) for block in _blocks(sums, "_c", "_y", block_values)]
    inside = F.coalesce(*[f["inside"] for f in folded])
    outside = F.least(*[f["outside"] for f in folded]) if len(folded) > 1 else folded[0]["outside"]
    members = F.coalesce(*[f["members"] for f in folded])
    larger = F.greatest(inside, outside)
    known = (members > 1) & (larger > 0) & (outside < float("inf"))
    score = F.when(known, (outside - inside) / larger).otherwise(0.0)
    return scored.select("_w", score.alias("_s")).agg((F.sum(F.col("_w") * F.col("_s")) / F.sum("_w")).alias("silhouette"))


def _blocks(table: DataFrame, key: str, vector: str, max_values: int) -> list[pd.DataFrame]:
    """Rows with a vector each, in blocks of about ``max_values`` numbers (at least one block)."""
    n, size = table.agg(F.count(F.lit(1)), F.max(F.size(vector))).first()
    blocks = max(1, -(-n * (size or 1) // max_values))
    if blocks == 1:
        return [table.toPandas()]
    place = F.pmod(F.xxhash64(key), F.lit(blocks))
    return [part for b in range(blocks) if len(part := table.where(place == b).toPandas())]


def _within(sums: pd.DataFrame):
    """For rows and their clusters: mean distance inside, its members, and the least mean distance to others."""
    position = {c: i for i, c in enumerate(sums["_c"])}
    total = np.stack(sums["_y"].to_numpy())
    squares = (np.stack(sums["_q"].to_numpy()) ** 2).sum(axis=1)
    members = sums["_n"].to_numpy(dtype="float64")

    @F.pandas_udf("inside double, members double, outside double")
    def within(points: pd.Series, clusters: pd.Series) -> pd.DataFrame:
        x = np.stack(points.to_numpy())
        own = clusters.map(position).fillna(-1).to_numpy(dtype="int64")
        away = np.maximum((x**2).sum(axis=1)[:, None] * members + squares - 2 * x @ total.T, 0.0)
        here = np.flatnonzero(own >= 0)
        others = away / members
        others[here, own[here]] = np.inf
        inside = np.full(len(x), None, dtype=object)
        inside[here] = away[here, own[here]] / np.maximum(members[own[here]] - 1, 1)
        count = np.full(len(x), None, dtype=object)
        count[here] = members[own[here]]
        return pd.DataFrame({"inside": inside, "members": count, "outside": others.min(axis=1)})

    return within


def compare_k(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = 123, collapse: bool = False
) -> DataFrame:
    """``k_asked, k_found, largest, silhouette`` for several k; silhouette null for one cluster."""
    points = collapse_points(df, cols) if collapse else df.select(*cols, F.lit(1).alias("w"))
    vectors = assemble(points, cols).select("features", "w")
    rows = []
    with cached(vectors) as (vectors,):
        for k in ks:
            km = KMeans(
                k=k, seed=seed, featuresCol="features", predictionCol="cluster", weightCol="w"
            )
            assigned = km.fit(vectors).transform(vectors).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                sizes = assigned.groupBy("cluster").agg(F.sum("w").alias("size"))
                found, largest = sizes.agg(F.count(F.lit(1)), F.max("size")).first()
                score = None
                if found > 1:
                    scored = silhouette_of_copies(assigned, "w") if collapse else silhouette(assigned)
                    score = scored.first()[0]
            finally:
                assigned.unpersist()
            rows.append((k, found, largest, score))
    return rows_to_df(
        df.sparkSession, rows, "k_asked int, k_found bigint, largest bigint, silhouette double"
    )


def nearest_centroid(
    df: DataFrame, vector: str, centers: DataFrame, block_values: int = BLOCK_VALUES
) -> DataFrame:
    """Add ``cluster`` and squared ``distance`` of the nearest centre (ties: lowest cluster).

    Both are null where the vector is null, has nulls or another length, and everywhere without a centre.
    ``centers`` is ``cluster, dim, value``. They come to the driver in blocks of about
    ``block_values`` numbers; distances are matrix work on Arrow batches.
    """
    whole = centers.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("_d")).select(
        "cluster", F.transform("_d", lambda d: d["value"].cast("double")).alias("_v"))
    stored = materialize(whole, "centres")
    if stored.isEmpty():
        return df.withColumns({"cluster": F.lit(None).cast("int"), "distance": F.lit(None).cast("double")})
    blocks = _blocks(stored, "cluster", "_v", block_values)
    found = [_nearest(block)(F.col(vector)) for block in blocks]
    best = F.least(*found) if len(found) > 1 else found[0]
    width = len(blocks[0]["_v"].iloc[0])
    whole_vector = (F.size(vector) == width) & ~F.exists(vector, lambda x: x.isNull())
    near = df.withColumn("_near", F.when(whole_vector, best))
    return near.select(*df.columns, "_near.cluster", "_near.distance")


def _nearest(centers: pd.DataFrame):
    centers = centers.sort_values("cluster")
    ids, matrix = centers["cluster"].to_numpy(), np.stack(centers["_v"].to_numpy())

    @F.pandas_udf("distance double, cluster int")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        fits = np.array([v is not None and len(v) == matrix.shape[1] for v in vectors], bool)
        points = np.zeros((len(vectors), matrix.shape[1]))
        if fits.any():
            points[fits] = np.stack(vectors[fits].to_numpy()).astype("float64")
        distances = np.stack([((points - c) ** 2).sum(axis=1) for c in matrix], axis=1)
        best = distances.argmin(axis=1)
        return pd.DataFrame({"distance": np.where(fits, distances.min(axis=1), np.nan), "cluster": ids[best]})

    return nearest
