import math

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from support import rows
from lodeworks.operators import clusters, features, indexing
from lodeworks.sources import materialize


def test_thermometer_bounds(frame):
    df = frame("x long", (0,), (1,), (2,), (3,), (32768,), (32769,), (65536,), (None,))
    hot = features.thermometer(df, "x", prefix="T").collect()
    assert len(hot[0]) == 18
    sums = [None if r["x"] is None else sum(v for k, v in r.asDict().items() if k != "x") for r in hot]
    assert sums == [0, 1, 2, 3, 16, 17, 17, None]
    assert all(v is None for v in hot[-1].asDict().values())


def test_multi_hot_uses_all_n_and_breaks_ties_by_name(frame):
    df = frame("id int, p array<string>", (1, ["b", "a", "b"]), (2, ["a", "b"]), (3, ["c"]), (4, ["d"]))
    hot = features.multi_hot_topn(df, "p", 3)
    assert hot.columns == ["id", "p", "Porta", "Portb", "Portc"]
    assert [tuple(r[2:]) for r in hot.orderBy("id").collect()] == [
        (True, True, False), (True, True, False), (False, False, True), (False, False, False),
    ]
    names = [r["item"] for r in features.top_items(df, "p", 3).collect()]
    vector = features.multi_hot_vector(df, "p", names, "v").orderBy("id")
    assert [list(r[0]) for r in vector.select(vector_to_array("v")).collect()] == [
        [1, 1, 0], [1, 1, 0], [0, 0, 1], [0, 0, 0],
    ]


def test_a_hot_column_counts_as_often_as_its_item(spark, frame):
    df = frame("p array<string>", *[([str(i % 5), str(i % 3)],) for i in range(60)])
    top = features.top_items(df, "p", 1).first()
    hot = features.multi_hot_topn(df, "p", 1)
    assert hot.where(F.col(f"Port{top['item']}")).count() == top["n"]


def test_single_port_strings_stay_text(spark, tmp_path):
    from lodeworks.sources import read_table

    (tmp_path / "s.csv").write_text("ports_scanned_str,numports\n23,1\n0080,1\n")
    df = read_table(spark, str(tmp_path / "s.csv"), "csv", schema="ports_scanned_str string, numports int")
    assert rows(df) == [("0080", 1), ("23", 1)]


@pytest.mark.parametrize("max_labels", [10_000, 2])
def test_string_index_orders_by_frequency_then_value(frame, max_labels):
    df = frame("v string", *[(v,) for v in "zzzaabbccd"])
    got = dict(rows(features.string_index(df, "v", "i", max_labels).distinct()))
    assert got == {"z": 0.0, "a": 1.0, "b": 2.0, "c": 3.0, "d": 4.0}
    fitted = StringIndexer(inputCol="v", outputCol="i").fit(df)
    assert list(fitted.labels) == sorted(got, key=got.get)


def test_index_round_trip(frame):
    df = features.string_index(frame("v string", ("x",), ("y",), ("x",)), "v", "i")
    assert all(r["v"] == r["w"] for r in features.index_to_string(df, "i", "w").collect())
    named = features.index_to_string(df.select((F.col("i") * 1.0).alias("j")), "j", "w", labels=["x", "y"])
    assert rows(named.select("w")) == [("x",), ("x",), ("y",)]


@pytest.mark.parametrize("partitions,merge", [(1, "true"), (5, "false")])
def test_dense_index_is_the_global_order(spark, partitions, merge, monkeypatch):
    stored = []
    monkeypatch.setattr(indexing, "materialize", lambda df, name: stored.append(materialize(df, name)) or stored[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
    df = spark.range(0, 5000, numPartitions=partitions).select((F.col("id") * 7919 % 5003).alias("k"))
    got = indexing.dense_index(df, ["k"], "i").collect()
    assert [r["i"] for r in sorted(got, key=lambda r: r["k"])] == list(range(5000))
    down = indexing.dense_index(df, [F.desc("k")], "i").collect()
    assert [r["i"] for r in sorted(down, key=lambda r: -r["k"])] == list(range(5000))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert stored[0].select("_range").distinct().count() == (4 if merge == "false" else 1)


def test_missing_marker(frame):
    df = frame("x string", ("3",), ("?",), ("",), (None,), ("5",))
    clean = features.clean_missing(df, "x")
    assert [r[0] for r in clean.collect()] == [3, None, None, None, 5]
    assert [r[0] for r in features.impute(clean, ["x"]).collect()] == [3, 4, 4, 4, 5]


def test_scaling(frame):
    df = frame("a int, b array<int>", (255, [0, 51]))
    assert features.scale(df, ["a"], 255).first()["a"] == 1.0
    assert features.scale_array(df, "b", 255).first()["b"] == [0.0, 0.2]


@pytest.fixture
def assigned(frame):
    return frame(
        "cluster int, mirai boolean, A boolean, B boolean",
        *[(1, True, True, False)] * 4, (1, False, False, True), (2, False, False, False), (3, False, True, True),
    )


def test_profile_has_only_clusters_that_exist(assigned):
    profile = clusters.cluster_profile(assigned, ["mirai"])
    assert rows(profile) == [(1, 5, 0.8), (2, 1, 0.0), (3, 1, 0.0)]
    assert rows(clusters.clusters_above(profile, "mirai", 0.8)) == [(1, 5, 0.8)]
    assert clusters.rows_of(assigned, clusters.clusters_above(profile, "mirai", 0.8)).count() == 5
    assert clusters.rows_of(assigned, clusters.clusters_above(profile, "mirai", 0.9)).count() == 0


def test_cluster_features_and_dominant(assigned):
    found = clusters.cluster_features(assigned, ["A", "B"])
    assert rows(found) == [(1, "A", 4), (1, "B", 1), (3, "A", 1), (3, "B", 1)]
    assert clusters.cluster_features(assigned, ["A", "B"], keep_zero=True).count() == 6
    best = clusters.dominant_feature(found, clusters.cluster_sizes(assigned))
    assert rows(best) == [(1, "A", 4, 0.8), (3, "A", 1, 1.0)]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.2, size=(60, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, x double, y double")


def test_kmeans_assigns_the_nearest_centre(blobs):
    model = clusters.fit_kmeans(blobs, ["x", "y"], 3)
    got = clusters.assign_clusters(model, blobs, ["x", "y"])
    assert sorted(r["size"] for r in clusters.cluster_sizes(got).collect()) == [60, 60, 60]
    centers = clusters.cluster_centers(blobs, model)
    arrays = blobs.select("id", F.array("x", "y").alias("v"))
    near = {r["id"]: r["cluster"] for r in clusters.nearest_centroid(arrays, "v", centers).collect()}
    assert near == {r["id"]: r["cluster"] for r in got.collect()}
    assert clusters.silhouette(got).first()[0] > 0.9
    profile = clusters.cluster_profile(got.withColumn("low", F.col("x") < 2.5), ["low"], model=model)
    assert profile.agg(F.sum("size")).first()[0] == 180 and "center" in profile.columns


def test_silhouette_equals_the_definition(blobs):
    local = [(r["x"], r["y"], r["id"] % 3) for r in blobs.collect()]

    def mean(p, group, own):
        return sum((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 for q in group) / (len(group) - own)

    scores = []
    for p in local:
        groups = {c: [q for q in local if q[2] == c] for c in range(3)}
        a = mean(p, groups[p[2]], 1)
        b = min(mean(p, g, 0) for c, g in groups.items() if c != p[2])
        scores.append((b - a) / max(a, b))
    given = blobs.select((F.col("id") % 3).alias("cluster"), array_to_vector(F.array("x", "y")).alias("features"))
    assert math.isclose(clusters.silhouette(given).first()[0], sum(scores) / len(scores), rel_tol=1e-9)


@pytest.mark.parametrize("k", [3, 8])
def test_collapsed_points_give_the_score_of_all_rows(spark, k):
    bits = spark.range(700).select(*[((F.col("id") * F.col("id") % 11).bitwiseAND(1 << i) > 0).alias(f"b{i}") for i in range(3)])
    cols = ["b0", "b1", "b2"]
    points = clusters.collapse_points(bits, cols)
    assert points.count() < 9 and points.agg(F.sum("w")).first()[0] == 700
    model = clusters.fit_kmeans(bits, cols, k, collapse=True)
    on_points = clusters.silhouette_of_copies(clusters.assign_clusters(model, points, cols), "w").first()[0]
    on_rows = clusters.silhouette(clusters.assign_clusters(model, bits, cols)).first()[0]
    assert math.isclose(on_points, on_rows, abs_tol=1e-9)


def test_single_row_clusters_score_zero(frame):
    given = frame("w int, cluster int, x double", (1, 0, 0.0), (1, 1, 5.0), (2, 2, 9.0), (1, 2, 9.5))
    points = given.withColumn("features", array_to_vector(F.array("x")))
    copies = points.withColumn("_c", F.explode(F.sequence(F.lit(1), "w"))).drop("_c")
    want = clusters.silhouette(copies).first()[0]
    assert math.isclose(clusters.silhouette_of_copies(points, "w").first()[0], want, rel_tol=1e-12)


def test_fewer_points_than_clusters(frame):
    df = frame("x double", (0.0,), (0.0,), (1.0,))
    row = clusters.compare_k(df, ["x"], [5]).first()
    assert row["k_asked"] == 5 and row["k_found"] == 2 and row["largest"] == 2
    one = clusters.compare_k(frame("x double", (1.0,), (1.0,)), ["x"], [3]).first()
    assert one["k_found"] == 1 and one["silhouette"] is None


def test_nearest_centre_of_odd_vectors_and_without_centres(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [5.0]), (5, [9.0, 9.0])], "id int, v array<double>")
    centers = spark.createDataFrame([(7, 0, 0.0), (7, 1, 0.0), (8, 0, 9.0), (8, 1, 8.0)], "cluster int, dim int, value double")
    found = clusters.nearest_centroid(df, "v", centers)
    assert rows(found.select("id", "cluster", "distance")) == [(1, 7, 1.0), (2, None, None), (3, None, None), (4, None, None), (5, 8, 1.0)]
    none = clusters.nearest_centroid(df, "v", centers.limit(0))
    assert rows(none.select("id", "cluster", "distance")) == [(i, None, None) for i in range(1, 6)]
