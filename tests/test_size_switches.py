"""Bounds choose a plan, never a result: both sides of each switch on the same data."""

from contextlib import contextmanager

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from support import rows
from lodeworks.operators import clusters, evaluation, features, filters, itemsets, joins, neural, ratings, recommend, sampling
from lodeworks.plans import catalog, inputs, jobs
from lodeworks.sources import cached, lay_out, materialize, step
from lodeworks.streaming.token_counts import compact, latest_counts


# --- labels --------------------------------------------------------------------


@pytest.fixture
def labelled(frame):
    return frame("id int, v bigint", (1, 7), (2, 7), (3, 2**40), (4, None), (5, -1), (6, -1), (7, 7))


@pytest.mark.parametrize("nulls", ["keep", "skip"])
def test_label_bound_changes_no_row(labelled, nulls):
    few = features.string_index(labelled, "v", "i", 100, nulls)
    many = features.string_index(labelled, "v", "i", 1, nulls)
    assert few.columns == many.columns == ["id", "v", "i"]
    assert rows(few) == rows(many)
    assert (4 in {r["id"] for r in many.collect()}) == (nulls == "keep")


@pytest.mark.parametrize("bound", [1, 100])
def test_null_labels_are_an_error_by_default(labelled, bound):
    with pytest.raises(Exception):
        features.string_index(labelled, "v", "i", bound).collect()
    known = labelled.where("v is not null")
    assert features.string_index(known, "v", "i", bound).count() == 6


@pytest.mark.parametrize("bound", [1, 100])
def test_labels_come_back(labelled, bound):
    indexed = features.string_index(labelled, "v", "i", bound, "skip")
    again = features.index_to_string(indexed, "i", "t", features.label_table(labelled, "v"))
    assert {(r["v"], r["t"]) for r in again.collect()} == {(7, "7"), (2**40, str(2**40)), (-1, "-1")}


def test_many_hot_columns(frame):
    df = frame("id int, p array<string>", (1, [f"i{k:04d}" for k in range(600)]), (2, None))
    hot = features.multi_hot_topn(df, "p", 600)
    first, second = hot.orderBy("id").select(F.array(*hot.columns[2:])).collect()
    assert len(first[0]) == 600 and all(first[0]) and not any(second[0])


# --- ids -----------------------------------------------------------------------


@pytest.mark.parametrize("large", [10, 2**40])
def test_null_ids_stay_and_ids_come_back(frame, large):
    df = frame("u bigint, x int", (1, 1), (large, 2), (None, 3), (large, 4))
    got = recommend.with_int_id(df, "u", "n")
    assert got.count() == 4 and dict(got.dtypes)["n"] == "int"
    assert got.where("u is null").select("n").first()[0] is None
    back = recommend.with_original(got.where("n is not null").select("n", "x"), got, "n", "u")
    assert rows(back.select("u", "x")) == sorted([(1, 1), (large, 2), (large, 4)])


def test_jobs_take_large_ids(spark, tmp_path):
    path = tmp_path / "r.csv"
    base = 2**35
    path.write_text("UserID,MovieID,Rating\n" + "".join(
        f"{base + u},{base + m},{1 + (u * m) % 5}\n" for u in range(12) for m in range(8)))
    got = jobs.recommend_movies(spark, str(path), n=2, iters=2).collect()
    assert len(got) == 24 and all(r["UserID"] >= base and r["MovieID"] >= base for r in got)


# --- item sets -----------------------------------------------------------------


@pytest.fixture
def tricky(frame):
    """Items that hold separators, quotes and each other's names; a beginning shared by a third of all baskets."""
    sets = [["a", "b", "c\x1fd"], ["a", "b", "c", "d"], ["a", "b", 'c","d'], ["a", "b", "c", "d"], ["b", "c", "d"]]
    return frame("items array<string>", *[(s,) for s in sets * 6])


@pytest.mark.parametrize("switch,value", [("MAX_INLINE_ITEMS", 0), ("MAX_BROADCAST_BYTES", -1)])
def test_item_bounds_change_no_count(tricky, monkeypatch, switch, value):
    def found():
        weighted = itemsets.weigh_baskets(tricky, "items")
        return rows(itemsets.frequent_sets(weighted, 5, 4).select(F.to_json("items"), "size", "n"))

    want = found()
    assert ('["a","b"]', 2, 24) in want and ('["a","b","c","d"]', 4, 12) in want
    monkeypatch.setattr(itemsets, switch, value)
    assert found() == want


def test_levels_are_grown_once(tricky, monkeypatch):
    written = []
    real = itemsets.materialize
    monkeypatch.setattr(itemsets, "materialize", lambda df, name="step": written.append((name, df.columns)) or real(df, name))
    itemsets.frequent_sets(itemsets.weigh_baskets(tricky, "items"), 5, 4).collect()
    assert [n for n, _ in written].count("sets") == 3 and [n for n, _ in written].count("state") == 2
    # What is carried on is the open rest of a basket, not its whole tail.
    assert [c for n, c in written if n == "state"] == [["w", "item_1", "item_2", "_open"], ["w", "item_1", "item_2", "item_3", "_open"]]


# --- hot keys ------------------------------------------------------------------


@contextmanager
def small_partitions(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, n=400_000):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    return spark.range(0, n, numPartitions=8).select(key.alias("MovieID"), (F.col("id") % 7).cast("double").alias("Rating"), "id")


def test_join_with_stored_statistics_splits_a_hot_key(spark):
    with small_partitions(spark):
        rated = hot(spark)
        joined = joins.join_on(rated, materialize(ratings.rating_stats(rated.drop("id")), "stats"), "MovieID")
        assert joined.agg(F.count("*")).first()[0] == 400_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["rmse_metric", "grid_select_best", "rating_error_join"])
def test_registered_joins_read_stored_statistics(spark, sf_dir, name, monkeypatch):
    stored = []
    real = catalog.materialize
    monkeypatch.setattr(catalog, "materialize", lambda df, n="step": stored.append(n) or real(df, n))
    catalog.QUERIES[name](spark, sf_dir)
    assert {"stats", "means"} & set(stored)


def test_growing_is_salted_when_shuffled(spark, tricky, monkeypatch):
    monkeypatch.setattr(itemsets, "MAX_BROADCAST_BYTES", -1)
    plans = []
    real = itemsets.materialize
    monkeypatch.setattr(itemsets, "materialize", lambda df, name="step": plans.append(
        (name, df._jdf.queryExecution().optimizedPlan().toString())) or real(df, name))
    itemsets.frequent_sets(itemsets.weigh_baskets(tricky, "items"), 5, 4).collect()
    states = [p for n, p in plans if n == "state"]
    assert len(states) == 2 and all("_salt" in p and "_copy" in p for p in states)


# --- fits ----------------------------------------------------------------------


def test_layout_depends_on_the_rows_only(spark):
    df = spark.range(500).select("id", F.array(F.col("id") / 7, F.lit(1.0)).alias("v"))
    df = df.select("id", array_to_vector("v").alias("features"))
    seen = [[tuple(r) for r in lay_out(df.repartition(n), 5).withColumn("p", F.spark_partition_id()).collect()] for n in (1, 7)]
    assert seen[0] == seen[1]


def test_kmeans_does_not_depend_on_the_input_partitions(spark, sf_dir):
    points = inputs.digits(spark, sf_dir).select("vec_id", array_to_vector("embedding").alias("features"))
    got = []
    for n in (1, 7):
        parts = points.repartition(n)
        got.append(rows(clusters.fit_vectors(parts, 10).transform(parts).select("vec_id", "cluster")))
    assert got[0] == got[1]


def test_settings_without_a_score_never_win(spark, frame):
    grid = frame("rank int, e double", (1, None), (2, float("nan")), (3, 1.5), (4, 1.5))
    assert rows(evaluation.mark_best(grid, "e", ["rank"]).where("is_best").select("rank")) == [(3,)]
    assert evaluation.mark_best(grid.where("rank < 3"), "e", ["rank"]).where("is_best").count() == 0
    none = frame("rank int, reg double, iters int, val_rmse double", (4, 0.1, 5, None))
    pairs = frame("UserID int, ItemID int, Rating double", (1, 1, 1.0))
    assert rows(recommend.best_config(none, pairs, pairs).select("is_best", "test_rmse")) == [(False, None)]


@pytest.mark.parametrize("nulls", ["keep", "skip"])
def test_indexes_turn_back_alike_on_both_sides(frame, nulls):
    df = frame("v string", ("a",), ("b",), ("b",), (None,), ("__x",))
    few, many = (features.index_to_string(features.string_index(df, "v", "i", bound, nulls), "i", "t") for bound in (100, 1))
    assert rows(few.select("v", "i", "t")) == rows(many.select("v", "i", "t"))
    assert rows(many.where("v is null").select("t")) == ([("__unknown",)] if nulls == "keep" else [])


def test_curve_rows_are_direct_fits(spark, sf_dir):
    vectors = neural.vector_input(inputs.digits(spark, sf_dir), "embedding", "label", keep=["vec_id"])
    train, test = sampling.split_frames(vectors, ["vec_id"], [4, 1], 1)
    curve = neural.fit_curve(train, test, 64, 10, [[8]], [3, 9]).collect()
    for row in curve:
        with cached(train) as (kept,):
            model = neural.fit_mlp(kept, 64, 10, [8], row["iters"])
        loss, _ = evaluation.loss_and_accuracy(model.transform(test), "label").first()
        assert row["val_loss"] == pytest.approx(loss, rel=1e-6)


# --- what reaches the driver ---------------------------------------------------


def test_chosen_clusters_beyond_the_bound_are_joined(frame):
    df = frame("id int, cluster int", *[(i, i % 9) for i in range(90)], (100, None))
    chosen = df.where("cluster < 5").select("cluster").distinct()
    few, many = clusters.rows_of(df, chosen), clusters.rows_of(df, chosen, max_ids=2)
    assert rows(few) == rows(many) and few.count() == 50
    assert clusters.rows_of(df, chosen.limit(0), max_ids=0).count() == 0


def test_centres_in_blocks_give_the_same_rows(spark, sf_dir):
    digits = inputs.digits(spark, sf_dir)
    centres = clusters.cluster_means(digits, "embedding", "label").withColumnRenamed("label", "cluster")
    points = digits.select("vec_id", "embedding")
    one = clusters.nearest_centroid(points, "embedding", centres)
    several = clusters.nearest_centroid(points, "embedding", centres, block_values=100)
    assert rows(one.select("vec_id", "cluster")) == rows(several.select("vec_id", "cluster"))
    weighted = digits.select("label", array_to_vector("embedding").alias("features"), F.lit(1).alias("w"))
    want = clusters.silhouette_of_copies(weighted, "w", cluster="label").first()[0]
    assert clusters.silhouette_of_copies(weighted, "w", cluster="label", block_values=100).first()[0] == pytest.approx(want)
    assert clusters.silhouette(weighted, cluster="label").first()[0] == pytest.approx(want, rel=1e-6)


def test_impact_of_a_filter_on_nothing(frame):
    assert rows(filters.filter_impact(frame("x int"), F.col("x") > 1)) == [(0, 0, None)]


def test_steps_are_removed(spark):
    import os

    with step(spark.range(5), "short") as kept:
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert kept.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_sibling_files_are_no_events(spark, tmp_path):
    import shutil

    source = "/root/testdata/sf0.001/events.parquet"
    shutil.copy(source, tmp_path / "events.parquet")
    shutil.copy(source, tmp_path / "events.parquet.old")
    assert rows(catalog.stream_prefix_counts(spark, str(tmp_path))) == rows(
        catalog.stream_prefix_counts(spark, "/root/testdata/sf0.001"))


def test_folders_of_a_stream_are_merged(spark, frame, tmp_path):
    out = str(tmp_path)
    for batch, counted in enumerate([[("a", 1), ("b", 2)], [("a", 4)], [("c", 1)]]):
        frame("token string, n bigint", *counted).write.parquet(f"{out}/batch={batch}")
    want = rows(latest_counts(spark.read.parquet(out)))
    compact(spark, out, 1)
    compact(spark, out, 1)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["batch=1-all", "batch=2"]
    assert rows(latest_counts(spark.read.parquet(out))) == want == [("a", 4), ("b", 2), ("c", 1)]


def test_investigation_end_to_end(frame):
    df = frame("cluster int, mirai boolean, p array<string>", (1, True, ["23", "80"]), (1, True, ["23", "23"]), (2, False, ["80"]))
    got = clusters.investigate(df, ["mirai"], "mirai", 0.8, "p")
    assert rows(got.select("cluster", "item", "n", "size")) == [(1, "23", 2, 2), (1, "80", 1, 2)]


@pytest.mark.parametrize("size", [1, 2, 3])
def test_limited_sets_equal_mined_ones(tricky, size):
    grown = itemsets.itemsets(tricky, "items", 5, size).select(F.to_json("items"), "size", "n")
    mined = itemsets.itemsets(tricky, "items", 5).where(F.col("size") <= size).select(F.to_json("items"), "size", "n")
    assert rows(grown) == rows(mined)


def test_tuning_keeps_the_model_that_a_refit_gives(spark):
    pairs = spark.range(400).select((F.col("id") % 20).cast("int").alias("UserID"), (F.col("id") % 17).cast("int").alias("ItemID"),
                                    (F.col("id") % 5 + 1.0).alias("Rating"), "id")
    train, validation, test = sampling.split_frames(pairs, ["id"], [3, 1, 1], 7)
    grid = dict(ranks=[2], regs=[0.1, 0.5], iterations=[3])
    one = recommend.tune_and_test(train, validation, test, **grid).orderBy("reg").collect()
    two = recommend.best_config(recommend.tune_als(train, validation, **grid), train, test).orderBy("reg").collect()
    for a, b in zip(one, two, strict=True):
        assert a["is_best"] == b["is_best"] and a["val_rmse"] == pytest.approx(b["val_rmse"])
        assert a["test_rmse"] == (pytest.approx(b["test_rmse"]) if b["test_rmse"] is not None else None)


def test_recommendations_for_listed_users(spark, tmp_path):
    (tmp_path / "r.csv").write_text("UserID,MovieID,Rating\n" + "".join(f"{u},{m},{1 + (u * m) % 5}\n" for u in range(12) for m in range(8)))
    (tmp_path / "u.csv").write_text("UserID\n3\n99\n7\n")
    got = jobs.recommend_movies(spark, str(tmp_path / "r.csv"), n=2, iters=2, users=str(tmp_path / "u.csv"))
    assert rows(got.groupBy("UserID").count()) == [(3, 2), (7, 2)]
