import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from support import rows
from lodeworks.operators import evaluation, joins, ratings, sampling


@pytest.fixture
def movies(frame):
    return frame(
        "MovieID int, MovieTitle string, Genres string",
        (1, "One, the \"first\"", "A|B"), (2, "Two", "A"), (3, "Three", "B|A|"), (4, "Four", ""), (5, "Five", None),
    )


@pytest.fixture
def rated(frame):
    per_movie = {1: [4, 4, 4], 2: [5, 3, 4], 3: [3, 3], 4: [5, 5, 5], 5: [5, 5, 5], 9: [1]}
    return frame("MovieID int, Rating double", *[(m, float(r)) for m, rs in per_movie.items() for r in rs])


def test_stats_in_one_pass(rated):
    got = {r[0]: (r[1], r[2]) for r in ratings.rating_stats(rated).collect()}
    assert got[2] == (4.0, 3) and got[9] == (1.0, 1)


def test_bounds_are_strict_and_ties_go_by_id(movies, rated):
    top = ratings.top_rated_in_genre(movies, rated, "A", 3.0, 2).collect()
    assert [(r["MovieID"], r["AvgRating"], r["TotalReviews"]) for r in top] == [(1, 4.0, 3), (2, 4.0, 3)]
    assert ratings.top_rated_in_genre(movies, rated, "A", 4.0, 2).count() == 0
    assert ratings.top_rated_in_genre(movies, rated, "A", 3.0, 3).count() == 0
    assert [r["MovieID"] for r in ratings.top_rated_in_genre(movies, rated, "A", 2, 1, n=1).collect()] == [1]


def test_movies_without_ratings_and_ratings_without_movie_drop_out(movies, rated):
    ids = {r["MovieID"] for r in ratings.rated_movies(movies, rated).collect()}
    assert ids == {1, 2, 3, 4, 5}


def test_unmatched_left_rows_get_the_default(frame):
    left, right = frame("k string, a int", ("x", 1), ("y", 2)), frame("k string, n int", ("x", 7))
    assert rows(joins.left_join_fill(left, right, "k", "n")) == [("x", 1, 7), ("y", 2, 0)]


def test_split_is_complete_disjoint_and_weighted(spark):
    df = spark.range(20_000)
    parts = sampling.split_frames(df, ["id"], [3, 1, 1], 137)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 20_000
    assert all(abs(n / 20_000 - w) < 0.02 for n, w in zip(sizes, (0.6, 0.2, 0.2), strict=True))
    assert parts[0].intersect(parts[1]).count() == 0
    again = sampling.split_frames(df.repartition(13), ["id"], [3, 1, 1], 137)[0]
    assert rows(again) == rows(parts[0])
    other = sampling.split_frames(df, ["id"], [3, 1, 1], 138)[0]
    assert rows(other) != rows(parts[0])


def test_f1_equals_the_evaluator(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).cast("double").alias("label"),
        F.when(F.col("id") % 7 < 5, F.col("id") % 3).otherwise(F.col("id") % 4).cast("double").alias("prediction"),
    )
    want = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert math.isclose(evaluation.f1_weighted(df, "label", "prediction").first()[0], want, rel_tol=1e-12)


def test_best_setting_and_ties(frame):
    grid = frame(
        "rank int, reg double, iters int, val_rmse double",
        (8, 0.1, 10, 0.5), (4, 0.1, 20, 0.5), (4, 0.1, 10, 0.5), (12, 0.01, 10, 0.9),
    )
    best = evaluation.mark_best(grid, "val_rmse", ["rank", "reg", "iters"])
    assert [tuple(r) for r in best.where("is_best").select("rank", "iters").collect()] == [(4, 10)]
    assert best.count() == 4


def test_skewed_join_is_split_at_run_time(spark):
    """A key with a third of the rows does not stay one task."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        big = spark.range(0, 300_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("MovieID"), F.col("id").alias("x")
        )
        small = spark.range(300_000).select(F.col("id").alias("MovieID"), (F.col("id") * 2).alias("y"))
        joined = joins.join_on(big, small, "MovieID")
        assert len(joined.collect()) == 300_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
