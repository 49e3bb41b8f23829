"""What the physical plans must look like to hold at scale."""

import pytest

from __spark_entry__ import queries

PANDAS = {"nearest_centroid"}  # matrix work on Arrow batches


def plan(spark, sf_dir, name):
    return queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "word_count", "hashtag_count", "top_rated_in_genre", "two_period_trend", "frequent_pairs",
    "frequent_triples", "cluster_profile", "thermometer_encode", "string_index", "hash_split_3way",
    "rating_error_join", "grid_select_best", "cluster_dominant_feature",
])
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
        assert word not in text


def test_scans_read_only_the_needed_columns(spark, sf_dir):
    text = plan(spark, sf_dir, "top_rated_in_genre")
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    assert "struct<p_partkey:bigint,p_name:string>" in text


def test_period_bound_reaches_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "two_period_trend")
    assert "LessThan(ts" in text and "GreaterThanOrEqual(ts" in text
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_top_k_does_not_sort_everything(spark, sf_dir):
    for name in ("top_k_hashtags", "top_n_items", "top_rated_in_genre"):
        text = plan(spark, sf_dir, name)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_splits_are_computed_once(spark, sf_dir):
    assert plan(spark, sf_dir, "genre_count").count("split(replace") == 1


def test_statistics_need_one_shuffle(spark, sf_dir):
    assert plan(spark, sf_dir, "rating_stats").count("Exchange ") == 1
    assert plan(spark, sf_dir, "cluster_means").count("Exchange ") == 1


def test_large_ratings_are_filtered_by_genre_before_the_shuffle(spark, sf_dir):
    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    spark.conf.set(key, "1b")
    try:
        text = plan(spark, sf_dir, "top_rated_in_genre")
    finally:
        spark.conf.unset(key)
    assert text.index("Exchange hashpartitioning") < text.index("might_contain")
