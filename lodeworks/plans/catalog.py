"""The registered queries: each applies operators to the whole input tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.functions.text import collapse_ws, split_literal
from lodeworks.operators import (
    bitmaps, clusters, counts, evaluation, factors, features, filters, heavy, itemsets, joins, lloyd, networks, neural,
    ratings, recommend, reshape, sampling, sketches, trees,
)
from lodeworks.plans import inputs
from lodeworks.sources import (
    load_model, materialize, new_path, read_lines, read_table, save_model, write_lines, write_table,
)
from lodeworks.sources import typed_projection as cast_to
from lodeworks.sources.scratch import swept
from lodeworks.streaming import (
    latest_counts, start_prefix_counts, start_window_counts, trend, window_counts,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- sources and sinks -------------------------------------------------------


@query
def csv_roundtrip(spark, sf):
    part = inputs.table(spark, sf, "part")
    path = new_path(spark, "csv")
    write_table(part, path, "csv")
    return read_table(spark, path, "csv", schema=part.schema)


@query
def csv_inferred(spark, sf):
    """A CSV whose types are inferred."""
    path = new_path(spark, "csv")
    write_table(inputs.table(spark, sf, "part"), path, "csv")
    read = read_table(spark, path, "csv", infer=True)
    kinds = [F.lit(dict(read.dtypes)[c]).alias(f"{c}_type") for c in ("p_partkey", "p_name", "p_retailprice")]
    return read.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_retailprice", *kinds)


@query
def text_lines(spark, sf):
    path = new_path(spark, "lines")
    write_lines(inputs.documents(spark, sf), path, ["text"])
    return read_lines(spark, path)


@query
def sink_roundtrip(spark, sf):
    path = new_path(spark, "sink")
    write_lines(genre_count(spark, sf), path, ["genre", "n"], sep="\t")
    fields = split_literal(F.col("value"), "\t")
    return read_lines(spark, path).select(fields[0].alias("genre"), fields[1].cast("bigint").alias("n"))


@query
def typed_projection(spark, sf):
    schema = T.StructType([
        T.StructField("p_partkey", T.IntegerType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_size", T.LongType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ])
    return cast_to(inputs.table(spark, sf, "part"), schema)


# --- projections -------------------------------------------------------------


@query
def select_columns(spark, sf):
    return inputs.ratings(spark, sf).select("UserID", "MovieID", "Rating")


@query
def derive_columns(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return reshape.with_columns(lines, {
        "is_bulk": F.col("l_quantity") > 25,
        "half_price": F.col("l_extendedprice") / 2,
    })


@query
def split_array(spark, sf):
    split = reshape.split_to_array(inputs.movies(spark, sf), "Genres", "|", "Genres_Array")
    return split.select(
        "MovieID",
        F.size("Genres_Array").cast("bigint").alias("n_genres"),
        F.element_at("Genres_Array", 1).alias("first_genre"),
        F.element_at("Genres_Array", -1).alias("last_genre"),
    )


def _genres(spark, sf):
    split = reshape.split_to_array(inputs.movies(spark, sf), "Genres", "|", "Genres_Array")
    return reshape.explode_items(split, "Genres_Array", "genre", keep=["MovieID"])


@query
def genre_explode(spark, sf):
    return _genres(spark, sf)


def _field_tokens(tweets: DataFrame, keep=()):
    return reshape.tokenize(tweets, "text", keep=keep, field_sep=",")


def _hashtags(tweets: DataFrame, keep=()):
    return filters.filter_prefix(_field_tokens(tweets, keep), "#")


@query
def tokenize_fields(spark, sf):
    return _field_tokens(inputs.tweets(spark, sf), keep=["event_id"])


@query
def collapse_ws_counts(spark, sf):
    flat = inputs.documents(spark, sf).select(collapse_ws(F.col("text")).alias("text"))
    return counts.count_by(reshape.tokenize(flat, "text", strip=False, out="word"), "word")


# --- filters -----------------------------------------------------------------


@query
def prefix_filter(spark, sf):
    return _hashtags(inputs.tweets(spark, sf), keep=["event_id"])


@query
def hashtag_min_count(spark, sf):
    popular = filters.having_more(hashtag_count(spark, sf), 66)
    return counts.sort_counts(popular, "token")


@query
def top_rated_filter(spark, sf):
    return ratings.well_rated(ratings.rating_stats(inputs.movie_ratings(spark, sf)), 26, 20)


@query
def genre_filter(spark, sf):
    split = reshape.split_to_array(inputs.movies(spark, sf), "Genres", "|", "Genres_Array")
    return filters.filter_contains(split, "Genres_Array", "blue").select("MovieID", "MovieTitle")


@query
def min_items_filter(spark, sf):
    several = filters.filter_min_items(inputs.port_arrays(spark, sf), "Ports_Array", 2)
    return several.select("scanner", F.size("Ports_Array").cast("bigint").alias("numports"))


@query
def flag_filter(spark, sf):
    return inputs.scanners(spark, sf).where(F.col("mirai")).select("scanner", "Packets")


def _assigned(spark, sf):
    """Scanners with the number of ports as a given cluster assignment."""
    return inputs.scanners(spark, sf).withColumn("cluster", F.col("numports"))


@query
def select_clusters(spark, sf):
    return filters.select_clusters(_assigned(spark, sf), [2, 5]).select("scanner", "cluster")


@query
def clusters_above_ratio(spark, sf):
    profile = clusters.cluster_profile(_assigned(spark, sf), inputs.SCANNER_FLAGS)
    return clusters.clusters_above(profile, "zmap", 0.2).select("cluster", "size", "zmap_ratio")


@query
def rows_of_clusters_above(spark, sf):
    """The scanners in the clusters whose flag share is high enough."""
    assigned = materialize(_assigned(spark, sf).select("scanner", "cluster", "zmap"), "assigned")
    chosen = clusters.clusters_above(clusters.cluster_profile(assigned, ["zmap"]), "zmap", 0.2)
    return clusters.rows_of(assigned, chosen).select("scanner", "cluster")


@query
def filter_impact(spark, sf):
    return filters.filter_impact(inputs.port_arrays(spark, sf), F.size("Ports_Array") > 2)


# --- joins -------------------------------------------------------------------


@query
def ratings_join_movies(spark, sf):
    titles = inputs.movies(spark, sf).select("MovieID", "MovieTitle")
    return joins.join_on(inputs.ratings(spark, sf), titles, "MovieID")


@query
def two_period_join(spark, sf):
    first, second = inputs.tweet_days(spark, sf)
    return joins.two_period_counts(_hashtags(first), _hashtags(second), "token")


@query
def two_period_trend(spark, sf):
    first, second = inputs.tweet_days(spark, sf)
    trend = joins.two_period_trend(_hashtags(first), _hashtags(second), "token", min_exclusive=33)
    return counts.sort_counts(trend, "token", by="n_total")


@query
def skew_ratings_join(spark, sf):
    """The join of ``ratings_join_movies`` with the movies of very many ratings set apart."""
    titles = inputs.movies(spark, sf).select("MovieID", "MovieTitle")
    return joins.skew_join(inputs.ratings(spark, sf), titles, "MovieID").select("UserID", "MovieID", "Rating", "MovieTitle")


@query
def rating_error_join(spark, sf):
    actual = materialize(inputs.interactions(spark, sf), "interactions")
    item_means = materialize(actual.groupBy("ItemID").agg(F.avg("Rating").alias("prediction")), "means")
    # Stored before the join, as the predictions of a job would be: both sides have their real sizes.
    predicted = materialize(actual.select("UserID", "ItemID").join(item_means, "ItemID"), "predictions")
    joined = joins.join_on(actual, predicted, ["UserID", "ItemID"])
    return evaluation.squared_errors(joined, "Rating", "prediction").select(
        "UserID", "ItemID", *[F.round(c, 6).alias(c) for c in ("Rating", "prediction", "sq_error")]
    )


# --- aggregates and ranking --------------------------------------------------


def _words(spark, sf):
    lines = reshape.lines_of(inputs.documents(spark, sf), "text")
    return reshape.tokenize(lines, "value", out="word")


@query
def word_count(spark, sf):
    return counts.count_by(_words(spark, sf), "word")


@query
def word_count_sorted(spark, sf):
    return counts.sort_counts(word_count(spark, sf), "word")


@query
def hashtag_count(spark, sf):
    tokens = reshape.tokenize(inputs.tweets(spark, sf), "text")
    return counts.count_by(filters.filter_prefix(tokens, "#"), "token")


@query
def hashtag_total(spark, sf):
    return counts.count_rows(_hashtags(inputs.tweets(spark, sf)))


@query
def top_k_hashtags(spark, sf):
    return counts.top_k(counts.count_by(_hashtags(inputs.tweets(spark, sf)), "token"), 100, "token")


@query
def genre_count(spark, sf):
    return counts.count_by(_genres(spark, sf), "genre")


@query
def genre_ranked(spark, sf):
    rated = ratings.rated_movies(inputs.movies(spark, sf), inputs.movie_ratings(spark, sf), "blue")
    return ratings.rank_movies(rated)


def _ports(spark, sf):
    return reshape.explode_items(inputs.port_arrays(spark, sf), "Ports_Array")


@query
def item_count(spark, sf):
    return counts.count_by(_ports(spark, sf), "item")


@query
def distinct_items(spark, sf):
    return counts.count_distinct(_ports(spark, sf), "item")


@query
def top_n_items(spark, sf):
    return features.top_items(inputs.port_arrays(spark, sf), "Ports_Array", 10)


@query
def rating_sum(spark, sf):
    return counts.sum_by(inputs.movie_ratings(spark, sf), "MovieID", "Rating", "total_rating")


@query
def rating_stats(spark, sf):
    return ratings.rating_stats(inputs.movie_ratings(spark, sf))


@query
def top_rated_in_genre(spark, sf):
    return ratings.top_rated_in_genre(
        inputs.movies(spark, sf), inputs.movie_ratings(spark, sf), "blue", 26, 20, n=10
    )


@query
def top_rated_fast(spark, sf):
    return ratings.top_rated_in_genre(
        inputs.movies(spark, sf), inputs.movie_ratings(spark, sf), "red", 25, 25, by="TotalReviews"
    )


# --- splits ------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]


@query
def hash_split_3way(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select(*LINE_KEY)
    return sampling.assign_split(lines, LINE_KEY, [3, 1, 1], 137)


@query
def hash_split_2way(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select(*LINE_KEY)
    return sampling.assign_split(lines, LINE_KEY, [7, 3], 1234)


# --- features ----------------------------------------------------------------


@query
def multi_hot_topn(spark, sf):
    ports = materialize(inputs.port_arrays(spark, sf), "ports")
    return features.multi_hot_topn(ports, "Ports_Array", 10, by_rank=True).drop("Ports_Array")


@query
def multi_hot_vector(spark, sf):
    """The same indicators through one sparse vector column."""
    ports = materialize(inputs.port_arrays(spark, sf), "ports")
    names = [row["item"] for row in features.top_items(ports, "Ports_Array", 10).collect()]
    values = vector_to_array(F.col("hot"))
    return features.multi_hot_vector(ports, "Ports_Array", names, "hot").select(
        "scanner", *[(F.get(values, F.lit(i)) > 0).alias(name) for i, name in enumerate(HOT)]
    )


@query
def thermometer_encode(spark, sf):
    return features.thermometer(
        inputs.port_sets(spark, sf).select("scanner", "Packets"), "Packets", prefix="TE"
    ).drop("Packets")


@query
def string_index(spark, sf):
    cells = inputs.biopsies(spark, sf).select("id", "line", "bare_nuclei")
    return features.string_index(cells, "bare_nuclei", "bare_index")


@query
def index_roundtrip(spark, sf):
    events = inputs.table(spark, sf, "events").select("event_id", "event_type")
    indexed = features.string_index(events, "event_type", "type_index")
    return features.index_to_string(indexed, "type_index", "type_again")


@query
def assemble_features(spark, sf):
    cells = inputs.biopsies(spark, sf).withColumn("bulky", F.col("clump") > 25)
    cols = ["clump", "cell_size", "mitoses", "bulky"]
    values = vector_to_array(F.col("features"))
    return features.assemble(cells, cols).select(
        "id", "line", *[F.get(values, F.lit(i)).alias(f"f_{i}") for i in range(len(cols))]
    )


@query
def scale_features(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice")
    return features.scale(lines, ["l_quantity", "l_extendedprice"], 255)


@query
def clean_missing(spark, sf):
    cells = inputs.biopsies(spark, sf).select("id", "line", "bare_nuclei")
    return features.clean_missing(cells, "bare_nuclei", to_type="double")


@query
def impute_missing(spark, sf):
    cells = inputs.biopsies(spark, sf).select("id", "line", "bare_nuclei")
    filled = features.impute(features.clean_missing(cells, "bare_nuclei"), ["bare_nuclei"])
    return filled.withColumn("bare_nuclei", F.round("bare_nuclei", 6))


# --- item sets ---------------------------------------------------------------


def _baskets(spark, sf):
    return itemsets.weigh_baskets(inputs.port_arrays(spark, sf), "Ports_Array")


@query
def frequent_items(spark, sf):
    weighted = _baskets(spark, sf)
    return itemsets.frequent_items(weighted, itemsets.share_threshold(weighted, 150, 1000))


@query
def frequent_pairs(spark, sf):
    weighted = _baskets(spark, sf)
    return itemsets.frequent_pairs(weighted, itemsets.share_threshold(weighted, 22, 1000))


@query
def frequent_triples(spark, sf):
    weighted = _baskets(spark, sf)
    return itemsets.frequent_triples(weighted, itemsets.share_threshold(weighted, 33, 10_000))


def _as_text(sets: DataFrame) -> DataFrame:
    return sets.select(F.array_join("items", ",").alias("items"), F.col("size").cast("bigint").alias("size"), "n")


@query
def frequent_port_sets(spark, sf):
    weighted = _baskets(spark, sf)
    return _as_text(itemsets.frequent_sets(weighted, itemsets.share_threshold(weighted, 33, 10_000)))


@query
def vertical_port_sets(spark, sf):
    """The sets of ``frequent_port_sets`` from bitmaps of baskets."""
    weighted = _baskets(spark, sf)
    return _as_text(bitmaps.frequent_sets(weighted, itemsets.share_threshold(weighted, 33, 10_000)))


@query
def frequent_sets_of_four(spark, sf):
    weighted = _baskets(spark, sf)
    found = itemsets.frequent_sets(weighted, itemsets.share_threshold(weighted, 6, 10_000), max_size=4)
    return _as_text(found.where("size = 4"))


@query
def fpgrowth_itemsets(spark, sf):
    baskets = materialize(inputs.port_arrays(spark, sf).select("Ports_Array"), "baskets")
    bound = baskets.count() * 33 // 10_000
    return _as_text(itemsets.itemsets(baskets, "Ports_Array", bound).where("size <= 3"))


# --- evaluation under given predictions and clusters -------------------------


@query
def rmse_metric(spark, sf):
    rated = inputs.movie_ratings(spark, sf)
    # Stored, so that AQE can split a movie with a large share of the ratings.
    stats = materialize(ratings.rating_stats(rated), "stats")
    predicted = joins.join_on(rated, stats, "MovieID")
    return evaluation.rmse(predicted, "Rating", "AvgRating").select(F.round("rmse", 6).alias("rmse"))


@query
def f1_weighted(spark, sf):
    guessed = inputs.biopsies(spark, sf).withColumn("guess", F.when(F.col("clump") > 25, 4).otherwise(2))
    return evaluation.f1_weighted(guessed, "class", "guess").select(F.round("f1", 6).alias("f1"))


SHRINKAGE = [1, 10, 100]


@query
def grid_select_best(spark, sf):
    """Choose among shrunken item means by validation error; test error for the chosen one."""
    lines = inputs.table(spark, sf, "lineitem").select(
        *LINE_KEY, F.col("l_partkey").alias("MovieID"), F.col("l_quantity").alias("Rating")
    )
    marked = sampling.assign_split(lines, LINE_KEY, [3, 1, 1], 137)
    train = marked.where(F.col("split") == 0)
    stats = materialize(
        train.groupBy("MovieID").agg(F.sum("Rating").alias("_s"), F.count(F.lit(1)).alias("_n")), "stats")
    level = stats.agg((F.sum("_s") / F.sum("_n"))).scalar()
    held_out = marked.where(F.col("split") > 0).join(stats, "MovieID")
    errors = held_out.groupBy("split").agg(*[
        F.sqrt(F.avg(F.pow(
            F.col("Rating") - (F.col("_s") + reg * level) / (F.col("_n") + reg), F.lit(2)
        ))).alias(str(reg))
        for reg in SHRINKAGE
    ])
    long = errors.unpivot(["split"], [str(r) for r in SHRINKAGE], "reg", "error").select(
        "split", F.col("reg").cast("int").alias("reg"), F.round("error", 6).alias("error")
    )
    metrics = long.groupBy("reg").agg(
        F.max(F.when(F.col("split") == 1, F.col("error"))).alias("val_rmse"),
        F.max(F.when(F.col("split") == 2, F.col("error"))).alias("test_rmse"),
    )
    best = evaluation.mark_best(metrics, "val_rmse", ["reg"])
    return best.withColumn("test_rmse", F.when(F.col("is_best"), F.col("test_rmse")))


@query
def cluster_profile(spark, sf):
    return clusters.cluster_profile(_assigned(spark, sf), inputs.SCANNER_FLAGS)


def _hot_assigned(spark, sf):
    ports = inputs.port_arrays(spark, sf).withColumn("cluster", F.size("Ports_Array").cast("bigint"))
    stored = materialize(ports, "assigned")
    return features.multi_hot_topn(stored, "Ports_Array", 10, by_rank=True)


HOT = [f"Port{i + 1}" for i in range(10)]


@query
def cluster_features(spark, sf):
    return clusters.cluster_features(_hot_assigned(spark, sf), HOT)


@query
def cluster_dominant_feature(spark, sf):
    assigned = _hot_assigned(spark, sf)
    return clusters.dominant_feature(
        clusters.cluster_features(assigned, HOT), clusters.cluster_sizes(assigned)
    )


@query
def cluster_sizes(spark, sf):
    return clusters.cluster_sizes(inputs.digits(spark, sf), "label")


@query
def cluster_means(spark, sf):
    means = clusters.cluster_means(inputs.digits(spark, sf), "embedding", "label")
    return means.select("label", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value"))


@query
def nearest_centroid(spark, sf):
    digits = inputs.digits(spark, sf)
    centers = clusters.cluster_means(digits, "embedding", "label").withColumnRenamed("label", "cluster")
    near = clusters.nearest_centroid(digits.select("vec_id", "embedding"), "embedding", centers)
    return near.select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


@query
def silhouette(spark, sf):
    vectors = inputs.digits(spark, sf).select("label", array_to_vector("embedding").alias("features"))
    return clusters.silhouette(vectors, cluster="label").select(F.round("silhouette", 6).alias("silhouette"))


# --- fitted models (no SQL counterpart) --------------------------------------

PAIR_KEY = ["UserID", "ItemID"]


def _als_frames(spark, sf, weights, seed):
    """Interactions, stored once, with int ids beside the original ones and split by their key."""
    pairs = materialize(inputs.interactions(spark, sf), "interactions")
    for key in PAIR_KEY:
        pairs = recommend.with_int_id(pairs, key, f"{key}_int")
    return sampling.split_frames(pairs, PAIR_KEY, weights, seed)


INT_KEY = {"user": "UserID_int", "item": "ItemID_int"}


@query
def als_predict(spark, sf):
    train, test = _als_frames(spark, sf, [4, 1], 137)
    predicted = recommend.predict_pairs(recommend.fit_als(train, rank=4, iters=5, **INT_KEY), test)
    return predicted.select(*PAIR_KEY, "Rating", "prediction")


@query
def als_predict_keys(spark, sf):
    """The pairs that get a prediction: those whose user and item are both rated in training."""
    return als_predict(spark, sf).where(F.col("prediction").between(-1000, 1000)).select(*PAIR_KEY, F.round("Rating", 6).alias("Rating"))


def _pair_frames(spark, sf, weights, seed):
    """Interactions, stored once, split by their key."""
    with swept(spark):
        pairs = materialize(inputs.interactions(spark, sf), "interactions")
    return sampling.split_frames(pairs, PAIR_KEY, weights, seed)


@query
def als_grid(spark, sf):
    """All 27 settings, from one run."""
    train, validation = _pair_frames(spark, sf, [4, 1], 137)
    return factors.tune(train, validation)


@query
def als_best(spark, sf):
    """All 27 settings, and the test error of the best."""
    return factors.tune(*_pair_frames(spark, sf, [3, 1, 1], 137))


@query
def als_equations(spark, sf):
    """Two iterations of rank two, with the predictions of the held-out pairs."""
    train, test = _pair_frames(spark, sf, [4, 1], 137)
    users, items = factors.fit(train, rank=2, reg=0.1, iters=2)
    found = factors.predict(test, users, items)
    return found.select(*PAIR_KEY, F.round("prediction", 3).alias("prediction"))


@query
def als_recommend(spark, sf):
    (everything,) = _als_frames(spark, sf, [1], 137)
    found = recommend.recommend(recommend.fit_als(everything, rank=4, iters=5, **INT_KEY), 3)
    for key in PAIR_KEY:
        found = recommend.with_original(found, everything, f"{key}_int", key)
    return found


@query
def als_recommend_users(spark, sf):
    """Per user: recommended items, distinct ones, and those that are items of the data."""
    items = materialize(inputs.interactions(spark, sf).select("ItemID").distinct(), "items").withColumn("known", F.lit(1))
    found = als_recommend(spark, sf).join(items, "ItemID", "left")
    return found.groupBy("UserID").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ItemID").alias("n_items"), F.count("known").alias("n_known"))


CELL_FIT = {"label": "class", "numeric": ["clump", "cell_size", "mitoses"], "categorical": ["bare_nuclei"]}


def _cells(spark, sf):
    return sampling.split_frames(inputs.biopsies(spark, sf), ["id", "line"], [7, 3], 1234)


@query
def tree_predict(spark, sf):
    train, test = _cells(spark, sf)
    model = trees.fit_tree(train, max_depth=4, **CELL_FIT)
    return model.transform(test).select("id", "line", "class", "prediction", "predicted_class")


@query
def tree_reloaded(spark, sf):
    """A tree with its feature stages saved, loaded and applied: the same class for every test row."""
    train, test = _cells(spark, sf)
    model, path = trees.fit_tree(train, max_depth=4, **CELL_FIT), new_path(spark, "model")
    save_model(model, path)
    scored = model.transform(test).select("id", "line", "class", *CELL_FIT["numeric"], "bare_nuclei", F.col("predicted_class").alias("before"))
    again = load_model(spark, path).transform(scored)
    return again.select("id", "line", "class", (F.col("before") == F.col("predicted_class")).alias("same"))


@query
def tree_depth_compare(spark, sf):
    train, test = _cells(spark, sf)
    return trees.score_depths(train, test, **CELL_FIT)


@query
def tree_first_split(spark, sf):
    """The root of a tree whose bins hold every value: the best of all possible splits."""
    train, _ = _cells(spark, sf)
    model = trees.fit_tree(train, "class", CELL_FIT["numeric"], max_depth=1, max_bins=256)
    root = trees.tree_nodes(spark, model).where("id = 0")
    return root.select("feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 6).alias("gain"),
                       F.round("impurity", 6).alias("impurity"))


@query
def tree_nodes(spark, sf):
    train, _ = _cells(spark, sf)
    return trees.tree_nodes(spark, trees.fit_tree(train, max_depth=4, **CELL_FIT))


@query
def tree_rules(spark, sf):
    return trees.tree_rules(tree_nodes(spark, sf))


@query
def tree_predict_classes(spark, sf):
    """Test rows with their true class, and whether the named class is the predicted number's."""
    found = tree_predict(spark, sf)
    named = found.groupBy("prediction").agg(F.count_distinct("predicted_class").alias("n"), F.min("predicted_class").alias("name"))
    return found.join(materialize(named, "named"), "prediction").select(
        "id", "line", "class", ((F.col("n") == 1) & (F.col("name") == F.col("predicted_class"))).alias("one_name"))


@query
def tree_rules_cover(spark, sf):
    """Rows, rows that exactly one rule holds for, and those where it predicts what the tree predicts."""
    train, test = _cells(spark, sf)
    model = trees.fit_tree(train, max_depth=4, **CELL_FIT)
    rules = trees.tree_rules(trees.tree_nodes(spark, model)).select("condition", "prediction").collect()  # 16 leaves at most
    rows = model.transform(train.unionByName(test))
    held = F.array(*[F.when(F.expr(rule["condition"]), F.lit(rule["prediction"])) for rule in rules])
    said = rows.select("prediction", F.array_compact(held).alias("said"))
    one = F.size("said") == 1
    return said.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(one).alias("n_one_rule"),
                    F.count_if(one & (F.get("said", F.lit(0)) == F.col("prediction"))).alias("n_same"))


@query
def kmeans_assign(spark, sf):
    points = inputs.digits(spark, sf).select("vec_id", array_to_vector("embedding").alias("features"))
    return clusters.fit_vectors(points, 10).transform(points).select("vec_id", "cluster")


@query
def kmeans_nearest(spark, sf):
    """Points, points that another fitted centre is nearer to, and rows in the table of sizes."""
    points = inputs.digits(spark, sf).select("vec_id", "embedding", array_to_vector("embedding").alias("features"))
    model = clusters.fit_vectors(points, 10)
    assigned = model.transform(points).select("vec_id", "embedding", F.col("cluster").alias("given"))
    near = clusters.nearest_centroid(assigned, "embedding", clusters.cluster_centers(points, model))
    sizes = clusters.cluster_sizes(model.transform(points)).agg(F.sum("size").alias("n_sized"))
    wrong = near.agg(F.count(F.lit(1)).alias("n_points"), F.count_if(F.col("given") != F.col("cluster")).alias("n_other_nearer"))
    return wrong.crossJoin(sizes)  # one row each


@query
def kmeans_centers_shape(spark, sf):
    """The fitted centres: clusters, dimensions, and the sum over all points of their distance to their centre's mean."""
    points = inputs.digits(spark, sf).select("embedding", array_to_vector("embedding").alias("features"))
    model = clusters.fit_vectors(points, 10)
    centers = clusters.cluster_centers(points, model)
    sizes = clusters.cluster_sizes(model.transform(points))
    weighted = centers.join(sizes, "cluster").groupBy("dim").agg(F.sum(F.col("value") * F.col("size")).alias("total"))
    return centers.groupBy("dim").agg(F.count_distinct("cluster").alias("n_clusters")).join(weighted, "dim").select(
        F.col("dim").cast("bigint").alias("dim"), "n_clusters", F.round("total", 2).alias("total"))


def _encoded(spark, sf):
    """Stored scanner profiles with top-port and port-count indicators."""
    profiles = materialize(inputs.scanners(spark, sf), "scanners")
    hot = features.multi_hot_topn(profiles, "Ports_Array", 10, by_rank=True)
    return features.thermometer(hot, "numports", prefix="TE")


THERMO = [f"TE_{i}" for i in range(17)]


@query
def kmeans_mixed_features(spark, sf):
    encoded = _encoded(spark, sf)
    cols = ["numports", "lifetime", "Packets", *HOT]
    model = clusters.fit_kmeans(encoded, cols, 20)
    return clusters.assign_clusters(model, encoded, cols).select("scanner", "cluster")


@query
def kmeans_thermo_profile(spark, sf):
    encoded, cols = _encoded(spark, sf), [*HOT, *THERMO]
    model = clusters.fit_kmeans(encoded, cols, 20, collapse=True)
    assigned = clusters.assign_clusters(model, encoded, cols)
    return clusters.cluster_profile(assigned, inputs.SCANNER_FLAGS, model=model)


@query
def kmeans_mixed_sizes(spark, sf):
    """Rows and distinct scanners with a cluster, and clusters out of range."""
    return kmeans_mixed_features(spark, sf).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("scanner").alias("n_scanners"),
        F.count_if(~F.col("cluster").between(0, 19)).alias("n_out_of_range"))


@query
def kmeans_thermo_totals(spark, sf):
    """Sizes and flagged rows summed over the profile of the fitted clusters."""
    profile = kmeans_thermo_profile(spark, sf)
    flagged = [F.round(F.sum(F.col("size") * F.col(f"{flag}_ratio"))).cast("bigint").alias(flag) for flag in inputs.SCANNER_FLAGS]
    return profile.agg(F.sum("size").alias("n_rows"), *flagged)


@query
def malware_cluster_ports(spark, sf):
    """Fit, profile, choose clusters by their share of a flag, and count the ports of the rows in them."""
    encoded, cols = _encoded(spark, sf), [*HOT, *THERMO]
    model = clusters.fit_kmeans(encoded, cols, 20, collapse=True)
    return clusters.investigate(clusters.assign_clusters(model, encoded, cols), inputs.SCANNER_FLAGS, "zmap", 0.2, "Ports_Array")


@query
def kmeans_k_compare(spark, sf):
    return clusters.compare_k(_encoded(spark, sf), [*HOT, *THERMO], [10, 20, 40], collapse=True)


@query
def kmeans_lloyd(spark, sf):
    """Five rounds from the first ten rows."""
    vectors = inputs.digits(spark, sf)
    found = lloyd.lloyd(vectors, "embedding", lloyd.first_rows(vectors, "vec_id", "embedding", 10), rounds=5)
    return found.assigned.select("vec_id", F.col("cluster").cast("bigint").alias("cluster"), F.round("distance", 5).alias("distance"))


def _digit_frames(spark, sf):
    vectors = neural.vector_input(inputs.digits(spark, sf), "embedding", "label", keep=["vec_id"])
    return sampling.split_frames(vectors, ["vec_id"], [4, 1], 1)


@query
def mlp_predict(spark, sf):
    train, test = _digit_frames(spark, sf)
    model = neural.fit_mlp(train, 64, 10, hidden=[128, 128, 128], iters=20)
    return model.transform(test).select("vec_id", "label", "prediction")


@query
def mlp_predict_keys(spark, sf):
    """Test rows with their label; the prediction has to be one of the classes."""
    found = mlp_predict(spark, sf)
    return found.select("vec_id", F.col("label").cast("bigint").alias("label"), F.col("prediction").between(0, 9).alias("in_range"))


@query
def mlp_fit_curve(spark, sf):
    train, test = _digit_frames(spark, sf)
    return neural.fit_curve(train, test, 64, 10, [[64, 64, 64], [64, 64]], [5, 10, 20])


NETWORKS = [((512, 512, 512), 128), ((512, 512, 512), 1000), ((512, 512), 1000)]


@query
def mlp_epochs(spark, sf):
    """Networks of three and two layers of 512 units, two batch sizes, to the epoch that the stop rule names or the 30th.

    Their fits do not need each other, so their jobs are submitted side by side. A step needs the one before, so a fit keeps
    one task busy: those that still run share the cores as threads.
    """
    cores, running = spark.sparkContext.defaultParallelism, list(NETWORKS)
    train, test = sampling.split_frames(inputs.digits(spark, sf), ["vec_id"], [4, 1], 1)

    def curve(setting):
        hidden, batch = setting
        fitted = networks.fit_network(train, test, ["vec_id"], "embedding", "label", 64, 10, hidden, batch, stop=True,
                                      threads=lambda: max(1, cores // max(1, len(running))))
        running.remove(setting)
        return fitted.epochs.withColumns({"layers": F.lit("-".join(map(str, hidden))), "batch": F.lit(batch)})

    with ThreadPool(len(NETWORKS)) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(curve), NETWORKS))


@query
def mlp_reloaded(spark, sf):
    """A network saved, loaded and applied to the test rows: a class and the same as before for each."""
    train, test = sampling.split_frames(inputs.digits(spark, sf), ["vec_id"], [4, 1], 1)
    fitted = networks.fit_network(train, test, ["vec_id"], "embedding", "label", 64, 10, (512, 512), 1000, epochs=2)
    path = new_path(spark, "network")
    networks.save_network(fitted.network, spark, path)
    before = networks.predict(fitted.network, test, "embedding")
    after = networks.predict(networks.load_network(spark, path), before, "embedding", "again", "probability_again")
    return after.select("vec_id", F.col("label").cast("bigint").alias("label"), F.col("again").between(0, 9).alias("in_range"),
                        ((F.col("again") == F.col("prediction")) & (F.col("probability") == F.col("probability_again"))).alias("same"))


# --- summaries ---------------------------------------------------------------


@query
def heavy_hashtags(spark, sf):
    """The rows of ``top_k_hashtags`` from summaries and one exact count of their candidates."""
    return heavy.top_keys(_hashtags(inputs.tweets(spark, sf)), "token", 100)


@query
def distinct_users_since(spark, sf):
    """Distinct users from each day on: the exact number, and whether the united sketches are within their bound."""
    events = inputs.table(spark, sf, "events")
    stored = materialize(sketches.daily(events, "ts", "user_id"), "sketches")
    both = sketches.exact_since(events, "ts", "user_id").join(sketches.since(stored), "day")
    return both.select(F.col("day").cast("string").alias("day"), "n", sketches.within_bound(F.col("estimate"), F.col("n")).alias("within_bound"))


# --- streaming ---------------------------------------------------------------


@query
def stream_prefix_counts(spark, sf):
    events = inputs.table(spark, sf, "events")
    # A pattern of this one name: the stream takes the table as one file or as a folder of files.
    stream = spark.readStream.schema(events.schema).parquet(f"{sf}/events.parque[t]")
    out, checkpoint = new_path(spark, "stream"), new_path(spark, "stream-state")
    running = start_prefix_counts(inputs.tweet_texts(stream), "#", out, checkpoint, field_sep=",")
    running.awaitTermination()
    return latest_counts(spark.read.parquet(out))


@query
def event_time_trend(spark, sf):
    """The rows of ``two_period_trend`` from windows of event time."""
    events = inputs.table(spark, sf, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf}/events.parque[t]")
    out, checkpoint = new_path(spark, "windows"), new_path(spark, "windows-state")
    running = start_window_counts(inputs.tweet_texts(stream), "#", out, checkpoint, field_sep=",")
    running.awaitTermination()
    return trend(window_counts(spark.read.parquet(out)), inputs.DAY_TWO, 33)
