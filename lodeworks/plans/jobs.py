"""Whole jobs, from input files to a result table, with parameters for every setting.

Each job returns a DataFrame; ``python -m lodeworks <job> ... --out <path>`` writes it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators import (
    clusters, counts, features, filters, itemsets, joins, neural, ratings, recommend, reshape,
    sampling, trees,
)
from lodeworks.sources import cached, materialize, read_csv_columns, read_lines, read_table

MOVIES = "MovieID int, MovieTitle string, Genres string"
RATINGS = "UserID bigint, MovieID bigint, Rating double"
SCANNERS = (
    "ports_scanned_str string, numports long, lifetime double, Packets double, "
    "mirai boolean, zmap boolean, masscan boolean"
)
CELLS = ["clump_thickness", "unif_cell_size", "unif_cell_shape", "marg_adhesion",
         "single_epith_cell_size", "bland_chrom", "norm_nucleoli", "mitoses"]
BIOPSIES = "id long, " + ", ".join(f"{c} int" for c in CELLS) + ", bare_nuclei string, class int"
FLAGS = ["mirai", "zmap", "masscan"]


def word_counts(spark: SparkSession, texts: str, drop_empty: bool = False) -> DataFrame:
    """``word, n`` of text files, most frequent first."""
    words = reshape.tokenize(read_lines(spark, texts), out="word", drop_empty=drop_empty)
    return counts.sort_counts(counts.count_by(words, "word"), "word")


def hashtag_counts(spark: SparkSession, texts: str, min_exclusive: int = 10) -> DataFrame:
    """``token, n`` of hashtags used more than ``min_exclusive`` times, most frequent first."""
    tags = filters.filter_prefix(reshape.tokenize(read_lines(spark, texts)), "#")
    return counts.sort_counts(filters.having_more(counts.count_by(tags, "token"), min_exclusive), "token")


def hashtag_trend(
    spark: SparkSession, first: str, second: str, min_exclusive: int = 100, top: int | None = None
) -> DataFrame:
    """Hashtags popular in the first texts, with counts in both and in total."""
    tags = [
        filters.filter_prefix(reshape.tokenize(read_lines(spark, path), field_sep=","), "#")
        for path in (first, second)
    ]
    trend = joins.two_period_trend(*tags, "token", min_exclusive)
    ranked = counts.sort_counts(trend, "token", by="n_total")
    return ranked if top is None else ranked.limit(top)


def genre_totals(spark: SparkSession, movies: str) -> DataFrame:
    """``genre, n`` movies, most frequent first."""
    split = reshape.split_to_array(read_csv_columns(spark, movies, MOVIES), "Genres", "|", "genres")
    genres = reshape.explode_items(split, "genres", "genre")
    return counts.sort_counts(counts.count_by(genres, "genre"), "genre")


def top_movies(
    spark: SparkSession, movies: str, rated: str, genre: str = "Adventure",
    min_rating: float = 3.5, min_reviews: int = 100, n: int | None = None, by: str = "TotalReviews",
) -> DataFrame:
    """Well-rated movies of a genre with more than ``min_reviews`` reviews."""
    return ratings.top_rated_in_genre(
        read_csv_columns(spark, movies, MOVIES), read_csv_columns(spark, rated, RATINGS),
        genre, min_rating, min_reviews, n, by,
    )


def tune_recommender(
    spark: SparkSession, rated: str, ranks: Sequence[int] = (4, 8, 12),
    regs: Sequence[float] = (0.01, 0.05, 0.1), iterations: Sequence[int] = (10, 15, 20), seed: int = 37,
) -> DataFrame:
    """Validation error per setting and the test error of the best one."""
    train, validation, test = sampling.split_frames(_numbered(spark, rated), ["UserID", "MovieID"], [3, 1, 1], 137)
    return recommend.tune_and_test(train, validation, test, ranks, regs, iterations, seed, **NUMBERS)


NUMBERS = {"user": "UserID_int", "item": "MovieID_int"}


def _numbered(spark: SparkSession, rated: str) -> DataFrame:
    """Ratings with int ids beside the original ones, which may be any 64-bit number."""
    stored = materialize(read_csv_columns(spark, rated, RATINGS), "ratings")
    for key in ("UserID", "MovieID"):
        stored = recommend.with_int_id(stored, key, f"{key}_int")
    return stored


def recommend_movies(
    spark: SparkSession, rated: str, n: int = 10, rank: int = 4, reg: float = 0.1, iters: int = 20, seed: int = 37,
    users: str | None = None,
) -> DataFrame:
    """The ``n`` movies with the highest predicted rating for the users listed in a CSV, or for every user.

    Each of these users is compared with all movies, so a large site names its users.
    """
    numbered = _numbered(spark, rated)
    with cached(numbered) as (known,):
        model = recommend.fit_als(known, rank, reg, iters, seed, **NUMBERS)
    asked = None
    if users is not None:
        listed = read_csv_columns(spark, users, "UserID bigint")
        asked = numbered.join(listed, "UserID", "left_semi").select("UserID_int").distinct()
    found = recommend.recommend(model, n, asked)
    for key in ("UserID", "MovieID"):
        found = recommend.with_original(found, numbered, f"{key}_int", key)
    return found


def _port_arrays(spark: SparkSession, scanners: str, schema: str) -> DataFrame:
    profiles = read_csv_columns(spark, scanners, schema)
    return reshape.split_to_array(profiles, "ports_scanned_str", "-", "Ports_Array")


def frequent_port_sets(
    spark: SparkSession, scanners: str, min_exclusive: int = 5000, max_size: int = 3
) -> DataFrame:
    """``items, size, n``: sets of two and more ports scanned together, most frequent first."""
    ports = _port_arrays(spark, scanners, "ports_scanned_str string")
    weighted = itemsets.weigh_baskets(ports, "Ports_Array")
    found = itemsets.frequent_sets(weighted, min_exclusive, max_size)
    return found.select(F.array_join("items", "-").alias("items"), "size", "n").orderBy(F.desc("n"), "items")


def _encoded(spark: SparkSession, scanners: str, top_ports: int) -> tuple[DataFrame, list[str]]:
    profiles = materialize(_port_arrays(spark, scanners, SCANNERS), "scanners")
    hot = features.multi_hot_topn(profiles, "Ports_Array", top_ports)
    return hot, [c for c in hot.columns if c not in profiles.columns]


def cluster_profiles(
    spark: SparkSession, scanners: str, k: int = 50, top_ports: int = 30, seed: int = 123,
) -> DataFrame:
    """Clusters over port indicators and the thermometer code of the port count.

    Size and malware shares per cluster, with its most common port.
    """
    hot, ports = _encoded(spark, scanners, top_ports)
    encoded = features.thermometer(hot, "numports")
    cols = ports + [c for c in encoded.columns if c not in hot.columns]
    model = clusters.fit_kmeans(encoded, cols, k, seed, collapse=True)
    assigned = clusters.assign_clusters(model, encoded, cols)
    profile = clusters.cluster_profile(assigned, FLAGS)
    common = clusters.dominant_feature(
        clusters.cluster_features(assigned, ports), profile.select("cluster", "size")
    )
    return profile.join(common.withColumnRenamed("n", "feature_n"), "cluster", "left").orderBy("cluster")


def malware_ports(
    spark: SparkSession, scanners: str, k: int = 50, top_ports: int = 30, min_ratio: float = 0.8,
    flag: str = "mirai", seed: int = 123,
) -> DataFrame:
    """Ports of the scanners in clusters whose share of a malware flag reaches ``min_ratio``, most common first."""
    hot, ports = _encoded(spark, scanners, top_ports)
    encoded = features.thermometer(hot, "numports")
    cols = ports + [c for c in encoded.columns if c not in hot.columns]
    model = clusters.fit_kmeans(encoded, cols, k, seed, collapse=True)
    assigned = clusters.assign_clusters(model, encoded, cols)
    found = clusters.investigate(assigned, FLAGS, flag, min_ratio, "Ports_Array")
    return found.orderBy("cluster", F.desc("n"), "item")


def compare_cluster_counts(
    spark: SparkSession, scanners: str, ks: Sequence[int] = (50, 120), top_ports: int = 30, seed: int = 123,
) -> DataFrame:
    """Silhouette per k over port indicators, port count, lifetime and packets."""
    hot, ports = _encoded(spark, scanners, top_ports)
    return clusters.compare_k(hot, ["numports", "lifetime", "Packets", *ports], ks, seed)


def diagnosis_depths(
    spark: SparkSession, biopsies: str, depths: Sequence[int] = (2, 3, 4, 5, 6, 7)
) -> DataFrame:
    """Tree size and F1 per depth limit."""
    train, test = _biopsy_frames(spark, biopsies)
    return trees.compare_depths(train, test, "class", CELLS, ["bare_nuclei"], depths)


def diagnosis_rules(spark: SparkSession, biopsies: str, max_depth: int = 3) -> DataFrame:
    """The fitted tree as one rule per leaf."""
    train, _ = _biopsy_frames(spark, biopsies)
    model = trees.fit_tree(train, "class", CELLS, ["bare_nuclei"], max_depth)
    rules = trees.tree_rules(trees.tree_nodes(spark, model))
    return rules.withColumn("stats", F.to_json("stats")).orderBy("leaf")


def _biopsy_frames(spark: SparkSession, biopsies: str) -> list[DataFrame]:
    cells = read_csv_columns(spark, biopsies, BIOPSIES)
    # Sample ids repeat, so the whole row is the key of the split.
    return sampling.split_frames(cells, cells.columns, [7, 3], 1234)


def digit_curve(
    spark: SparkSession, train: str, test: str, hidden: Sequence[int] = (512, 512, 512),
    budgets: Sequence[int] = (5, 10, 20, 30), blocks: Sequence[int] = (128,), layers: Sequence[int] = (),
    classes: int = 10, pixels: str = "pixels", label: str = "label",
) -> DataFrame:
    """Losses of a digit classifier over growing training, from tables of pixel arrays.

    ``layers`` compares networks of the first so many hidden layers (all, if empty);
    ``blocks`` compares block sizes, with a row per size, network and budget.
    """
    frames = [
        neural.vector_input(features.scale_array(read_table(spark, path), pixels, 255), pixels, label)
        for path in (train, test)
    ]
    inputs = read_table(spark, train).select(F.size(pixels)).first()[0]
    networks = [list(hidden[:n]) for n in layers] or [list(hidden)]
    curves = [neural.fit_curve(*frames, inputs, classes, networks, budgets, block=block).withColumn(
        "block", F.lit(block)) for block in blocks]
    return reduce(DataFrame.unionByName, curves)


JOBS = {
    fn.__name__.replace("_", "-"): fn
    for fn in (
        word_counts, hashtag_counts, hashtag_trend, genre_totals, top_movies, tune_recommender,
        recommend_movies, frequent_port_sets, cluster_profiles, malware_ports, compare_cluster_counts, diagnosis_depths,
        diagnosis_rules, digit_curve,
    )
}
