"""Rating statistics and top-rated items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.text import split_literal


def rating_stats(ratings: DataFrame, key: str = "MovieID", value: str = "Rating") -> DataFrame:
    """Mean rating and number of reviews per item, in one aggregate."""
    return ratings.groupBy(key).agg(
        F.avg(value).alias("AvgRating"), F.count(F.lit(1)).alias("TotalReviews")
    )


def rated_movies(movies: DataFrame, ratings: DataFrame, genre: str | None = None) -> DataFrame:
    """Movies (of one genre) with their rating statistics.

    Ratings are aggregated before the join, so what meets the movie table is one
    row per movie however often the most popular one was rated. The substring
    test changes nothing in the result; unlike the split it can be pushed into the
    scan, and Spark counts it as selective, so that on large ratings it filters
    them by the genre's movies (a runtime Bloom filter) before the shuffle.
    """
    if genre is not None:
        in_genre = F.array_contains(split_literal(F.col("Genres"), "|"), genre)
        movies = movies.where(F.col("Genres").contains(genre)).where(in_genre)
    return rating_stats(ratings).join(movies.select("MovieID", "MovieTitle"), "MovieID")


def well_rated(stats: DataFrame, min_rating: float, min_reviews: int) -> DataFrame:
    """Strictly better rated and strictly more often reviewed than the bounds."""
    return stats.where(F.col("AvgRating") > min_rating).where(F.col("TotalReviews") > min_reviews)


def rank_movies(stats: DataFrame, by: str = "TotalReviews") -> DataFrame:
    return stats.orderBy(F.desc(by), "MovieID")


def top_rated_in_genre(
    movies: DataFrame,
    ratings: DataFrame,
    genre: str,
    min_rating: float,
    min_reviews: int,
    n: int | None = None,
    by: str = "AvgRating",
) -> DataFrame:
    """Best movies of a genre among those with enough reviews; all when ``n`` is None."""
    ranked = rank_movies(well_rated(rated_movies(movies, ratings, genre), min_rating, min_reviews), by)
    return ranked if n is None else ranked.limit(n)
