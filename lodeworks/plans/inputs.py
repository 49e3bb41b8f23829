"""Input tables of the registered queries, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.functions.text import split_literal
from lodeworks.sources.readers import read_table

DAY_TWO = "2024-01-16 00:00:00"
SCANNER_FLAGS = ["mirai", "zmap", "masscan"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("MovieID"),
        F.col("p_name").alias("MovieTitle"),
        F.replace("p_name", F.lit(" "), F.lit("|")).alias("Genres"),
    )


def movie_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings without the user: no join is needed for per-movie statistics."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("MovieID"), F.col("l_quantity").alias("Rating")
    )


def _order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("UserID")
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(_order_users(spark, sf_dir), "l_orderkey").select(
        "UserID", F.col("l_partkey").alias("MovieID"), F.col("l_quantity").alias("Rating")
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mean rating per user and item, dense enough for factorisation."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    return (
        lines.join(_order_users(spark, sf_dir), "l_orderkey")
        .groupBy("UserID", F.col("l_suppkey").alias("ItemID"))
        .agg((F.sum("l_quantity") / F.count(F.lit(1))).alias("Rating"))
    )


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweet_texts(table(spark, sf_dir, "events"))


def tweet_texts(events: DataFrame) -> DataFrame:
    """Short texts with two hashtags each, from a static or streaming event table."""
    user = F.col("user_id").cast("string")
    tag = F.concat("event_type", (F.col("user_id") % 40).cast("string"))
    return events.select(
        "event_id",
        "ts",
        F.concat("event_type", F.lit(",#"), tag, F.lit(" from u"), user, F.lit(" #u"), user).alias("text"),
    )


def tweet_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    all_tweets = tweets(spark, sf_dir)
    cut = F.lit(DAY_TWO).cast("timestamp_ntz")
    return all_tweets.where(F.col("ts") < cut), all_tweets.where(F.col("ts") >= cut)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def port_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanner, its delimited set of ports and what the lines alone tell about it.

    Lines meet their part first and are aggregated with a map-side partial set,
    so a scanner with a third of all lines is no heavier than the others.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    ports = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return (
        lines.join(ports, "l_partkey")
        .groupBy(F.col("l_orderkey").alias("scanner"))
        .agg(F.array_sort(F.collect_set("p_brand")).alias("_ports"), F.sum("l_quantity").alias("Packets"))
        .select(
            "scanner",
            F.array_join("_ports", "-").alias("ports_scanned_str"),
            F.size("_ports").cast("bigint").alias("numports"),
            "Packets",
        )
    )


def port_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return port_sets(spark, sf_dir).select(
        "scanner", split_literal(F.col("ports_scanned_str"), "-").alias("Ports_Array")
    )


def scanners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full scanner profile: one row per order on both sides of the join."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("scanner"),
        F.col("o_totalprice").alias("lifetime"),
        (F.col("o_orderstatus") == "P").alias("mirai"),
        (F.col("o_orderpriority") == "1-URGENT").alias("zmap"),
        (F.col("o_orderpriority") == "5-LOW").alias("masscan"),
    )
    return (
        port_sets(spark, sf_dir)
        .join(orders, "scanner")
        .withColumn("Ports_Array", split_literal(F.col("ports_scanned_str"), "-"))
    )


def biopsies(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        number.alias("line"),
        F.col("l_quantity").alias("clump"),
        F.col("l_discount").alias("cell_size"),
        F.col("l_tax").alias("mitoses"),
        F.when(number == 7, "?").otherwise(number.cast("string")).alias("bare_nuclei"),
        F.when(F.col("l_quantity") + 200 * F.col("l_discount") > 40, 4).otherwise(2).alias("class"),
    )


def digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")
