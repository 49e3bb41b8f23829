"""Corpus pipeline: stages over the table of documents, each stored as Parquet for the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm import bpe, decontamination, nbsvm, simhash, suffixes
from lodeworks.sources.scratch import materialize


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay if the classifier, learned on the labelled ones among them, accepts them."""
    model = nbsvm.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return nbsvm.keep_accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=3, max_bits=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut; ``n_chars`` follows the text. Every document stays, if empty."""
    return suffixes.remove_repeats(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document left, and the text that they stand for."""
    return bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

# The classifier's verdicts are not expressible in SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
