"""The registered queries of this folder, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm import (
    bpe, collocations, decontamination, harmonic, licenses, lineblocks, nbsvm, negatives, rules, simhash, simple8b, suffixes, urls,
)
from lodeworks.sources.scratch import new_path

VOCABULARY = "byte_bpe_50k.json"
# Fixed values of the contract: verdict, host, path.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias(
        "items_sha256"), decontamination.contaminated().alias("contaminated"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = rules.store(table(spark, sf_dir, "documents"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~rules.passes("base")).alias("base_failed"),
                       (rules.passes("base") & rules.passes("v2")).alias("kept"))


def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of policy v2 does, from the stored ledger alone."""
    return rules.ablations(rules.store(table(spark, sf_dir, "documents")), "v2")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    simple8b.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY))
    return simple8b.read(spark, path, with_ids=False)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(k) for k, v in zip(("verdict", "host", "path"), rule, strict=True)])
        for rule in URL_RULES])))
    return urls.judge(table(spark, sf_dir, "pages"), listed)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = nbsvm.score(docs, nbsvm.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", nbsvm.held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineblocks.extract(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), 1024, with_ids=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality_rules": op2_quality_rules,
    "quality_rule_ablations": quality_rule_ablations,
    "op3_token_files": op3_token_files,
    "op4_bpe": op4_bpe,
    "op5_url_filters": op5_url_filters,
    "op6_simhash": op6_simhash,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_license_scans": op8_license_scans,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_html_extraction": op10_html_extraction,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_packing": op13_packing,
}
