"""URL filters: host-suffix and path-prefix expressions joined with a rule list.

Everything is DataFrame functions. Each URL is expanded into the expressions a rule
could have: its host cut to the last k labels, for the label counts k that occur among
the rules, joined with its path cut to the path lengths that occur among them. So any
rule is found, and an expansion is bounded by the shapes of the rules, not by the URL.
Expressions meet rules on the first 32 bits of their SHA-256; the whole digest confirms.

Defined results: null URLs and URLs without ``://`` have an empty host and path and get
the default verdict; of several rules the longest wins, of equally long ones a block,
then the smaller text; every row has its own result row, repeated ones as well; no rows
give no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.words import ascii_lower, bound
from lodeworks.sources.scratch import materialize

SHORT = 8  # hexadecimal digits of the join key


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules ``verdict, host, path`` with their text, digest and shape. Hosts are lower-cased."""
    host = ascii_lower(F.col("host"))
    # A rule's host and path are joined by a character that no host has, so no two rules look alike.
    return rules.select(
        "verdict", host.alias("rule_host"), F.col("path").alias("rule_path"),
        F.concat(host, "path").alias("rule"), F.sha2(F.concat(host, F.lit("?"), "path"), 256).alias("digest"),
        F.size(F.split(host, r"\.")).alias("labels"), F.char_length("path").alias("depth"),
    ).where(F.col("rule_host").isNotNull() & F.col("rule_path").isNotNull()).distinct().withColumn(
        "short", F.substring("digest", 1, SHORT))


def expressions(shapes: list[tuple[int, int]]) -> Column:
    """Digests of the expressions of ``host`` and ``path`` that have the shape of some rule.

    The shapes are one constant of the plan, and only those that the URL is long enough
    for are expanded.
    """
    listed = F.from_json(F.lit(json.dumps([{"k": k, "d": d} for k, d in shapes])), "array<struct<k:int,d:int>>")

    def digest(labels: Column, shape: Column) -> Column:
        host = F.array_join(F.slice(labels, -shape["k"], shape["k"]), ".")
        return F.sha2(F.concat(host, F.lit("?"), F.substr(F.col("path"), F.lit(1), shape["d"])), 256)

    def made(labels: Column) -> Column:
        fits = F.filter(listed, lambda s: (F.size(labels) >= s["k"]) & (F.char_length("path") >= s["d"]))
        return F.array_distinct(F.transform(fits, lambda s: digest(labels, s)))

    return bound(F.split("host", r"\."), made)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
          max_broadcast: int = 32 << 20, salts: int = 16) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row of ``pages``.

    Rules of up to ``max_broadcast`` bytes are broadcast. More are shuffled: then common
    expressions are dealt over ``salts`` tasks each, and the rules copied to them.
    """
    known = materialize(rule_table(rules), "rules")
    shapes = [(r["labels"], r["depth"]) for r in known.select("labels", "depth").distinct()
              .orderBy("labels", "depth").collect()]  # at most the label counts times the path lengths of rules
    parts = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        "id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    each = parts.select("id", "url", "host", "path", F.posexplode_outer(expressions(shapes)).alias("at", "expression"))
    each = each.withColumn("expression_short", F.substring("expression", 1, SHORT))
    # One row for each digest: of a rule with both verdicts the block counts.
    side = known.groupBy("short", "digest", "rule").agg(F.max("verdict").alias("rule_verdict"))
    same = (F.col("expression_short") == F.col("short")) & (F.col("expression") == F.col("digest"))
    letters = F.octet_length("rule") + F.octet_length("digest") + 64
    if (known.agg(F.sum(letters)).first()[0] or 0) <= max_broadcast:
        joined = each.join(F.broadcast(side), same, "left")
    else:
        side = side.withColumn("rule_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        each = each.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(salts)).cast("int"))
        joined = each.join(side, same & (F.col("salt") == F.col("rule_salt")), "left")
    # The greatest of these is the winner: length, block before allow, smaller text by its complement.
    rank = F.when(F.col("rule").isNotNull(), F.struct(
        F.char_length("rule").alias("length"), (F.col("rule_verdict") == "block").alias("blocks")))
    first = F.coalesce(F.col("at"), F.lit(0)) == 0  # a page has one row with its first expression, or with none
    best = joined.groupBy("id", "url", "host", "path").agg(
        F.max(rank).alias("best"), F.collect_set(F.struct("rule", "rule_verdict")).alias("fits"),
        F.sum(first.cast("int")).cast("int").alias("copies"))
    wins = F.filter("fits", lambda r: (F.char_length(r["rule"]) == F.col("best")["length"])
                    & ((r["rule_verdict"] == "block") == F.col("best")["blocks"]))
    won = F.array_min(wins)
    return best.select(F.col("id").alias(id_col), "host", "path", won["rule"].alias("rule"),
                       F.coalesce(won["rule_verdict"], F.lit(default)).alias("verdict"),
                       F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).drop("copy")
