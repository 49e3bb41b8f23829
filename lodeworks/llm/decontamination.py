"""Benchmark decontamination: test n-grams in a broadcast hash set, probed by every document window.

Everything is DataFrame functions. The distinct windows of the benchmark are the build
side of a broadcast hash join on their 64-bit hash; each document window probes it
inside one generated loop, and a probe counts only if the words are equal. A benchmark
whose windows have more bytes than ``max_broadcast`` is joined by shuffling hashes
instead, with the same result.

Defined results: null text has no words and is never a hit; items without words and
items without an id have no windows; an item shorter than ``n`` words is one window;
every row has its own result row, repeated ones as well; an empty table gives an empty
result, an empty benchmark no hits. Columns beside id and text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.words import word_list
from lodeworks.sources.scratch import materialize

# A letter or digit of the word rule in text that is not lower-cased yet (fixed values).
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = 13) -> DataFrame:
    """Distinct windows of the items: ``gram`` (words), ``size``, ``key`` (hash), ``items`` (ids as strings)."""
    words = items.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("item"), word_list(F.col(text_col)).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - n + 1))
    grams = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, n))).alias("gram"))
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).select(
        "gram", F.size("gram").alias("size"), F.xxhash64("gram").alias("key"), "items")


def _window_hashes(words: Column, size: int) -> Column:
    """Hashes of all windows of ``size`` words, then one null that keeps the document itself."""
    last = F.size(words) - size
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, size)))
    alone = F.array(F.lit(None).cast("bigint"))
    return F.when(last >= 0, F.concat(hashes, alone)).otherwise(alone)


def _probe(docs: DataFrame, windows: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """Rows ``id, text_key, n_words, pos, size, items, copies``: one per verified hit, and one without hit per document.

    ``copies`` counts the rows of equal id and text: its sum if ``small``, else the same on every row.
    """
    words = docs.select("id", "text_key", word_list(F.col("text")).alias("words"))
    known = windows.select(F.col("key").alias("item_key"), "gram", "items")
    n_words = F.size("words").cast("long").alias("n_words")
    probes = F.array(*[F.struct(F.lit(size).alias("size"), _window_hashes(F.col("words"), size).alias("keys"))
                       for size in sizes or [1]])
    each = words.select("id", "text_key", "words", F.explode(probes).alias("probe")).select(
        "id", "text_key", "words", F.col("probe.size").alias("size"), F.posexplode("probe.keys").alias("pos", "key"))
    same = F.slice("words", F.col("pos") + 1, F.col("size")) == F.col("gram")
    if small:
        hits = each.join(F.broadcast(known), (F.col("key") == F.col("item_key")) & same, "left").where(
            F.col("gram").isNotNull() | F.col("key").isNull())
        copies = (F.col("key").isNull() & (F.col("size") == (sizes or [1])[0])).cast("long")
    else:
        found = each.where("key is not null").select(
            F.col("id").alias("hit_id"), F.col("text_key").alias("hit_key"), "size", "pos", "key"
        ).distinct().join(known, F.col("key") == F.col("item_key"))
        words = words.groupBy("id", "text_key").agg(F.first("words").alias("words"), F.count("*").alias("times"))
        here = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key"))
        hits = words.join(found, here & same, "left")
        copies = F.col("times")
    return hits.select("id", "text_key", n_words, "size", "items", copies.alias("copies"),
                       F.when(F.col("gram").isNotNull(), F.col("pos")).alias("pos"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", n: int = 13,
                  max_broadcast: int = 32 << 20) -> DataFrame:
    """One row per document: ``id_col, n_words, n_hit, n_items, items`` (sorted strings), ``spans``.

    ``spans`` are the maximal runs of hit words, as ``(start, stop)`` word places.
    ``max_broadcast`` bounds the bytes of the windows that are broadcast.
    """
    windows = materialize(item_windows(items, item_col, item_text, n), "windows")
    sizes = [r["size"] for r in windows.groupBy("size").count().orderBy("size").collect()]  # n values at most
    letters = F.octet_length(F.array_join("gram", " ")) + F.octet_length(F.array_join("items", " ")) + 64
    small = (windows.agg(F.sum(letters)).first()[0] or 0) <= max_broadcast
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn(
        "text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    hits = _probe(base, windows, sizes, small)
    place = F.when(F.col("pos").isNotNull(), F.struct(F.col("pos").alias("start"), (F.col("pos") + F.col("size")).alias("stop")))
    per_doc = hits.groupBy("id", "text_key").agg(
        F.max("n_words").alias("n_words"), (F.sum if small else F.max)("copies").cast("int").alias("copies"),
        F.sort_array(F.collect_set(place)).alias("places"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    none = F.expr("cast(array() as array<struct<start:int,stop:int>>)")
    merged = F.aggregate("places", none, lambda runs, p: F.when(
        (F.size(runs) > 0) & (F.element_at(runs, -1)["stop"] >= p["start"]),
        F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(
            F.element_at(runs, -1)["start"].alias("start"),
            F.greatest(F.element_at(runs, -1)["stop"], p["stop"]).alias("stop")))),
    ).otherwise(F.concat(runs, F.array(p))))
    spans = per_doc.withColumn("spans", F.when(F.size("places") == 0, none).otherwise(merged))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return spans.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        "items", "spans", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).drop("copy")


def contaminated(share: int = 20) -> Column:
    """True if hit words are at least one in ``share`` of a document's words."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def remove_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", share: int = 20, **names) -> DataFrame:
    """``docs`` without the contaminated ones; rows without an id stay."""
    gone = contamination(docs, items, id_col, **names).where(contaminated(share)).select(F.col(id_col).alias("gone_id"))
    gone = materialize(gone.distinct(), "contaminated")
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """``docs`` whose hit words, with what stands before each, are cut from the text; the rest is unchanged."""
    found = contamination(docs, items, id_col, text_col, **names).where("n_hit > 0").groupBy(
        F.col(id_col).alias("hit_id")).agg(F.max("spans").alias("hit_spans"))
    found = materialize(found, "spans")
    whole, spans = docs[text_col], found["hit_spans"]
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    pieces = F.regexp_extract_all(whole, F.lit(gap + RAW_WORD), F.lit(0))
    tail = F.regexp_extract(whole, f"({gap})$", 1)
    left = F.filter(pieces, lambda p, i: ~F.exists(spans, lambda s: (i >= s["start"]) & (i < s["stop"])))
    cut = F.when(spans.isNull(), whole).otherwise(F.concat(F.array_join(left, ""), tail))
    joined = docs.join(found, docs[id_col] == found["hit_id"], "left")
    return joined.select(*[cut.alias(c) if c == text_col else docs[c] for c in docs.columns])
