"""SimHash near-duplicates: a byte-position index with count filtering.

A 64-bit fingerprint is eight positional bytes. Fingerprints that differ in at most
``max_bits`` bits share at least 8 - ``max_bits`` of them, and of those at least half
(rounded up) lie in one half of the eight positions. So the inverted index is keyed by
the combinations of that many positions inside a half: any linked pair meets under
some key, and a posting list is narrowed by 24 bits (for 3 bits) instead of 8. In a
posting list the shared positional bytes of a pair are tallied; pairs with the
guaranteed number are verified on the differing bits.

Equal fingerprints are one entry, so groups of copies cost nothing. Posting lists
of up to ``list_limit`` entries are linked by a search that keeps only a spanning
forest. Longer lists (very many near copies) are linked without comparing entries:
with r = max_bits // 2, two entries are linked exactly if a point lies within
max_bits - r bits of one and r bits of the other, so each point connects what is
around it. The bits fixed by the key never differ and are not tried.

Defined results: null and empty texts have fingerprint zero, linked like any other;
fewer words than a shingle are one shingle; the component of rows with a null id
counts the other ids; equal ids are one document; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.arrays import map_arrow, slices, word_bounds
from lodeworks.llm.components import components
from lodeworks.sources.scratch import materialize

SEED = 42
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def _fingerprints(data: np.ndarray, offsets: np.ndarray, words: int) -> np.ndarray:
    """The fingerprint of each text, by majority over the bits of its shingles' hashes."""
    n = len(offsets) - 1
    out = np.zeros(n, np.uint64)
    starts, ends, places = word_bounds(data, offsets)
    if not len(starts):
        return out
    # The words of all texts, one space after each; a shingle is then a piece of this line.
    lengths = ends - starts + 1
    to = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=to[1:])
    index = np.repeat(starts - to[:-1], lengths) + np.arange(to[-1])
    line = np.append(LOWER[data], np.uint8(0x20))[np.minimum(index, len(data))]
    line[to[1:] - 1] = 0x20
    sizes = np.diff(places)
    counts = np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    some = np.flatnonzero(counts)
    into = np.zeros(len(some) + 1, np.int64)
    np.cumsum(counts[some], out=into[1:])
    first = np.repeat(places[some] - into[:-1], counts[some]) + np.arange(into[-1])
    last = np.minimum(first + words, np.repeat(places[some + 1], counts[some]))
    text, digest = line.tobytes(), xxhash.xxh64_intdigest
    hashes = np.array([digest(text[a:b], SEED) for a, b in zip(to[first].tolist(), (to[last] - 1).tolist(), strict=True)],
                      np.uint64)
    votes = np.add.reduceat(np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1), into[:-1], axis=0, dtype=np.int32)
    out[some] = np.packbits(votes * 2 > counts[some, None], axis=1).view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``id, fp``: the 64 bits as a signed number."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text", 1 << 20):
            fp = _fingerprints(data, offsets, words).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(fp)], names=["id", "fp"])

    return map_arrow(source, run, f"id {source.schema['id'].dataType.simpleString()}, fp bigint")


def key_masks(max_bits: int) -> list[int]:
    """Masks of the byte positions of each index key, as signed numbers."""
    if not 0 <= max_bits <= 6:
        raise ValueError("max_bits must be 0 to 6")
    size = math.ceil((8 - max_bits) / 2)
    masks = [sum(0xFF << (8 * p) for p in positions)
             for half in (range(4), range(4, 8)) for positions in combinations(half, size)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def differing_bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the eight positional bytes are equal."""
    differ = a.bitwiseXOR(b)
    same = [(F.shiftrightunsigned(differ, 8 * p).bitwiseAND(F.lit(0xFF).cast("long")) == 0).cast("int") for p in range(8)]
    return sum(same[1:], same[0])


def _spanning(entries: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the entries of one list: tally, then verify, each entry against those not reached."""
    links, left = [], entries.view(np.uint64)
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            differ = left ^ at
            near = np.flatnonzero((differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= 8 - max_bits)
            near = near[np.bitwise_count(differ[near]) <= max_bits]
            if len(near):
                found = left[near]
                links += [(int(at.view(np.int64)), int(x)) for x in found.view(np.int64)]
                front += list(found)
                left = np.delete(left, near)
    return links


def _flips(fixed: int, radius: int) -> list[int]:
    """All changes of at most ``radius`` bits outside ``fixed``, as signed numbers."""
    free = [1 << b for b in range(64) if not (fixed >> b) & 1]
    made = [sum(c) for r in range(radius + 1) for c in combinations(free, r)]
    return [m - (1 << 64) if m >> 63 else m for m in made]


def _long_list_links(entries: DataFrame, masks: list[int], max_bits: int) -> DataFrame:
    """Links inside the long posting lists (``mask, fp``), through the points around each entry."""
    near = max_bits // 2
    parts = []
    for i, mask in enumerate(masks):
        steps = [F.struct(F.lit(m).cast("long").alias("step"), F.lit(bin(m & (2**64 - 1)).count("1")).alias("bits"))
                 for m in _flips(mask & (2**64 - 1), max_bits - near)]
        parts.append(entries.where(F.col("mask") == i).select("mask", "fp", F.inline(F.array(*steps))))
    around = parts[0]
    for part in parts[1:]:
        around = around.unionByName(part)
    around = materialize(around.select("mask", "fp", F.col("fp").bitwiseXOR(F.col("step")).alias("point"), "bits"), "points")
    # Everything around a point hangs on its smallest entry within the shorter distance, if there is one.
    centre = materialize(around.where(F.col("bits") <= near).groupBy("mask", "point").agg(F.min("fp").alias("centre")), "centres")
    return around.join(centre, ["mask", "point"]).where("fp <> centre").select(
        F.col("fp").alias("u"), F.col("centre").alias("v")).distinct()


def links(classes: DataFrame, max_bits: int = 3, list_limit: int = 20_000) -> DataFrame:
    """Links ``u, v`` between the distinct fingerprints ``fp`` that connect what lies within ``max_bits`` bits."""
    masks = key_masks(max_bits)
    keys = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("part"))
                     for i, m in enumerate(masks)])
    index = classes.select("fp", F.inline(keys))
    lists = materialize(index.groupBy("mask", "part").agg(
        F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high")).where("n > 1"), "lists")
    close = (shared_bytes(F.col("low"), F.col("high")) >= 8 - max_bits) & (
        differing_bits(F.col("low"), F.col("high")) <= max_bits)
    two = lists.where("n = 2").where(close).select(F.col("low").alias("u"), F.col("high").alias("v"))
    longer = lists.where("n > 2").select("mask", "part", "n")
    shared = materialize(index.join(longer, ["mask", "part"]), "postings")
    gathered = shared.where(F.col("n") <= list_limit).groupBy("mask", "part").agg(F.collect_list("fp").alias("entries"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [link for entries in batch.column(0) for link in _spanning(
                entries.values.to_numpy(zero_copy_only=False), max_bits)]
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in made], pa.int64()),
                                              pa.array([v for _, v in made], pa.int64())], names=["u", "v"])

    found = two.unionByName(map_arrow(gathered.select("entries"), run, "u bigint, v bigint"))
    if lists.where(F.col("n") > list_limit).limit(1).count():
        found = found.unionByName(_long_list_links(shared.where(F.col("n") > list_limit).select("mask", "fp"), masks, max_bits))
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 3,
                    list_limit: int = 20_000) -> DataFrame:
    """``id_col, fp, component_id``: the smallest id that can be reached over links."""
    marked = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = materialize(marked.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    roots = components(links(classes, max_bits, list_limit))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    smallest = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    named = materialize(rooted.join(smallest, "root").select(F.col("fp").alias("class_fp"), "component_id"), "components")
    return marked.join(named, F.col("fp") == F.col("class_fp")).select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id; rows without an id stay."""
    groups = near_duplicates(docs, id_col, text_col, **options)
    gone = groups.where(F.col(id_col) > F.col("component_id")).select(F.col(id_col).alias("gone_id")).distinct()
    gone = materialize(gone, "copies")
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
