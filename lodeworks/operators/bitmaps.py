"""Frequent item sets from vertical bitmaps: which baskets hold an item, a bit for each.

Weighted baskets are cut to their frequent items and packed, where they lie, into blocks
of ``BLOCK`` baskets. A block is one stored row: for each of its items a bitmap over the
block's baskets, kept as places where that is shorter, and the weights as bitmaps of
their binary digits. The support of a set in a block is the number of bits that its
items' bitmaps have in common, digit by digit of the weights; supports are summed over
the blocks of a task before anything is shuffled.

Sets grow level by level: two frequent sets that differ in their last item make a
candidate if all its parts are frequent. Candidates are counted in rounds of a bounded
number, so a round's list can be sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.indexing import dense_index
from lodeworks.operators.itemsets import item_counts
from lodeworks.sources.scratch import materialize
from lodeworks.sources.workers import importable

BLOCK = 1 << 15  # baskets in a block
ROUND = 200_000  # candidates that are sent to all tasks at a time
AT_ONCE = 512  # candidates whose bitmaps a task combines at a time
BLOCKS = "items array<string>, bitmaps array<binary>, digits array<binary>, n int"


def _packed(places: np.ndarray, n: int) -> bytes:
    """A bitmap over ``n`` baskets, or its places if they are shorter; the first byte says which."""
    if 2 * len(places) < n // 8:
        return b"p" + places.astype("<u2").tobytes()
    bits = np.zeros(n, bool)
    bits[places] = True
    return b"b" + np.packbits(bits).tobytes()


def _unpacked(blob: bytes, width: int) -> np.ndarray:
    """The bitmap as ``width`` bytes."""
    out = np.zeros(width, np.uint8)
    if blob[:1] == b"b":
        out[:len(blob) - 1] = np.frombuffer(blob, np.uint8, offset=1)
    else:
        places = np.frombuffer(blob, "<u2", offset=1)
        np.bitwise_or.at(out, places >> 3, np.uint8(128) >> (places & 7).astype(np.uint8))
    return out


def blocks(weighted: DataFrame, frequent: DataFrame) -> DataFrame:
    """Stored blocks of the baskets (``items, w``), cut to the ``frequent`` items (``item``)."""
    importable(weighted.sparkSession)
    rows = weighted.select(F.monotonically_increasing_id().alias("basket"), "items", "w")
    # Stored, so that both sides of the cut see the same numbers.
    rows = materialize(rows, "numbered")
    held = rows.select("basket", "w", F.explode("items").alias("item")).join(frequent.select("item"), "item", "left_semi")
    cut = held.groupBy("basket", "w").agg(F.collect_list("item").alias("items")).select("items", "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def block(size: int) -> pa.RecordBatch:
            nonlocal waiting
            table = pa.Table.from_batches(waiting).combine_chunks()
            own, rest = table.slice(0, size), table.slice(size)
            waiting = rest.to_batches()
            lists = own.column("items").combine_chunks()
            coded = lists.flatten().dictionary_encode()
            baskets = np.repeat(np.arange(len(own)), lists.value_lengths().to_numpy())
            codes = coded.indices.to_numpy()
            order = np.lexsort((baskets, codes))
            ends = np.searchsorted(codes[order], np.arange(len(coded.dictionary)), "right")
            parts = np.split(baskets[order], ends[:-1])
            weights = own.column("w").to_numpy().astype(np.int64)
            digits = [np.packbits((weights >> d & 1).astype(bool)).tobytes() for d in range(int(weights.max()).bit_length())]
            return pa.RecordBatch.from_arrays([
                pa.array([coded.dictionary.to_pylist()]), pa.array([[_packed(p, len(own)) for p in parts]], pa.list_(pa.binary())),
                pa.array([digits], pa.list_(pa.binary())), pa.array([len(own)], pa.int32())], names=["items", "bitmaps", "digits", "n"])

        for batch in batches:
            waiting.append(batch)
            while sum(b.num_rows for b in waiting) >= BLOCK:
                yield block(BLOCK)
        if sum(b.num_rows for b in waiting):
            yield block(BLOCK)

    return materialize(cut.mapInArrow(run, BLOCKS), "bitmaps")


def supports(stored: DataFrame, candidates: list[tuple[str, ...]]) -> DataFrame:
    """``place, n``: the support of each candidate (by its place in the list) that stands in some block."""
    names = sorted({i for c in candidates for i in c})
    number = {name: i for i, name in enumerate(names)}
    held = stored.sparkSession.sparkContext.broadcast((names, np.array([[number[i] for i in c] for c in candidates], np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted = held.value
        total = np.zeros(len(wanted), np.int64)
        number = {name: i for i, name in enumerate(names)}
        for batch in batches:
            for items, bitmaps, digits, n in zip(*(batch.column(c).to_pylist() for c in ("items", "bitmaps", "digits", "n")), strict=True):
                width = -(-n // 64) * 8
                row = np.full(len(names), -1)
                known = [(number[item], blob) for item, blob in zip(items, bitmaps, strict=True) if item in number]
                for at, (name, _) in enumerate(known):
                    row[name] = at
                maps = np.stack([_unpacked(blob, width) for _, blob in known] or [np.zeros(width, np.uint8)]).view(np.uint64)
                planes = [np.frombuffer(d.ljust(width, b"\0"), np.uint64) for d in digits]
                here = np.flatnonzero((row[wanted] >= 0).all(axis=1))
                for some in (here[i:i + AT_ONCE] for i in range(0, len(here), AT_ONCE)):
                    both = np.bitwise_and.reduce(maps[row[wanted[some]]], axis=1)
                    for digit, plane in enumerate(planes):
                        total[some] += np.bitwise_count(both & plane).sum(axis=1, dtype=np.int64) << digit
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["place", "n"])

    return stored.mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))


def _candidates(sets: DataFrame, size: int) -> DataFrame:
    """Sets of ``size`` items all of whose parts of one item less are in ``sets`` (``items``, sorted)."""
    start = F.slice("items", 1, size - 2)
    a = sets.select(start.alias("start"), F.element_at("items", -1).alias("x"))
    b = sets.select(start.alias("start_b"), F.element_at("items", -1).alias("y"))
    grown = a.join(b, (F.col("start") == F.col("start_b")) & (F.col("x") < F.col("y"))).select(
        F.concat("start", F.array("x", "y")).alias("items"))
    if size == 2:
        return grown
    parts = grown.select("items", F.explode(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.filter(
        "items", lambda _, j: j != i))).alias("part"))
    known = parts.join(sets.select(F.col("items").alias("part")), "part", "left_semi")
    return known.groupBy("items").count().where(F.col("count") == size).select("items")


def frequent_sets(weighted: DataFrame, min_exclusive: int, max_size: int = 3, round_size: int = ROUND) -> DataFrame:
    """All frequent sets of 2 to ``max_size`` items as ``items`` (sorted array), ``size``, ``n``.

    ``weighted`` has distinct baskets, as ``itemsets.weigh_baskets`` gives them.
    """
    spark = weighted.sparkSession
    sets = materialize(item_counts(weighted).where(F.col("n") > min_exclusive), "items")
    stored = blocks(weighted, sets)
    sets = sets.select(F.array("item").alias("items"))
    found = [spark.createDataFrame([], "items array<string>, size int, n bigint")]
    for size in range(2, max_size + 1):
        wanted = materialize(dense_index(_candidates(sets, size), ["items"], "at"), "candidates")
        n = wanted.count()
        counted = []
        for first in range(0, n, round_size):
            some = wanted.where((F.col("at") >= first) & (F.col("at") < first + round_size)).orderBy("at").select("items").collect()
            listed = materialize(supports(stored, [tuple(r[0]) for r in some]).where(F.col("n") > min_exclusive), "supports")
            counted.append(listed.select((F.col("place") + first).alias("place"), "n"))
        if not counted:
            break
        named = wanted.join(reduce(DataFrame.unionByName, counted), F.col("at") == F.col("place"))
        sets = materialize(named.select("items", F.lit(size).alias("size"), "n"), "sets")
        found.append(sets)
    return reduce(DataFrame.unionByName, found)
