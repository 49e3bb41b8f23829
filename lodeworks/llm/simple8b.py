"""Token ids in word-aligned files: Simple-8b with escapes and block offsets.

A 64-bit word holds a 4-bit selector and 60 bits of ids, from sixty 1-bit ids to one of
60 bits; the selector names how many and how wide. An id beyond 60 bits is an escape:
its word holds the place of the id in a list behind the words. Blocks of ``BLOCK`` ids
start a word, and their word offsets stand in the header, so that blocks are packed and
unpacked independently: both run over all blocks of a segment at once, without a loop
over ids.

``write`` orders the documents by id over all files, encodes them and packs whole
documents into segments of about ``SEGMENT`` ids. A file is Parquet; each row is a
segment with its place in the order, its documents and the packed bytes. ``read`` gives
the documents back from the files alone. Nothing but one count per file is gathered.

Defined results: null and empty texts are the end id alone; rows with equal ids keep
their own rows, in any order among themselves; null ids come first; no rows make no
segments, and reading none gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodeworks.llm.arrays import map_arrow, slices
from lodeworks.llm.pieces import Cutter, Memo, encode_texts, library_ids

BLOCK = 256  # ids in a block
SEGMENT = 1 << 19  # ids after which a segment ends with its document
# Ids in a word by selector, the most first; each is 60 // count bits wide. Selector 14 is the escape.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = len(COUNTS)
HEADER = struct.Struct("<4sIQII")  # magic, block size, ids, words, escapes
MAGIC = b"S8b1"


def pack(ids: np.ndarray) -> bytes:
    """A segment: header, word offset of each block, words, escaped ids; all little-endian."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    need = np.searchsorted(np.uint64(1) << np.arange(1, 61, dtype=np.uint64), ids, "right").astype(np.uint8) + 1  # > 60: escape
    left = np.minimum(BLOCK - np.arange(n) % BLOCK, n - np.arange(n))  # ids to the end of the block
    choice = np.full(n, ESCAPE, np.uint8)
    most, span = need.copy(), 1  # most[i]: widest of the span ids from i on
    for selector in range(ESCAPE - 1, -1, -1):
        count = COUNTS[selector]
        while span < count:
            step = min(span, count - span)
            grown = np.full(n, 255, np.uint8)
            if n > step:
                grown[:n - step] = np.maximum(most[:n - step], most[step:])
            most, span = grown, span + step
        choice[(left >= count) & (most <= 60 // count)] = selector
    jump = np.append(COUNTS, 1)[choice]
    at = np.arange(0, n, BLOCK)
    ends = np.minimum(at + BLOCK, n)
    taken = np.zeros(n, bool)
    while len(at):  # all blocks step by one word
        taken[at] = True
        at = at + jump[at]
        going = at < ends
        at, ends = at[going], ends[going]
    starts = np.flatnonzero(taken)
    chosen = choice[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector, count in enumerate(COUNTS):
        which = np.flatnonzero(chosen == selector)
        if len(which):
            bits = np.uint64(60 // count)
            values = ids[starts[which, None] + np.arange(count)]
            shifts = np.arange(count, dtype=np.uint64) * bits
            words[which] |= np.bitwise_or.reduce(values << shifts, axis=1)
    escapes = np.flatnonzero(chosen == ESCAPE)
    words[escapes] |= np.arange(len(escapes), dtype=np.uint64)
    offsets = np.searchsorted(starts, np.arange(0, n, BLOCK)).astype("<u4")
    return b"".join((HEADER.pack(MAGIC, BLOCK, n, len(words), len(escapes)), offsets.tobytes(),
                     words.astype("<u8").tobytes(), ids[starts[escapes]].astype("<u8").tobytes()))


def unpack(payload: bytes, first_block: int = 0, n_blocks: int | None = None) -> np.ndarray:
    """Ids (uint64) of a segment, or of some of its blocks."""
    magic, block, n, n_words, n_escapes = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a segment of ids")
    total = -(-n // block)
    last = total if n_blocks is None else min(total, first_block + n_blocks)
    offsets = np.append(np.frombuffer(payload, "<u4", total, HEADER.size), n_words).astype(np.int64)
    body = HEADER.size + 4 * total
    words = np.frombuffer(payload, "<u8", n_words, body)[offsets[first_block]:offsets[last]]
    escaped = np.frombuffer(payload, "<u8", n_escapes, body + 8 * n_words)
    selectors = (words >> np.uint64(60)).astype(np.uint8)
    counts = np.append(COUNTS, 1)[selectors]
    places = np.cumsum(counts) - counts
    ids = np.zeros(int(counts.sum()), np.uint64)
    for selector, count in enumerate(COUNTS):
        which = np.flatnonzero(selectors == selector)
        if len(which):
            bits = 60 // count
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            ids[places[which, None] + np.arange(count)] = (words[which, None] >> shifts) & np.uint64((1 << bits) - 1)
    which = np.flatnonzero(selectors == ESCAPE)
    ids[places[which]] = escaped[(words[which] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return ids


@lru_cache(maxsize=1)
def _encoder(path: str) -> tuple[Cutter, Memo]:
    return Cutter(path), Memo(library_ids(path))


def write(docs: DataFrame, path: str, vocabulary_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
          files: int | None = None) -> None:
    """Encode every row's text and write the ids, each document closed by ``end_id``, in ascending order of id."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ordered = source.repartitionByRange(files, F.col("id").asc_nulls_first()).sortWithinPartitions(
        F.col("id").asc_nulls_first()).withColumn("file", F.spark_partition_id())
    kind = to_arrow_type(source.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, memo = _encoder(vocabulary_path)
        before = segment = 0
        waiting: list[tuple] = []

        def closed() -> pa.RecordBatch:
            nonlocal before, segment, waiting
            lengths = np.concatenate([w[1] for w in waiting])
            ids = np.concatenate([w[2] for w in waiting])
            owners = pa.concat_arrays([w[0] for w in waiting])
            row = pa.RecordBatch.from_arrays([
                pa.array([waiting[0][3]], pa.int32()), pa.array([segment], pa.int64()), pa.array([before], pa.int64()),
                pa.array([len(ids)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(owners)], pa.int32()), owners),
                pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.array(lengths)),
                pa.array([pack(ids)], pa.binary())], names=["file", "segment", "before", "n_ids", "docs", "lengths", "payload"])
            before, segment, waiting = before + len(ids), segment + 1, []
            return row

        for rows, data, offsets in slices(batches, "text", 1 << 20):
            ids, places = encode_texts(cutter, memo, data, offsets)
            waiting.append((rows.column("id").cast(kind), np.diff(places) + 1, np.insert(ids, places[1:], end_id),
                            rows.column("file")[0].as_py()))
            if sum(len(w[2]) for w in waiting) >= SEGMENT:
                yield closed()
        if waiting:
            yield closed()

    id_kind = source.schema["id"].dataType.simpleString()
    packed = map_arrow(ordered, run, f"file int, segment bigint, before bigint, n_ids bigint, docs array<{id_kind}>, "
                       "lengths array<bigint>, payload binary")
    # The words are dense already; compressing them again costs time and saves little.
    packed.write.option("compression", "none").parquet(path)


def _starts(segments: DataFrame) -> DataFrame:
    """Ids before each file: one row per file is summed up in order."""
    sizes = segments.groupBy("file").agg(F.sum("n_ids").alias("size"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(F.col("file").alias("of_file"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("file_start"))


def read(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` of each document, from the files; ``ids`` as well if asked for.

    The table of file starts is broadcast: a row for each file that ``write`` was told to make.
    """
    stored = spark.read.parquet(path)
    placed = stored.join(F.broadcast(_starts(stored.select("file", "n_ids"))), F.col("file") == F.col("of_file")).select(
        (F.col("file_start") + F.col("before")).alias("first"), "docs", "lengths", "payload")
    id_kind = stored.schema["docs"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, owners, lengths, payload in zip(*batch.columns, strict=True):
                ids = unpack(payload.as_py()).astype("<u4")
                sizes = lengths.values.to_numpy(zero_copy_only=False)
                places = np.append(0, np.cumsum(sizes))
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]
                columns = [owners.values, pa.array(places[:-1] + first.as_py()), pa.array(sizes), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    kind = f"id {id_kind.simpleString()}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return map_arrow(placed, run, kind + ", ids array<bigint>" * with_ids).withColumnRenamed("id", id_col)
