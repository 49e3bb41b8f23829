"""Texts of Arrow batches as flat NumPy bytes, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from lodeworks.session import RECOMMENDED
from lodeworks.sources.workers import importable

SLICE = 4 << 20  # bytes of text a task looks at together; a longer text is a slice of its own


# Workers give large arrays back to the system at once; by default the C library keeps up to 64 MB of them.
MALLOC = {"MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(8 << 20), "MALLOC_ARENA_MAX": "2"}
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: StructType | str) -> DataFrame:
    """``df.mapInArrow``; a local session's workers find this package where the driver has it.

    Rows are texts here: Spark's default of 10,000 rows a batch would hold tens of
    megabytes twice, in the JVM and in Python. A session that sets no number of rows
    itself gets that of ``lodeworks/session.py``; one that does keeps it.
    """
    sc, conf = df.sparkSession.sparkContext, df.sparkSession.conf
    if conf.get(BATCH_ROWS, None) is None:
        conf.set(BATCH_ROWS, RECOMMENDED[BATCH_ROWS])
    for name, value in MALLOC.items():
        sc.environment.setdefault(name, value)
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 places between them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    whole = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if size else np.zeros(0, np.uint8)
    return whole, offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE) -> Iterator[
        tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows of at most ``limit`` bytes of text (or a single row), with their flat texts."""
    for batch in batches:
        data, offsets = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield (batch.slice(start, stop - start), data[offsets[start]:offsets[stop]],
                   offsets[start:stop + 1] - offsets[start])
            start = stop


def tiles(data: np.ndarray, starts: np.ndarray) -> pa.BinaryArray:
    """The pieces between consecutive ``starts`` and the end, as binary values that share ``data``."""
    if len(data) >= 1 << 31:
        raise OverflowError("more than 2 GB of pieces in one task")
    bounds = np.append(starts, len(data)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])


def codes_of(values: pa.Array) -> np.ndarray:
    """Equal values get equal numbers from 0 up; exact, by hashing with comparison."""
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def row_starts(size: int, offsets: np.ndarray) -> np.ndarray:
    """True at the first byte of each row that has any."""
    flags = np.zeros(size + 1, bool)
    flags[offsets[:-1]] = True
    return flags[:size]


# White space that separates words (fixed values: U+0020, U+0009 to U+000D).
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``; for each row, the place of its first word among them, and the end."""
    blank = BLANK[data]
    first = row_starts(len(data), offsets)
    before = np.empty(len(data), bool)
    before[:1] = True
    before[1:] = blank[:-1]
    starts = np.flatnonzero(~blank & (before | first))
    after = np.empty(len(data), bool)
    after[-1:] = True
    after[:-1] = blank[1:] | first[1:]
    ends = np.flatnonzero(~blank & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the given intervals one after another, and the places between them."""
    lengths = ends - starts
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=places[1:])
    out = np.empty(places[-1], np.uint8)
    first = 0
    while first < len(starts):  # about a million bytes at a time: the index is much larger than they are
        last = max(first + 1, int(np.searchsorted(places, places[first] + (1 << 20), "right")) - 1)
        index = np.repeat(starts[first:last] - places[first:last], lengths[first:last])
        index += np.arange(places[first], places[last])
        out[places[first]:places[last]] = data[index]
        first = last
    return out, places

