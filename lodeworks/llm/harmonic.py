"""Packing of token documents into sequences by classes of reciprocal capacity.

A piece of class k has the k-th part of a sequence's capacity, so k pieces fill a bin
whatever documents they come from: a class needs a counter, not a search for room. The
classes are the halvings of the capacity (k = 1, 2, 4, ...). A document is cut into
pieces of these lengths, longest first: whole sequences, then the binary digits of the
rest; each digit is the class of its piece. Where the capacity is a power of two, every
full bin is full to the last token.

Workers (tasks) pack on their own: bins are filled from one task's documents in their
order, nothing is shuffled, and a lost executor costs its tasks only. A task holds back
the pieces of its open bins, less than one bin a class. At its end they are laid out
from the longest to the shortest, which again fills whole sequences; what is left is
less than one sequence and becomes sequences whose lengths are powers of two times the
smallest piece. Sequences are numbered by task and order, so a repeated task numbers
alike.

Defined results: null and empty texts are the end token alone; rows with equal or null
ids are packed each on its own; no rows make no pieces. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodeworks.llm.arrays import map_arrow, slices
from lodeworks.llm.pieces import Cutter, Memo, encode_texts, library_ids

FEW_BITS = 40  # a task's sequences are numbered below 2**FEW_BITS


def piece_lengths(capacity: int) -> np.ndarray:
    """Lengths of the classes, the longest first: halves of ``capacity`` down to an odd part, then its halves rounded down."""
    lengths = [capacity]
    while lengths[-1] > 1:
        lengths.append(lengths[-1] // 2)
    return np.array(lengths, np.int64)


def cut(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents of the given sizes: document, start in it, class (a place in ``piece_lengths``); in order."""
    lengths = piece_lengths(capacity)
    counts = np.empty((len(sizes), len(lengths)), np.int64)
    rest = sizes.astype(np.int64)
    for i, length in enumerate(lengths):
        counts[:, i], rest = rest // length, rest % length
    flat = counts.ravel()
    kinds = np.repeat(np.tile(np.arange(len(lengths)), len(sizes)), flat)
    owners = np.repeat(np.arange(len(sizes)), counts.sum(axis=1))
    ends = np.cumsum(lengths[kinds])
    starts = ends - lengths[kinds]
    return owners, starts - (np.cumsum(sizes) - sizes)[owners], kinds


class Bins:
    """The open bins of one worker. Pieces are columns (any values); each closed bin gives its pieces a sequence and an offset."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.lengths, self.next = capacity, piece_lengths(capacity), first
        self.open: dict[int, np.ndarray] = {}

    def add(self, kinds: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Columns (rows of the array), then sequence and offset, of all pieces whose bins are full now."""
        full = []
        for kind in np.unique(kinds).tolist():
            mine = columns[:, kinds == kind]
            if kind in self.open:
                mine = np.concatenate([self.open[kind], mine], axis=1)
            length = int(self.lengths[kind])
            fit = self.capacity // length  # pieces in a bin of this class
            ready = mine.shape[1] // fit * fit
            at = np.arange(ready)
            full.append(np.concatenate([mine[:, :ready], [self.next + at // fit, at % fit * length]]))
            self.next += ready // fit
            self.open[kind] = mine[:, ready:].copy()
        return np.concatenate(full, axis=1) if full else np.zeros((len(columns) + 2, 0), np.int64)

    def close(self) -> np.ndarray:
        """The pieces of the open bins, from the longest to the shortest, in whole sequences and then in shrinking ones."""
        kinds = sorted(k for k, pieces in self.open.items() if pieces.shape[1])
        if not kinds:
            return np.zeros((0, 0), np.int64)
        pieces = np.concatenate([self.open[k] for k in kinds], axis=1)
        lengths = np.repeat(self.lengths[kinds], [self.open[k].shape[1] for k in kinds])
        sequences, offsets = [], []
        used, left = 0, int(lengths.sum())
        room = self._room(left)
        for length in lengths.tolist():
            if used + length > room:
                self.next, used = self.next + 1, 0
                room = self._room(left)
            sequences.append(self.next)
            offsets.append(used)
            used, left = used + length, left - length
        self.next, self.open = self.next + 1, {}
        return np.concatenate([pieces, [sequences, offsets]])

    def _room(self, left: int) -> int:
        """Length of the next sequence: the longest class that what is left can fill."""
        return int(self.lengths[self.lengths <= left].max())


@lru_cache(maxsize=1)
def _encoder(path: str) -> tuple[Cutter, Memo]:
    return Cutter(path), Memo(library_ids(path))


def pack(docs: DataFrame, vocabulary_path: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """A row for each piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``, and its ``ids`` if asked for.

    Documents are encoded and closed by ``end_id``; the pieces of a sequence lie in it
    without gaps. ``ids_crc32`` is of the ids as little-endian unsigned 32-bit numbers.
    """
    if capacity < 1:
        raise ValueError("a sequence holds at least one token")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = to_arrow_type(source.schema["id"].dataType)
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, memo = _encoder(vocabulary_path)
        bins = Bins(capacity, TaskContext.get().partitionId() << FEW_BITS)
        owners, kept = pa.array([], kind), pa.array([], pa.binary())  # ids and tokens of the pieces held back

        def rows(placed: np.ndarray, of: pa.Array, tokens: pa.Array) -> pa.RecordBatch:
            at = pa.array(placed[0])
            columns = [of.take(at), *[pa.array(c) for c in placed[1:]]]
            if with_ids:
                raw = tokens.take(at)
                lists = pa.ListArray.from_arrays(pa.array((np.append(0, np.cumsum(placed[2]))).astype(np.int32)),
                                                 pa.array(np.frombuffer(b"".join(raw.to_pylist()), "<i4")))
                columns.append(lists)
            return pa.RecordBatch.from_arrays(columns, names=["id", *names, "ids"][:len(columns)])

        for batch, data, offsets in slices(batches, "text", 1 << 20):
            ids, places = encode_texts(cutter, memo, data, offsets)
            ids = np.insert(ids, places[1:], end_id).astype("<u4")
            sizes = np.diff(places) + 1
            doc, start, kinds = cut(sizes, capacity)
            lengths = bins.lengths[kinds]
            ends = np.cumsum(lengths)  # the pieces are all ids in order
            raw = memoryview(ids.tobytes())
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
            n_held = len(owners)
            owners = pa.concat_arrays([owners, batch.column("id").cast(kind).take(pa.array(doc))])
            if with_ids:
                own = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(0, 4 * ends).astype(np.int32)),
                                                                           pa.py_buffer(raw)])
                kept = pa.concat_arrays([kept, own])
            columns = np.stack([n_held + np.arange(len(ends)), start, lengths, np.array(sums, np.int64), sizes[doc]])
            placed = bins.add(kinds, columns)
            if placed.shape[1]:
                yield rows(placed, owners, kept)
            held = [pieces for pieces in bins.open.values() if pieces.shape[1]]
            left = np.concatenate([p[0] for p in held]) if held else np.zeros(0, np.int64)
            owners = owners.take(pa.array(left))
            kept = kept.take(pa.array(left)) if with_ids else kept
            first = 0
            for pieces in held:  # the held pieces are the first of the next round
                pieces[0] = np.arange(first, first + pieces.shape[1])
                first += pieces.shape[1]
        placed = bins.close()
        if placed.size:
            yield rows(placed, owners, kept)

    schema = f"id {source.schema['id'].dataType.simpleString()}, " + ", ".join(f"{n} bigint" for n in names)
    return map_arrow(source, run, schema + ", ids array<int>" * with_ids).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """``sequence_id, n_pieces, n_tokens, padding``: full and power-of-two sequences are not padded, others up to ``capacity``."""
    n = F.sum("length")
    return pieces.groupBy("sequence_id").agg(
        F.count("*").alias("n_pieces"), n.alias("n_tokens"),
        F.when(n.bitwiseAND(n - 1) == 0, F.lit(0)).otherwise(capacity - n).cast("bigint").alias("padding"))
