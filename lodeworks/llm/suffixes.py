"""Repeated passages by a depth-limited radix sort of suffixes.

A byte goes if it is covered by a window of ``LENGTH`` bytes that also starts in a
document of smaller id. Windows are suffixes read to depth ``LENGTH`` only, ordered by
most-significant-digit passes; the groups that are still equal at that depth are exactly
the repeated windows.

Ordering every suffix of the corpus would move many times its size, so the first digit
is taken sparsely. A window holds ``LENGTH - GRAM + 1`` grams of ``GRAM`` bytes; the one
with the smallest hash is its anchor, so equal windows have equal anchors in the same
place. Only anchors are dealt out, by the top bits of their hash (the digit):

1. ``pack``: documents become slices of bounded size, stored once and compressed.
2. ``first digit``: each slice sends every distinct anchor hash once; a digit's task
   tells the slices which of them occur in more than one document.
3. ``contexts``: each slice cuts out, around those anchors, all windows they are the
   anchor of, as one string per distinct context with the smallest document it is in.
4. ``radix``: a digit's task orders the windows of its contexts, eight bytes a pass, and
   drops a group as soon as it is alone; it sends back the smallest document per window.
5. ``cut``: each slice removes what is covered.

A passage that a third of all documents share costs an entry per slice, not per
document. The number of digits grows with the bytes of the texts, so that a digit has
the contexts of about ``DIGIT_BYTES`` of text. A digit is heavy if the contexts of its
anchors may pass ``heavy_bytes``, as those of a gram that stands in very many places do:
an anchor has one digit, so more digits would not part them. Its windows go row by row
instead: the smallest document of each window is a partial aggregate, and a join that
Spark may split brings it back. So a task holds a digit of bounded size, whatever is
common. Nothing is decided by a hash alone: hashes only choose what is looked at, and
windows are compared as bytes. A digit of 2 GB or more would be an error.

Defined results: null text is empty; texts shorter than a window stay; a null id counts
as greater than every other; rows of equal id do not remove from each other; no rows
give no rows. Ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from lodeworks.llm.arrays import flat, gather, map_arrow, per_row, row_starts, slices, tiles
from lodeworks.sources.scratch import materialize

LENGTH = 50
GRAM = 24
SPAN = LENGTH - GRAM + 1  # grams in a window
SLICE_BYTES = 2 << 20
STRETCH = 1 << 18  # places whose hashes are computed together
PLACE_BITS = np.uint64(19)  # of the ordering key; the same everywhere, so that equal windows choose equally
SORTED_AT_ONCE = 1 << 18  # windows
DIGIT_BYTES = 8 << 20  # of text to a digit
HEAVY_BYTES = 256 << 20  # of contexts in a digit, before equal ones are merged
REPORTED = ("n_bytes", "n_removed", "n_spans", "kept")
LAST_ID = np.iinfo(np.int64).max  # stands for a null id

_VALUES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)  # a fixed random value per byte
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def gram_hashes(data: np.ndarray, length: int = GRAM) -> np.ndarray:
    """Hash of the ``length`` bytes from each place on, built by doubling."""
    known = {1: _VALUES[data]}
    size = 1
    while 2 * size <= length:
        known[2 * size] = known[size][:-size] * _power(size) + known[size][size:] if len(data) >= 2 * size else known[size][:0]
        size *= 2
    total, have = known[size], size
    for part in (1 << b for b in range(size.bit_length() - 2, -1, -1)):
        if length & part:
            n = max(0, len(data) - have - part + 1)
            total = total[:n] * _power(part) + known[part][have:have + n]
            have += part
    return _mix(total)  # so that the smallest hash is no property of the text


def _mix(values: np.ndarray) -> np.ndarray:
    """Spread over all 64 bits; different values stay different."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _slide(values: np.ndarray, span: int, choose) -> np.ndarray:
    """``choose`` over each ``span`` values."""
    best, have = values, 1
    while have < span:
        step = min(have, span - have)
        best = choose(best[:len(best) - step], best[step:])
        have += step
    return best


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of windows with one anchor: gram hash, row, place of the first window, number of windows."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.astype(np.uint64), none, none, none
    n = len(data) - LENGTH + 1
    place, hashes = np.zeros(n, np.int64), np.zeros(n, np.uint64)
    for start in range(0, n, STRETCH):
        here = gram_hashes(data[start:start + STRETCH + LENGTH - 1])
        # The low bits of the ordering key are the place: one sliding minimum finds hash and place, the first of equals.
        keys = (here >> PLACE_BITS << PLACE_BITS) | np.arange(len(here), dtype=np.uint64)
        found = (_slide(keys, SPAN, np.minimum) & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
        place[start:start + len(found)] = found + start
        hashes[start:start + len(found)] = here[found]
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    windows = np.flatnonzero(rows[:n] == rows[LENGTH - 1:])
    if not len(windows):
        return none.astype(np.uint64), none, none, none
    new = np.ones(len(windows), bool)
    new[1:] = (place[windows[1:]] != place[windows[:-1]]) | (np.diff(windows) > 1)
    heads = np.flatnonzero(new)
    first = windows[heads]
    # Anchors are small hashes; mixed again, their top bits deal them out evenly.
    return _mix(hashes[first]), rows[first].astype(np.int64), first, np.diff(np.append(heads, len(windows)))


def _distinct(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and whether each occurs under two ids or more."""
    order = np.argsort(hashes, kind="stable")
    hashes, ids = hashes[order], ids[order]
    heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    if not len(heads):
        return hashes, np.zeros(0, bool)
    return hashes[heads], np.minimum.reduceat(ids, heads) != np.maximum.reduceat(ids, heads)


def _by_digit(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits that occur among sorted hashes, and the places between them."""
    digits, starts = np.unique((hashes >> np.uint64(64 - bits)).astype(np.int64), return_index=True)
    return digits, np.append(starts, len(hashes))


class Slice:
    """A stored slice: its rows, flat texts, ids and anchors."""

    def __init__(self, content: bytes):
        codec = pa.ipc.open_stream(content)
        self.rows = codec.read_next_batch()
        self.data, self.offsets = flat(self.rows.column("text"))
        ids = self.rows.column("id").cast(pa.int64())
        self.ids = ids.fill_null(LAST_ID).to_numpy(zero_copy_only=False)
        self.hashes, self.owner, self.first, self.windows = anchors(self.data, self.offsets)
        self.distinct, self.several = _distinct(self.hashes, self.ids[self.owner])

    def contexts(self, shared: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Runs with a shared anchor, the distinct contexts, the context of each run, the hash of each context."""
        runs = np.flatnonzero(shared[np.searchsorted(self.distinct, self.hashes)]) if len(shared) else np.zeros(0, np.int64)
        starts = self.first[runs]
        values, places = gather(self.data, starts, starts + self.windows[runs] + LENGTH - 1)
        encoded = tiles(values, places[:-1]).dictionary_encode()
        which = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        hashes = np.zeros(len(encoded.dictionary), np.uint64)
        hashes[which] = self.hashes[runs]
        return runs, encoded.dictionary, which, hashes


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    number = task.partitionId() << 32
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for rows, _, _ in slices(batches, "text", SLICE_BYTES):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=options) as stream:
            stream.write_batch(rows)
        size = len(flat(rows.column("text"))[0])
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                                          pa.array([size], pa.int64())], names=["slice", "content", "size"])
        number += 1


def _first_digit(bits: int):
    """Per slice and digit: the next 40 bits of every distinct anchor hash, a bit for those in several documents, bytes of contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(*(batch.column(c).to_pylist() for c in ("slice", "content")), strict=True):
                part = Slice(content)
                keys = (part.distinct << np.uint64(bits)).byteswap().view(np.uint8).reshape(-1, 8)[:, :5]
                some, bounds = _by_digit(part.distinct, bits)
                of_run = np.searchsorted(some, (part.hashes >> np.uint64(64 - bits)).astype(np.int64))
                sizes = np.bincount(of_run, weights=part.windows + LENGTH - 1, minlength=len(some)).astype(np.int64)
                spans = list(zip(bounds.tolist(), bounds[1:].tolist(), strict=False))
                yield pa.RecordBatch.from_arrays([
                    pa.array(some), pa.array(np.full(len(some), number)),
                    pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([np.packbits(part.several[a:b]).tobytes() for a, b in spans], pa.binary()), pa.array(sizes),
                ], names=["digit", "slice", "keys", "several", "size"])

    return run


def _shared_keys(heavy_bytes: int):
    """Of one digit: for each slice, a bit per key that says whether two documents or more have it; and whether it is heavy."""

    def run(group: pa.Table) -> pa.Table:
        heavy = sum(group.column("size").to_pylist()) > heavy_bytes
        found = _shared_bits(group)
        return found.append_column("heavy", pa.array([heavy] * len(found), pa.bool_()))

    return run


def _shared_bits(group: pa.Table) -> pa.Table:
    numbers = group.column("slice").to_pylist()
    raw = [np.frombuffer(k, np.uint8).reshape(-1, 5) for k in group.column("keys").to_pylist()]
    several = [np.unpackbits(np.frombuffer(s, np.uint8))[:len(k)] for s, k in zip(group.column("several").to_pylist(), raw, strict=True)]
    counts = np.array([len(k) for k in raw])
    wide = np.zeros((counts.sum(), 8), np.uint8)
    wide[:, 3:] = np.concatenate(raw)
    keys = wide.view(">u8").ravel().astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    sizes = np.diff(np.append(heads, len(ordered)))
    often = (sizes > 1) | (np.maximum.reduceat(np.concatenate(several)[order], heads) > 0)
    shared = np.zeros(len(keys), bool)
    shared[order] = np.repeat(often, sizes)
    ends = np.cumsum(counts)
    digit = group.column("digit")[0].as_py()
    return pa.table({"slice": pa.array(numbers, pa.int64()), "digit": pa.array([digit] * len(numbers), pa.int64()),
                     "blob": pa.array([np.packbits(shared[e - c:e]).tobytes() for e, c in zip(ends, counts, strict=True)], pa.binary())})


def _shared_of(part: Slice, bits: int, digits: list[int], blobs: list[bytes]) -> np.ndarray:
    known, bounds = _by_digit(part.distinct, bits)
    shared = np.zeros(len(part.distinct), bool)
    for at, blob in zip(np.searchsorted(known, digits).tolist(), blobs, strict=True):
        shared[bounds[at]:bounds[at + 1]] = np.unpackbits(np.frombuffer(blob, np.uint8))[:bounds[at + 1] - bounds[at]]
    return shared


def _squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _expand(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def _least(ids: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """The smallest id of each of ``n`` groups."""
    least = np.full(n, LAST_ID)
    np.minimum.at(least, groups, ids)
    return least


def _shared_contexts(row: dict, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each digit of a slice: the distinct contexts of the shared anchors (bytes, lengths) and their smallest ids."""
    part = Slice(row["content"])
    runs, contexts, which, hashes = part.contexts(_shared_of(part, bits, row["digits"], row["blobs"]))
    least = _least(part.ids[part.owner[runs]], which, len(contexts))
    data, offsets = flat(contexts)
    order = np.argsort(hashes >> np.uint64(64 - bits), kind="stable")
    some, bounds = _by_digit(hashes[order], bits)
    for digit, a, b in zip(some.tolist(), bounds.tolist(), bounds[1:].tolist(), strict=False):
        own = order[a:b]
        values, _ = gather(data, offsets[own], offsets[own + 1])
        yield digit, values, offsets[own + 1] - offsets[own], least[own]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One at a time: a row is a slice."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _cut_contexts(bits: int):
    """Per slice and digit: the contexts, packed; not those of heavy digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            heavy = set(row["heavy"] or [])
            made, some = [], []
            for digit, values, lengths, least in _shared_contexts(row, bits):
                if digit not in heavy:
                    some.append(digit)
                    made.append(len(lengths).to_bytes(8, "little") + _squeeze(
                        lengths.astype("<u4").tobytes() + least.astype("<i8").tobytes() + values.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([row["slice"]] * len(some), pa.int64()),
                                              pa.array(made, pa.binary())], names=["digit", "slice", "contexts"])

    return run


def _cut_windows(bits: int):
    """Of heavy digits, a row for each window of a slice's contexts, with its place among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            for digit, values, lengths, least in _shared_contexts(row, bits):
                if digit not in row["heavy"]:
                    continue
                sizes = lengths - LENGTH + 1
                starts = np.repeat(np.cumsum(lengths) - lengths - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                ids = np.repeat(least, sizes)
                for a in range(0, len(starts), 1 << 16):
                    own = starts[a:a + (1 << 16)]
                    cut, places = gather(values, own, own + LENGTH)
                    n = len(own)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(n, digit)), pa.array(np.full(n, row["slice"])), pa.array(np.arange(a, a + n)),
                        tiles(cut, places[:-1]), pa.array(ids[a:a + n])], names=["digit", "slice", "place", "window", "least"])

    return run


def _heavy_answers(packed: DataFrame, bits: int) -> DataFrame:
    """``slice, digit, blob`` of the heavy digits, like those of ``_radix``."""
    windows = materialize(map_arrow(packed.where(F.size("heavy") > 0), _cut_windows(bits),
                                    "digit bigint, slice bigint, place bigint, window binary, least bigint"), "windows")
    # Stored, so that the join can split a window that is in very many slices.
    least = materialize(windows.groupBy(F.col("window").alias("same")).agg(F.min("least").alias("smallest")), "smallest")
    found = windows.join(least, F.col("window") == F.col("same")).groupBy("slice", "digit").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "smallest"))), lambda x: x["smallest"]).alias("smallest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [_squeeze(x.values.to_numpy().astype("<i8").tobytes()) for x in batch.column("smallest")]
            yield pa.RecordBatch.from_arrays([batch.column("slice"), batch.column("digit"), pa.array(blobs, pa.binary())],
                                             names=["slice", "digit", "blob"])

    return map_arrow(found, run, "slice bigint, digit bigint, blob binary")


def _digit(data: np.ndarray, windows: np.ndarray, depth: int) -> np.ndarray:
    """The (up to) eight bytes of each window at ``depth``, as one number."""
    width = min(8, LENGTH - depth)
    found = np.zeros((len(windows), 8), np.uint8)
    for i in range(width):
        found[:, 8 - width + i] = data[windows + (depth + i)]
    return found.view(">u8").ravel().astype(np.uint64)


def repeated_windows(data: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (of ``windows``) that start a window occurring twice or more, and the group of each.

    Most-significant-digit passes of eight bytes: a pass orders what is left by its
    group so far and its next digit; what is alone then is dropped. Many windows are
    first dealt into heaps by their first digit, and each heap is ordered by itself.
    """
    heaps = -(-len(windows) // SORTED_AT_ONCE)
    heap = np.zeros(len(windows), np.int32)
    for start in range(0, len(windows), SORTED_AT_ONCE):
        first = _digit(data, windows[start:start + SORTED_AT_ONCE], 0)
        heap[start:start + SORTED_AT_ONCE] = ((first * _BASE) >> np.uint64(40)) % np.uint64(heaps)
    every, names, used = [], [], 0
    for h in range(heaps):
        left = np.flatnonzero(heap == h)
        groups = np.zeros(len(left), np.int64)
        for depth in range(0, LENGTH, 8):
            if not len(left):
                break
            digit = _digit(data, windows[left], depth)
            order = np.lexsort((digit, groups)) if depth else np.argsort(digit, kind="stable")
            left, groups, digit = left[order], groups[order], digit[order]
            new = np.ones(len(left), bool)
            new[1:] = (groups[1:] != groups[:-1]) | (digit[1:] != digit[:-1])
            heads = np.flatnonzero(new)
            sizes = np.diff(np.append(heads, len(left)))
            groups = np.repeat(np.arange(len(heads)), sizes)
            several = np.repeat(sizes > 1, sizes)
            left, groups = left[several], groups[several]
        if len(left):
            every.append(left)
            names.append(groups + used)
            used += int(groups[-1]) + 1
    none = np.zeros(0, np.int64)
    return (np.concatenate(every), np.concatenate(names)) if every else (none, none)


def _radix(group: pa.Table) -> pa.Table:
    """Of one digit: for each slice, the smallest id for every window of its contexts."""
    numbers = group.column("slice").to_pylist()
    lengths, ids, values = [], [], []
    for blob in group.column("contexts").to_pylist():
        n, raw = int.from_bytes(blob[:8], "little"), _expand(blob[8:])
        lengths.append(np.frombuffer(raw, "<u4", n).astype(np.int64))
        ids.append(np.frombuffer(raw, "<i8", n, 4 * n))
        values.append(np.frombuffer(raw, np.uint8, offset=12 * n))
    counts = [len(x) for x in lengths]
    every = np.concatenate(lengths)
    encoded = tiles(np.concatenate(values), np.cumsum(every) - every).dictionary_encode()
    which = encoded.indices.to_numpy(zero_copy_only=False)
    least = _least(np.concatenate(ids), which, len(encoded.dictionary))
    data, offsets = flat(encoded.dictionary)
    del lengths, ids, values, every, raw
    sizes = np.diff(offsets) - LENGTH + 1  # windows of each distinct context
    ends = np.cumsum(sizes)
    begins = ends - sizes
    if len(data) >= 1 << 31:
        raise OverflowError("more than 2 GB of contexts in one digit")
    windows = np.repeat((offsets[:-1] - begins).astype(np.int32), sizes)
    windows += np.arange(ends[-1], dtype=np.int32)
    smallest = np.repeat(least, sizes)
    left, groups = repeated_windows(data, windows)
    if len(left):
        smallest[left] = _least(smallest[left], groups, groups[-1] + 1)[groups]
    answers, at = [], 0
    for count in counts:
        own = which[at:at + count]
        at += count
        n = sizes[own]
        index = np.repeat(begins[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        answers.append(_squeeze(smallest[index].astype("<i8").tobytes()))
    digit = group.column("digit")[0].as_py()
    return pa.table({"slice": pa.array(numbers, pa.int64()), "digit": pa.array([digit] * len(numbers), pa.int64()),
                     "blob": pa.array(answers, pa.binary())})


def _covered(part: Slice, bits: int, digits: list[int], blobs: list[bytes], answered: list[int], answers: list[bytes]) -> np.ndarray:
    """Bytes of the slice covered by a window that starts in a document of smaller id."""
    change = np.zeros(len(part.data) + 1, np.int32)
    runs, contexts, which, hashes = part.contexts(_shared_of(part, bits, digits, blobs))
    if len(runs):
        _, offsets = flat(contexts)
        sizes = np.diff(offsets) - LENGTH + 1
        # The answers follow the order in which the contexts were sent: digit by digit.
        order = np.argsort(hashes >> np.uint64(64 - bits), kind="stable")
        sent = [np.frombuffer(_expand(b), "<i8") for _, b in sorted(zip(answered, answers, strict=True))]
        smallest = np.concatenate(sent)
        begins = np.zeros(len(sizes), np.int64)
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        n = sizes[which]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        earlier = smallest[np.repeat(begins[which], n) + inner] < np.repeat(part.ids[part.owner[runs]], n)
        starts = (np.repeat(part.first[runs], n) + inner)[earlier]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def _cut(bits: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("content", "digits", "blobs", "answered", "answers")
        for batch in batches:
            for content, *lists in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                part = Slice(content)
                gone = _covered(part, bits, *(x or [] for x in lists))
                begins = gone.copy()
                begins[1:] &= ~gone[:-1] | row_starts(len(gone), part.offsets)[1:]
                removed = per_row(gone, part.offsets)
                left = np.diff(part.offsets) - removed
                kept = tiles(part.data[~gone], np.cumsum(left) - left)
                text = [None if null and not k else k.decode("utf-8", "ignore") for null, k in zip(
                    part.rows.column("text").is_null().to_pylist(), kept.to_pylist(), strict=True)]
                columns = {name: part.rows.column(name) for name in part.rows.schema.names}
                columns |= {"text": pa.array(text, pa.string()), "n_bytes": pa.array(np.diff(part.offsets)),
                            "n_removed": pa.array(removed), "n_spans": pa.array(per_row(begins, part.offsets)), "kept": kept}
                yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)

    return run


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digits: int | None = None,
                heavy_bytes: int = HEAVY_BYTES) -> DataFrame:
    """``docs`` with repeated bytes cut from the text, and ``n_bytes, n_removed, n_spans, kept``,
    which replace columns of these names.

    ``kept`` holds the bytes that stay; the text is these bytes without the parts of
    characters that were cut through. ``digits`` (a power of two) is the number of radix
    buckets; by default it grows with the texts, from two for each shuffle partition.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    inner = {c: f"column_{i}" for i, c in enumerate(others)}
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                         *[F.col(f"`{c}`").alias(new) for c, new in inner.items()])
    packed = materialize(map_arrow(source, _pack_rows, "slice bigint, content binary, size bigint"), "slices")
    wanted = digits or max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")),
                           -(-(packed.agg(F.sum("size")).first()[0] or 0) // DIGIT_BYTES))
    bits = max(1, (wanted - 1).bit_length())
    packed = packed.select("slice", "content")
    sent = map_arrow(packed, _first_digit(bits), "digit bigint, slice bigint, keys binary, several binary, size bigint")
    bitmaps = materialize(sent.groupBy("digit").applyInArrow(
        _shared_keys(heavy_bytes), "slice bigint, digit bigint, blob binary, heavy boolean"), "bitmaps")
    known = bitmaps.groupBy("slice").agg(F.collect_list("digit").alias("digits"), F.collect_list("blob").alias("blobs"),
                                         F.collect_list(F.when(F.col("heavy"), F.col("digit"))).alias("heavy"))
    asked = packed.join(known, "slice").select("slice", "content", "digits", "blobs", "heavy")
    contexts = map_arrow(asked, _cut_contexts(bits), "digit bigint, slice bigint, contexts binary")
    answers = materialize(contexts.groupBy("digit").applyInArrow(_radix, "slice bigint, digit bigint, blob binary"), "answers")
    if not bitmaps.where("heavy").isEmpty():
        answers = answers.unionByName(materialize(_heavy_answers(asked, bits), "heavy-answers"))
    bitmaps = bitmaps.drop("heavy")
    # One list of small values per slice and kind; a slice has at most one value per digit.
    both = bitmaps.withColumn("kind", F.lit("bits")).unionByName(answers.withColumn("kind", F.lit("ids")))
    value = F.struct("digit", "blob")
    lists = both.groupBy("slice").agg(
        F.collect_list(F.when(F.col("kind") == "bits", value)).alias("b"),
        F.collect_list(F.when(F.col("kind") == "ids", value)).alias("a")).select(
        "slice", F.col("b.digit").alias("digits"), F.col("b.blob").alias("blobs"),
        F.col("a.digit").alias("answered"), F.col("a.blob").alias("answers"))
    out = StructType([*source.schema.fields, StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
                      StructField("n_spans", LongType()), StructField("kept", BinaryType())])
    result = map_arrow(packed.join(lists, "slice", "left"), _cut(bits, to_arrow_schema(out)), out)
    back = {c: new for c, new in inner.items() if c not in REPORTED} | {id_col: "id", text_col: "text"}
    return result.select(*[F.col(back[c]).alias(c) for c in docs.columns if c in back], *REPORTED)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs``, with repeated passages cut from the text."""
    hidden = {c: f"own_{c}" for c in REPORTED if c in docs.columns}
    found = deduplicate(docs.withColumnsRenamed(hidden), id_col, text_col)
    return found.select(*[F.col(f"`{hidden.get(c, c)}`").alias(c) for c in docs.columns])
