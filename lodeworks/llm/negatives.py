"""Hard negatives of anchor vectors, from exact integer inner products.

Rows are packed into tiles: a few thousand vectors as one row of bytes, the anchors into
tiles of their own. Every anchor tile meets every candidate tile once, block by block:
anchor tiles are dealt over ``cells`` and candidate tiles go to the cells of all anchor
tiles, so that a pair of tiles is one row of an equi-join and a task holds one pair at a
time. The scores of a pair come from Strassen's recursion on int64 blocks, padded with
zeros. Its additions and products wrap modulo 2**64, so every score that fits 64 bits is
exact. Components beyond 32 bits, or tiles whose scores might not fit 64, are an error.

Two passes follow, because the windows depend on the positives. The first keeps, for
each anchor, a heap of its best rows of the same label; the second, for each anchor and
positive, a heap of the best rows of other labels within the window. Heaps of one task
are merged as tiles pass, those of all tasks by rank, so what is shuffled is the size of
the heaps and no score is stored.

Defined results: rows without id, label or vector, and rows with a null, infinite or
not-a-number component, take no part. Shorter vectors count as padded with zeros; an
empty vector scores 0 with all. Rows with the anchor's own id are none of its positives
or negatives. Rows that repeat each count: a repeated candidate fills several ranks, a
repeated anchor returns its rows as often. Anchors without positives, or without rows in
a window, return nothing; so does an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.llm.arrays import map_arrow
from lodeworks.sources.scratch import materialize

TILE_ROWS = 2048  # vectors in a candidate tile
ANCHOR_ROWS = 1024  # vectors in an anchor tile, on average
TILE_BYTES = 4 << 20  # bytes of a tile as int64, unless one vector has more
LEAF = 8  # smallest side of a block that is split further
HELD = 8  # anchor tiles whose heaps a task keeps before it hands them on
PACKED = "tile bigint, side int, ids binary, labels binary, vectors binary"


def _even(block: np.ndarray) -> np.ndarray:
    return np.pad(block, [(0, size % 2) for size in block.shape]) if any(s % 2 for s in block.shape) else block


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices modulo 2**64, with seven products of quarters instead of eight."""
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, columns, a.shape[1]) <= leaf:
        return a @ b
    a, b = _even(a), _even(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * k), np.int64)
    out[:i, :k] = m1 + m4 - m5 + m7
    out[:i, k:] = m3 + m5
    out[i:, :k] = m2 + m4
    out[i:, k:] = m1 - m2 + m3 + m6
    return out[:rows, :columns]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all rows of ``b``; the narrower is padded with zeros."""
    side = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, [(0, 0), (0, side - x.shape[1])]) for x in (a, b))
    if a.size and b.size and side * int(np.abs(a).max()) * int(np.abs(b).max()) >= 2**63:
        raise OverflowError("inner products of these vectors may not fit 64 bits")
    return strassen(a, np.ascontiguousarray(b.T))


def integers(column: pa.Array, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Floored multiples of all components, the places between the lists, and which lists have only finite numbers."""
    values = column.flatten()
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    places = np.append(0, np.cumsum(sizes))
    missing = values.is_null().to_numpy(zero_copy_only=False)
    numbers = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.append(0, np.cumsum(missing | ~np.isfinite(numbers)))
    whole = np.floor(factor * np.where(np.isfinite(numbers), numbers, 0.0))
    return whole, places, bad[places[1:]] == bad[places[:-1]]


def _tile(name: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    """One row: its vectors in order of their ids."""
    order = np.argsort(ids, kind="stable")
    if vectors.size and np.abs(vectors).max() >= 2.0**31:
        raise OverflowError("a component times the factor does not fit 32 bits")
    return pa.RecordBatch.from_arrays([
        pa.array([name], pa.int64()), pa.array([vectors.shape[1]], pa.int32()),
        *[pa.array([x[order].tobytes()], pa.binary()) for x in (ids.astype("<i8"), labels.astype("<i8"), vectors.astype("<i4"))],
    ], names=["tile", "side", "ids", "labels", "vectors"])


def pack(rows: DataFrame, factor: float, tile_rows: int | None) -> DataFrame:
    """Tiles of ``id, label, vector``, made where the rows lie; without ``tile_rows`` one for each partition, named by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def tile() -> pa.RecordBatch:
            nonlocal made, waiting
            side = max(v.shape[1] for _, _, v in waiting)
            ids, labels = (np.concatenate([w[i] for w in waiting]) for i in (0, 1))
            vectors = np.concatenate([np.pad(v, [(0, 0), (0, side - v.shape[1])]) for _, _, v in waiting])
            name = part if tile_rows is None else (part << 32) + made
            waiting, made = [], made + 1
            return _tile(name, ids, labels, vectors)

        for batch in batches:
            whole, places, fine = integers(batch.column("vector"), factor)
            sizes = np.diff(places)
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            for side in np.unique(sizes[fine]).tolist():
                which = np.flatnonzero(fine & (sizes == side))
                limit = len(which) if tile_rows is None else max(1, min(tile_rows, TILE_BYTES // max(1, 8 * side)))
                for start in range(0, len(which), limit):
                    some = which[start:start + limit]
                    if tile_rows is not None and waiting and sum(len(w[0]) for w in waiting) + len(some) > limit:
                        yield tile()
                    waiting.append((ids[some], labels[some], whole[places[some, None] + np.arange(side)]))
        if waiting:
            yield tile()

    return map_arrow(rows, run, PACKED)


def _unpacked(row: dict, of: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[f"{of}_{c}"], "<i8") for c in ("ids", "labels"))
    vectors = np.frombuffer(row[f"{of}_vectors"], "<i4").astype(np.int64)
    return ids, labels, vectors.reshape(len(ids), row[f"{of}_side"])


class Heaps:
    """For each of many keys the ``size`` best entries seen: higher scores first, then smaller ids.

    Entries come as columns (key, score, id) and are kept sorted; merging two sets of
    heaps is a sort of both, cut at ``size`` entries a key.
    """

    def __init__(self, size: int):
        self.size, self.entries = size, np.zeros((3, 0), np.int64)

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        both = np.concatenate([self.entries, np.stack([keys, scores, ids])], axis=1)
        both = both[:, np.lexsort((both[2], ~both[1], both[0]))]
        first = np.searchsorted(both[0], both[0])
        self.entries = both[:, np.arange(both.shape[1]) - first < self.size]


def best_same(scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Row, score and id of the best ``size`` fitting columns of each row; ``ids`` ascend."""
    out: list[tuple[int, np.ndarray]] = []
    for row in range(len(scores)):
        at = np.flatnonzero(fits[row])
        out.append((row, at[np.argsort(~scores[row, at], kind="stable")[:size] if len(at) > size else slice(None)]))
    rows = np.repeat([r for r, _ in out], [len(a) for _, a in out]).astype(np.int64)
    at = np.concatenate([a for _, a in out]) if out else np.zeros(0, np.int64)
    return rows, scores[rows, at], ids[at]


def best_within(scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, rows: np.ndarray, lows: np.ndarray, highs: np.ndarray,
                size: int) -> tuple[np.ndarray, ...]:
    """For each window, a row and the bounds of its scores: number of the window, score and id of the best ``size`` columns."""
    windows, columns = [], []
    for row in np.unique(rows).tolist():
        at = np.flatnonzero(fits[row])
        falling = ~scores[row, at]  # ascends as the score falls
        order = np.argsort(falling, kind="stable")
        at, falling = at[order], falling[order]
        for w in np.flatnonzero(rows == row).tolist():
            first, end = np.searchsorted(falling, ~highs[w]), np.searchsorted(falling, ~lows[w], "right")
            columns.append(at[first:max(first, min(end, first + size))])
            windows.append(np.full(len(columns[-1]), w))
    at, which = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (columns, windows))
    return which, scores[rows[which], at], ids[at]


def _meet(anchors: DataFrame, candidates: DataFrame, n_anchor_tiles: int) -> DataFrame:
    """A row for each pair of tiles."""
    sc = anchors.sparkSession.sparkContext
    tiles = candidates.count()
    cells = max(1, min(tiles, max(2 * sc.defaultParallelism, tiles // 8)))
    left = candidates.select(*[F.col(c).alias(f"c_{c}") for c in candidates.columns]).withColumn(
        "cell", F.pmod(F.xxhash64("c_tile"), F.lit(cells))).withColumn(
        "at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_anchor_tiles - 1).cast("bigint"))))
    right = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns]).withColumn(
        "a_cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cells - 1).cast("bigint"))))
    return left.join(right, (F.col("at") == F.col("a_tile")) & (F.col("cell") == F.col("a_cell"))).drop("at", "cell", "a_cell")


def _positives(pairs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[Heaps, np.ndarray]] = {}
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                if row["a_tile"] not in held and len(held) >= HELD:
                    yield from _handed(held)
                own, labels, left = _unpacked(row, "a")
                ids, others, right = _unpacked(row, "c")
                scores = products(left, right)
                fits = (labels[:, None] == others) & (own[:, None] != ids)
                held.setdefault(row["a_tile"], (Heaps(size), own))[0].add(*best_same(scores, fits, ids, size))
        yield from _handed(held)

    def _handed(held: dict[int, tuple[Heaps, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for tile, (heaps, own) in held.items():
            places, scores, ids = heaps.entries
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(ids), tile), places, own[places], ids, scores)],
                                             names=["tile", "place", "anchor_id", "positive_id", "positive_score"])
        held.clear()

    found = map_arrow(pairs, run, "tile bigint, place bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    best = Window.partitionBy("tile", "place").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("slot", F.row_number().over(best)).where(F.col("slot") <= size)


def _negatives(pairs: DataFrame, size: int, low: int, high: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[Heaps, dict]] = {}
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                if row["a_tile"] not in held and len(held) >= HELD:
                    yield from _handed(held)
                own, labels, left = _unpacked(row, "a")
                ids, others, right = _unpacked(row, "c")
                wanted = row["a_positives"]
                rows = np.array([p["place"] for p in wanted], np.int64)
                # low * positive <= 100 * negative <= high * positive, as bounds of the negative
                lows = np.array([-(-low * p["positive_score"] // 100) for p in wanted], np.int64)
                highs = np.array([high * p["positive_score"] // 100 for p in wanted], np.int64)
                scores = products(left, right)
                fits = (labels[:, None] != others) & (own[:, None] != ids)
                held.setdefault(row["a_tile"], (Heaps(size), wanted))[0].add(
                    *best_within(scores, fits, ids, rows, lows, highs, size))
        yield from _handed(held)

    def _handed(held: dict[int, tuple[Heaps, list[dict]]]) -> Iterator[pa.RecordBatch]:
        for tile, (heaps, wanted) in held.items():
            windows, scores, ids = heaps.entries
            of = [[p[c] for p in wanted] for c in ("place", "slot", "anchor_id", "positive_id", "positive_score")]
            columns = [np.full(len(ids), tile), *[np.array(x, np.int64)[windows] for x in of], ids, scores]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
        held.clear()

    names = ["tile", "place", "slot", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    found = map_arrow(pairs, run, ", ".join(f"{n} bigint" for n in names))
    best = Window.partitionBy("tile", "place", "slot").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         factor: float = 256.0, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components count as ``floor(factor * x)``. Each anchor (a row where ``is_anchor``
    holds) has its ``positives`` best rows of the same label, and with each of them the
    ``negatives`` best rows of other labels whose score is ``low`` to ``high`` percent
    of the positive's.
    """
    known = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull())

    def plain(of: DataFrame) -> DataFrame:
        return of.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                         F.col(vector_col).alias("vector"))

    n, side = known.where(is_anchor).agg(F.count("*"), F.max(F.size(vector_col))).first()
    parts = max(1, -(-n // max(1, min(ANCHOR_ROWS, TILE_BYTES // max(1, 8 * (side or 1))))))
    anchors = materialize(pack(plain(known.where(is_anchor)).repartition(parts), factor, None), "anchor-tiles")
    candidates = materialize(pack(plain(known), factor, TILE_ROWS), "candidate-tiles")
    found = materialize(_positives(_meet(anchors, candidates, parts), positives), "positives")
    listed = found.groupBy(F.col("tile").alias("of_tile")).agg(F.collect_list(F.struct(
        "place", "slot", "anchor_id", "positive_id", "positive_score")).alias("positives"))
    windows = anchors.join(listed, F.col("tile") == F.col("of_tile")).drop("of_tile")
    mined = _negatives(_meet(windows, candidates, parts), negatives, low, high)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
