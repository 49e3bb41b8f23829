"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Features are hashed indicators, each counted once per document: its words, and the one-
to three-grams of its word shapes (case, closing signs, and whether the word repeats the
one before). An indicator is scaled by the log ratio of its counts in the two
classes, every document's vector is scaled to length one, and a linear hinge loss is
fitted by dual coordinate descent. The score is a logistic curve over the margin, fitted
on sampled rows that the descent has not seen and weighted back to the class shares.

The counts cover all labelled training rows. Only the descent is fitted on a bounded
sample: ``fit_rows`` rows, half of each class if there are enough, those with the
smallest hash of their id. The model is two numbers per feature, whatever the corpus.

Defined results: null and empty texts have no features and get the score of margin zero
plus bias; labels that are null are left out, repeated labels count each time; with one
class only, the score is that class's share; without labels it is 0.5; rows are scored
one by one. Only the text is an input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.arrays import map_arrow, slices, word_bounds

WORD_BITS, SHAPE_BITS = 17, 15
SIZE = (1 << WORD_BITS) + (1 << SHAPE_BITS)
BROADCAST_LABELS = 32 << 20  # bytes; more are joined by a shuffle

_VALUES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)  # a fixed random value per byte
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_SLICE = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and features of all indicators, ordered by row; each pair once."""
    starts, ends, places = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(places))
    # A word's hash is a difference of running sums, moved back to the word's own start.
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _powers(_BASE, len(data)), out=sums[1:])
    words = _mix((sums[ends] - sums[starts]) * _powers(_BACK, len(data) + 1)[starts])

    def inside(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int32)
        np.cumsum(flags, out=total[1:])
        return total[ends] - total[starts]

    upper, lower = (data >= 0x41) & (data <= 0x5A), (data >= 0x61) & (data <= 0x7A)
    n_upper, n_lower = inside(upper), inside(lower)
    case = np.where(n_lower > 0, np.where(n_upper > 1, 4, np.where(upper[starts], 2, 1)), np.where(n_upper > 0, 3, 0))
    sign = (data > 0x20) & (data < 0x7F) & ~upper & ~lower & ~((data >= 0x30) & (data <= 0x39))
    last = data[ends - 1].astype(np.int64) * sign[ends - 1]
    second = ends - 2
    two = (second >= starts) & sign[ends - 1] & sign[np.maximum(second, 0)]
    last = last * 256 + data[np.maximum(second, 0)].astype(np.int64) * two
    again = np.zeros(len(words), np.int64)
    again[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    shapes = _mix(((case * 65536 + last) * 2 + again).astype(np.uint64) * np.uint64(_BASE) + np.uint64(1))

    keys = [(rows << 20) | (words >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
    grams = shapes
    for n in range(3):  # one-, two- and three-grams that stay in their row
        if n:
            grams = _mix(grams[:-1] * np.uint64(3) + shapes[n:]) if len(grams) > 1 else grams[:0]
        whole = rows[:len(grams)] == rows[n:]
        place = (grams >> np.uint64(64 - SHAPE_BITS)).astype(np.int64) + (1 << WORD_BITS)
        keys.append((rows[:len(grams)][whole] << 20) | place[whole])
    found = np.unique(np.concatenate(keys))
    return found >> 20, found & ((1 << 20) - 1)


@dataclass(frozen=True)
class Model:
    """``weights`` of the scaled indicators, their ``ratios``, and the curve from margin to score."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        rows, found = features(data, offsets)
        values = self.ratios[found]
        length = np.sqrt(np.bincount(rows, values * values, n))
        margin = np.bincount(rows, self.weights[found] * values, n) / np.where(length > 0, length, 1.0) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def log_ratios(counts: np.ndarray, totals: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Log of the smoothed share of documents with a feature, class 1 against class 0."""
    shares = (counts + smoothing) / (totals[:, None] + 2 * smoothing)
    return np.log(shares[1] / shares[0])


def descend(vectors: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, size: int, cost: float = 1.0,
            rounds: int = 30, seed: int = 1) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: weights and bias. Rows are visited in a new order each round."""
    weights, bias = np.zeros(size), 0.0
    dual = np.zeros(len(vectors))
    norms = np.array([v @ v + 1.0 for _, v in vectors])
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(vectors)):
            at, value = vectors[i]
            slack = signs[i] * (weights[at] @ value + bias) - 1
            new = min(max(dual[i] - slack / norms[i], 0.0), cost)
            step = (new - dual[i]) * signs[i]
            if step:
                weights[at] += step * value
                bias += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-4:
            break
    return weights, bias


def logistic(margins: np.ndarray, classes: np.ndarray, shares: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps; targets are drawn in a little, classes weighted to ``shares``."""
    n = np.bincount(classes, minlength=2)
    target = np.where(classes == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    weight = (shares / np.maximum(n, 1))[classes] * len(classes)
    inputs = np.column_stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(inputs @ at, -40, 40)))
        slope = inputs.T @ (weight * (p - target)) + 1e-3 * at
        curve = (inputs * (weight * p * (1 - p))[:, None]).T @ inputs + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fifth of the rows that is never learned from; a null id is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class with each feature, and documents of each class, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SIZE + 1), np.int64)
        for rows, data, offsets in slices(batches, "text", _SLICE):
            classes = rows.column("class").to_numpy(zero_copy_only=False)
            owner, found = features(data, offsets)
            counts[:, SIZE] += np.bincount(classes, minlength=2)
            for c in (0, 1):
                counts[c, :SIZE] += np.bincount(found[classes[owner] == c], minlength=SIZE)
        some = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])],
                                         names=["feature", "n0", "n1"])

    partial = map_arrow(labelled.select("class", "text"), run, "feature bigint, n0 bigint, n1 bigint")
    total = partial.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()  # SIZE + 1 rows at most
    counts = np.zeros((2, SIZE + 1), np.int64)
    counts[:, total["feature"].to_numpy()] = total[["n0", "n1"]].to_numpy().T
    return counts[:, :SIZE], counts[:, SIZE]


def _sample(labelled: DataFrame, labels: DataFrame, fit_rows: int) -> list[tuple[int, np.ndarray]]:
    """Class and features of the sampled rows, ordered by hash."""
    order = F.xxhash64("label_id")
    chosen = [labels.where(F.col("class") == c).select("label_id", order.alias("turn")).orderBy("turn", "label_id").limit(
        fit_rows // 2) for c in (0, 1)]
    ids = chosen[0].unionByName(chosen[1]).groupBy("label_id").agg(F.min("turn").alias("turn")).withColumnRenamed("label_id", "of")
    picked = labelled.join(F.broadcast(ids), F.col("label_id") == F.col("of"))  # fit_rows rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text", _SLICE):
            owner, found = features(data, offsets)
            places = np.searchsorted(owner, np.arange(len(offsets)))
            lists = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([rows.column("turn"), rows.column("class"), lists], names=["turn", "class", "found"])

    made = map_arrow(picked.select("turn", "class", "text"), run, "turn bigint, class int, found array<int>").toArrow()
    rows = zip(made.column("turn").to_pylist(), made.column("class").to_pylist(),
               (x.values.to_numpy(zero_copy_only=False) for x in made.column("found")), strict=True)
    return [(c, f) for _, c, f in sorted(rows, key=lambda r: (r[0], r[1]))]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        fit_rows: int = 8000, broadcast_bytes: int = BROADCAST_LABELS) -> Model:
    """Learn from the labelled rows that are not held out. ``fit_rows`` bounds what the descent sees.

    Labels of up to ``broadcast_bytes`` go to all tasks, more are joined by a shuffle.
    """
    known = labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("class"))
    size = known.agg(F.sum(F.octet_length(F.col("label_id").cast("string")) + 32)).first()[0] or 0
    side = F.broadcast(known) if size <= broadcast_bytes else known
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    labelled = texts.join(side, F.col("id") == F.col("label_id"))
    counts, totals = _class_counts(labelled)
    zero = np.zeros(SIZE)
    if not totals.all():
        share = (totals[1] / totals.sum()) if totals.sum() else 0.5
        return Model(zero, zero, 0.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    ratios = log_ratios(counts, totals)
    rows = _sample(labelled, known, fit_rows)
    classes = np.array([c for c, _ in rows])
    vectors = []
    for _, found in rows:
        values = ratios[found]
        length = np.sqrt(values @ values)
        vectors.append((found, values / length if length else values))
    fitted = np.arange(len(rows)) % 5 != 0  # the rest fits the curve
    weights, bias = descend([v for v, f in zip(vectors, fitted, strict=True) if f], 2.0 * classes[fitted] - 1, SIZE)
    margins = np.array([weights[at] @ value + bias for at, value in vectors])
    rest = ~fitted if len(set(classes[~fitted].tolist())) == 2 else np.ones(len(rows), bool)
    slope, shift = logistic(margins[rest], classes[rest], totals / totals.sum())
    return Model(weights, ratios, bias, slope, shift)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` of every row."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text", _SLICE):
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(model.scores(data, offsets))], names=["id", "score"])

    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold."""
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = batch.rename_columns([f"column_{i}" for i in range(batch.num_columns)])
            for rows, data, offsets in slices([plain], f"column_{at}", _SLICE):
                kept = rows.filter(pa.array(model.scores(data, offsets) >= threshold))
                yield kept.rename_columns(batch.schema.names)

    return map_arrow(docs, run, schema)
