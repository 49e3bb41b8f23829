"""The most frequent keys, exactly, without shuffling the keys that cannot win.

Each task keeps a space-saving summary: at most ``capacity`` keys with counts, and the
largest count it let go. A key's true count in the task lies between its kept count and
that plus the loss. Summed over tasks, the k-th largest lower bound is a count that the
winners must reach; keys whose upper bound is less are out, also those that no summary
kept, if the whole loss is less. What remains is counted exactly in a second pass. If
the loss is too large to tell, all keys are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.counts import count_by, top_k
from lodeworks.sources.scratch import materialize

CAPACITY = 10_000  # keys that a task keeps
MAX_CANDIDATES = 100_000  # keys that are sent to all tasks


def summaries(df: DataFrame, key: str, capacity: int = CAPACITY) -> DataFrame:
    """``key, low, loss``: kept counts of each task's keys, and one row with a null key for the task's loss. Null keys are left out."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, loss = None, 0
        for batch in batches:
            counted = pc.value_counts(batch.column(0).drop_null())
            own = pa.table({"key": counted.field("values"), "low": counted.field("counts")})
            kept = own if kept is None else pa.concat_tables([kept, own]).group_by("key").aggregate([("low", "sum")]).rename_columns(
                {"low_sum": "low"}).select(["key", "low"])
            if len(kept) > capacity:
                kept = kept.sort_by([("low", "descending")])
                # What a key loses here adds to what it, or the key that took its place, lost before.
                loss += kept.column("low")[capacity].as_py()
                kept = kept.slice(0, capacity)
        if kept is not None:
            whole = kept.append_column("loss", pa.array([0] * len(kept), pa.int64())).combine_chunks()
            yield from whole.to_batches()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kept.schema.field("key").type), pa.array([0], pa.int64()),
                                              pa.array([loss], pa.int64())], names=["key", "low", "loss"])

    return df.select(key).mapInArrow(run, f"key {kind}, low bigint, loss bigint")


def candidates(kept: DataFrame, k: int) -> DataFrame | None:
    """Keys that may be among the ``k`` most frequent, or None if keys that no summary kept may be."""
    loss = kept.agg(F.sum("loss")).first()[0] or 0
    low = kept.where("key is not null").groupBy("key").agg(F.sum("low").alias("low"))
    best = low.orderBy(F.desc("low")).limit(k).agg(F.count("*"), F.min("low")).first()
    if loss and (best[0] < k or best[1] <= loss):
        return None
    if best[0] < k:
        return low.select("key")
    return low.where(F.col("low") + loss >= best[1]).select("key")


def top_keys(df: DataFrame, key: str, k: int, capacity: int = CAPACITY) -> DataFrame:
    """``key, n`` of the ``k`` most frequent values; ties in their order."""
    kept = materialize(summaries(df, key, capacity), "summaries")
    wanted = candidates(kept, k)
    if wanted is None or wanted.limit(MAX_CANDIDATES + 1).count() > MAX_CANDIDATES:
        return top_k(count_by(df.where(F.col(key).isNotNull()), key), k, key)
    few = materialize(wanted, "candidates")
    return top_k(count_by(df.join(F.broadcast(few), df[key] == few["key"], "left_semi"), key), k, key)
