"""The items with the highest inner products per user, exactly and without all pairs.

Items come in blocks from the longest factors to the shortest. By Cauchy and Schwarz no
item of a block can score more than the user's norm times the block's largest norm, so a
user whose n-th best score is above that is done with this block and all that follow.
Each round broadcasts one block, of a bounded number of factors, to the users that are
still open; those that are done leave, and the rounds end when no user is open. Within a
round, a task skips parts of a block in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.indexing import dense_index
from lodeworks.sources.scratch import materialize
from lodeworks.sources.workers import importable

BLOCK_VALUES = 4_000_000  # numbers in a block of item factors
PART = 256  # items that a task scores at a time
SLACK = 1 + 1e-9  # a bound counts as this much larger, for rounding


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _best(scores: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's ``n`` highest scores, ties by the smaller place."""
    order = np.lexsort((places, -scores), axis=1)[:, :n]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(places, order, 1)


def _round(norms: np.ndarray, factors: np.ndarray, places: np.ndarray, users: np.ndarray, scores: np.ndarray, found: np.ndarray,
           n: int, part: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One block against a batch of users: their heaps after it, and how many pairs were scored."""
    lengths, scored = np.sqrt((users**2).sum(axis=1)) * SLACK, 0
    for start in range(0, len(factors), part):
        open_ = np.flatnonzero(lengths * norms[start] >= scores[:, -1])
        if not len(open_):
            break
        some = slice(start, start + part)
        own = users[open_] @ factors[some].T
        scored += own.size
        scores[open_], found[open_] = _best(np.concatenate([scores[open_], own], axis=1), np.concatenate(
            [found[open_], np.broadcast_to(places[some], own.shape)], axis=1), n)
    return scores, found, scored


def top_items(users: DataFrame, items: DataFrame, n: int, user: str = "user", item: str = "item", factors: str = "f",
              block_values: int = BLOCK_VALUES, part: int = PART) -> tuple[DataFrame, DataFrame]:
    """``user, rank, item, score``, and one row ``n_pairs, n_scored`` of the work done.

    ``users`` and ``items`` have an id and an array of factors of one length each. Ties go by the smaller item.
    Users or items with a null id or factors take no part. Repeated items each count.
    """
    spark = users.sparkSession
    importable(spark)
    fine = [df.where(F.col(c).isNotNull() & F.col(factors).isNotNull()).select(
        F.col(c).alias("id"), F.transform(factors, lambda x: x.cast("double")).alias("f")) for df, c in ((users, user), (items, item))]
    norm = F.sqrt(F.aggregate("f", F.lit(0.0), lambda a, x: a + x * x))
    # Numbers in the order of the id: a tie between scores is a tie between numbers.
    numbered = dense_index(fine[1], ["id"], "place")
    ranked = materialize(dense_index(numbered.withColumn("norm", norm), [F.desc("norm"), "place"], "at"), "items")
    n_items, side = ranked.agg(F.count("*"), F.max(F.size("f"))).first()
    size = max(part, block_values // max(1, side or 1))
    kind = fine[0].schema["id"].dataType.simpleString()
    schema = f"id {kind}, f array<double>, scores array<double>, places array<bigint>, scored bigint, open boolean"
    state = materialize(fine[0].withColumns({
        "scores": F.array_repeat(F.lit(float("-inf")), n), "places": F.array_repeat(F.lit((1 << 62)), n),
        "scored": F.lit(0).cast("bigint"), "open": F.lit(True)}), "users")
    done = [state.where(F.lit(n_items == 0))]
    for first in range(0, n_items, size):
        block = ranked.where((F.col("at") >= first) & (F.col("at") < first + size + 1)).orderBy("at").select("norm", "f", "place").toArrow()
        matrix = _matrix(block.column("f").combine_chunks())
        norms, places = (block.column(c).to_numpy() for c in ("norm", "place"))
        beyond = float(norms[size]) if len(norms) > size else -1.0  # the longest of what follows
        held = spark.sparkContext.broadcast((norms[:size], matrix[:size], places[:size], beyond))

        def scored(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                norms, matrix, places, beyond = held.value
                own, scores = _matrix(batch.column("f")), _matrix(batch.column("scores")).copy()
                found = batch.column("places").flatten().to_numpy().reshape(len(own), -1).copy()
                scores, found, work = _round(norms, matrix, places, own, scores, found, n, part)
                still = (np.sqrt((own**2).sum(axis=1)) * SLACK * beyond >= scores[:, -1]) & (beyond >= 0)
                more = batch.column("scored").to_numpy().copy()
                more[0] += work
                lists = pa.array(np.arange(0, n * len(own) + 1, n, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"), batch.column("f"), pa.ListArray.from_arrays(lists, pa.array(scores.ravel())),
                    pa.ListArray.from_arrays(lists, pa.array(found.ravel())), pa.array(more), pa.array(still)], names=batch.schema.names)

        after = materialize(state.mapInArrow(scored, schema), "users")
        held.destroy()
        done.append(after.where("not open"))
        state = after.where("open")
        if state.isEmpty():
            break
    every = reduce(DataFrame.unionByName, done)
    work = every.agg(F.count("*") * F.lit(n_items), F.sum("scored")).toDF("n_pairs", "n_scored")
    listed = every.select("id", F.posexplode(F.arrays_zip("scores", "places")).alias("rank", "_x")).where(
        F.col("_x.places") < (1 << 62)).select("id", (F.col("rank") + 1).alias("rank"), F.col("_x.scores").alias("score"),
                                               F.col("_x.places").alias("_at"))
    named = listed.join(ranked.select(F.col("place").alias("_at"), F.col("id").alias("_item")), "_at")
    return named.select(F.col("id").alias(user), "rank", F.col("_item").alias(item), "score"), work
