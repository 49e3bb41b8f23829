"""Frequent item sets over baskets (rows with an array of items).

Work is laid out in levels. The raw baskets are read once, into the distinct
item sets with their multiplicity: when a third of all baskets are copies of one
another they become one weighted row, merged on the map side. Each level then
counts sets of one size in a single job with map-side partial counts, instead of
one job per candidate.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.reshape import explode_items
from lodeworks.sources.scratch import materialize

MAX_INLINE_ITEMS = 5_000  # frequent items up to this many become a literal list
MAX_BROADCAST_BYTES = 64 << 20  # tables of following items up to this size are sent to all tasks
SALTS = 16  # places over which a common beginning is dealt when that table is shuffled
BLOCK = 256  # anchors per row when a long basket is cut into balanced pieces
LONG_PER_TASK = 1_000  # long baskets whose blocks at one place share a task


def weigh_baskets(baskets: DataFrame, items: str) -> DataFrame:
    """Distinct item sets ``items`` (sorted, no repeats) and how many baskets hold each, ``w``."""
    sets = baskets.select(F.array_sort(F.array_distinct(F.col(items))).alias("items"))
    return materialize(sets.groupBy("items").agg(F.count(F.lit(1)).alias("w")), "baskets")


def share_threshold(weighted: DataFrame, num: int, den: int) -> int:
    """Largest count that is not yet above ``num/den`` of the baskets."""
    return int(weighted.agg(F.sum("w")).first()[0] or 0) * num // den


def item_counts(weighted: DataFrame) -> DataFrame:
    return explode_items(weighted, "items", keep=["w"]).groupBy("item").agg(F.sum("w").alias("n"))


def frequent_items(weighted: DataFrame, min_exclusive: int) -> DataFrame:
    """``item, n`` of items in more than ``min_exclusive`` baskets."""
    return item_counts(weighted).where(F.col("n") > min_exclusive)


def frequent_pairs(weighted: DataFrame, min_exclusive: int) -> DataFrame:
    """``item_1, item_2, n`` with ``item_1 < item_2``."""
    return _pairs(_anchored(_only_frequent(weighted, min_exclusive)), min_exclusive)


def frequent_triples(weighted: DataFrame, min_exclusive: int) -> DataFrame:
    """``item_1, item_2, item_3, n`` in item order."""
    return _levels(weighted, min_exclusive, 3)[3]


def frequent_sets(weighted: DataFrame, min_exclusive: int, max_size: int = 3) -> DataFrame:
    """All frequent sets of 2 to ``max_size`` items as ``items`` (array), ``size``, ``n``."""
    levels = _levels(weighted, min_exclusive, max_size)
    result = _as_sets(levels[2], 2)
    for size in range(3, max_size + 1):
        result = result.unionByName(_as_sets(levels[size], size))
    return result


def _levels(weighted: DataFrame, min_exclusive: int, max_size: int) -> dict[int, DataFrame]:
    """The stored frequent sets ``item_1.., n`` of each size; a size grows from the one before."""
    anchored = _anchored(_only_frequent(weighted, min_exclusive))
    levels = {2: materialize(_pairs(anchored, min_exclusive), "sets")}
    first = anchored.select("w", "tail", F.posexplode("anchors").alias("_at", "item_1"))
    state = first.select("w", "item_1", _after("tail", F.col("_at")).alias("_open")).where(F.size("_open") > 1)
    for size in range(3, max_size + 1):
        state = _extend(state, levels[size - 1], size)
        items = [f"item_{i + 1}" for i in range(size)]
        grown = state.select("w", *items[:-1], F.explode("_open").alias(items[-1]))
        found = grown.groupBy(*items).agg(F.sum("w").alias("n")).where(F.col("n") > min_exclusive)
        levels[size] = materialize(found, "sets")
        state = state.where(F.size("_open") > 1)
    return levels


def _after(arr: str, at: Column) -> Column:
    """The elements of ``arr`` behind the 0-based place ``at``."""
    return F.slice(arr, at + 2, F.size(arr))


def _extend(state: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """Sets of ``size - 1`` items inside baskets, with the later items that may follow, stored.

    ``state`` has the sets one item shorter (``w, item_1.., _open``); ``sets`` are the
    frequent ones of ``size - 1``. A frequent set has all its parts frequent, so only
    items that make a frequent set with the same beginning stay open. The table of
    these items is broadcast when it is measured and small enough. Otherwise it is
    shuffled, and copied to ``SALTS`` places so that a beginning which a third of all
    baskets share is dealt over as many tasks; the count then shuffles on the whole set.
    """
    *prefix, last = [f"item_{i + 1}" for i in range(size - 1)]
    following = sets.groupBy(*[F.col(c).alias(f"_{c}") for c in prefix]).agg(F.collect_list(last).alias("_next"))
    following = materialize(following, "following")
    text = following.agg(F.sum(F.aggregate("_next", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x) + 16))).first()[0]
    same = reduce(and_, [F.col(c) == F.col(f"_{c}") for c in prefix])
    if (text or 0) <= MAX_BROADCAST_BYTES:
        joined = state.join(F.broadcast(following), same)
    else:
        copies = following.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = state.withColumn("_salt", F.pmod(F.xxhash64("_open"), F.lit(SALTS)).cast("int"))
        joined = dealt.join(copies, same & (F.col("_salt") == F.col("_copy")))
    open_items = joined.select("w", *prefix, F.array_intersect("_open", "_next").alias("_left")).where(F.size("_left") > 1)
    steps = open_items.select("w", *prefix, "_left", F.posexplode("_left").alias("_at", last))
    return materialize(steps.select("w", *prefix, last, _after("_left", F.col("_at")).alias("_open")).where(
        F.size("_open") > 0), "state")


def itemsets(baskets: DataFrame, items: str, min_exclusive: int, max_size: int | None = None) -> DataFrame:
    """Frequent sets of any size by FP-growth, ``items`` (sorted array), ``size``, ``n``.

    FP-growth keeps counts of at least ``ceil(support * N)``; half a count above
    the bound makes that exactly "more than ``min_exclusive``", safe from float
    rounding. It mines all sizes, so with a ``max_size`` the sets are grown level by
    level instead (``frequent_sets``), with the same rows.
    """
    if max_size is not None:
        weighted = weigh_baskets(baskets, items)
        single = frequent_items(weighted, min_exclusive).withColumnRenamed("item", "item_1")
        found = _as_sets(single, 1)
        return found.unionByName(frequent_sets(weighted, min_exclusive, max_size)) if max_size > 1 else found
    sets = materialize(baskets.select(F.array_distinct(F.col(items)).alias("items")), "sets")
    total = sets.count()
    if total <= min_exclusive:
        return _fp_result(sets.withColumn("freq", F.lit(0).cast("bigint")).limit(0))
    model = FPGrowth(itemsCol="items", minSupport=(min_exclusive + 0.5) / total).fit(sets)
    return _fp_result(model.freqItemsets)


def _fp_result(found: DataFrame) -> DataFrame:
    return found.select(
        F.array_sort("items").alias("items"),
        F.size("items").alias("size"),
        F.col("freq").alias("n"),
    )


def _only_frequent(weighted: DataFrame, min_exclusive: int) -> DataFrame:
    """Baskets cut down to their frequent items, at least two, merged again."""
    weighted = weighted.where(F.size("items") > 1)
    singles = materialize(frequent_items(weighted, min_exclusive), "singles")
    # The bound is checked before anything comes to the driver.
    if singles.count() <= MAX_INLINE_ITEMS:
        names = [row["item"] for row in singles.select("item").collect()]
        cut = weighted.select(
            F.filter("items", lambda x: x.isin(names) if names else F.lit(False)).alias("items"), "w"
        )
    else:
        # A set is its own key: the digest of its JSON names it, whatever the items contain.
        keyed = weighted.withColumn("_set", F.sha2(F.to_json("items"), 256))
        kept = keyed.select("_set", "w", F.explode("items").alias("item")).join(
            singles.select("item"), "item", "left_semi"
        )
        cut = kept.groupBy("_set", "w").agg(F.array_sort(F.collect_list("item")).alias("items"))
    merged = cut.where(F.size("items") > 1).groupBy("items").agg(F.sum("w").alias("w"))
    return materialize(merged, "frequent_baskets")


def _anchored(reduced: DataFrame) -> DataFrame:
    """Rows ``w, anchors, tail``: each set starts at an anchor and continues in the tail.

    A short basket is one row and stays where it is. A long one becomes a row per
    block of anchors, so that no task has to expand a whole long basket. Blocks at
    the same place of many baskets meet in a task, where their equal pairs are
    merged before they are shuffled; a salt splits places with many baskets.
    """
    length = F.size("items")
    whole = F.col("items").alias("anchors"), F.col("items").alias("tail")
    n_long, longest = reduced.where(length > BLOCK).agg(F.count(F.lit(1)), F.max(length)).first()
    if not n_long:
        return reduced.select("w", *whole)
    tasks = 4 * reduced.sparkSession.sparkContext.defaultParallelism
    blocks = -(-longest // BLOCK)
    salts = min(1 + n_long // LONG_PER_TASK, max(1, tasks // blocks))
    starts = reduced.where(length > BLOCK).select(
        "w", "items", F.explode(F.sequence(F.lit(1), length, F.lit(BLOCK))).alias("_start")
    )
    # The number of partitions is given: a block is few bytes but much work, so
    # merging partitions by their size would undo the spreading.
    long = starts.select(
        "w",
        F.slice("items", F.col("_start"), F.lit(BLOCK)).alias("anchors"),
        F.slice("items", F.col("_start"), length).alias("tail"),
        "_start",
        F.pmod(F.xxhash64("items"), F.lit(salts)).alias("_salt"),
    ).repartition(blocks * salts, "_start", "_salt")
    return reduced.where(length <= BLOCK).select("w", *whole).unionByName(long.drop("_start", "_salt"))


def _pairs(anchored: DataFrame, min_exclusive: int) -> DataFrame:
    # Two streaming generators: a row holds one anchor and the items after it,
    # never the list of all its pairs, and the partial count runs in the task.
    firsts = anchored.select("w", "tail", F.posexplode("anchors").alias("_i", "item_1"))
    pairs = firsts.select("w", "item_1", F.explode(_after("tail", F.col("_i"))).alias("item_2"))
    return (
        pairs.groupBy("item_1", "item_2")
        .agg(F.sum("w").alias("n"))
        .where(F.col("n") > min_exclusive)
    )


def _as_sets(found: DataFrame, size: int) -> DataFrame:
    items = F.array(*[F.col(f"item_{i + 1}") for i in range(size)])
    return found.select(items.alias("items"), F.lit(size).alias("size"), "n")
