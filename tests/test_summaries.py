"""Bitmaps, heavy hitters, sketches, hot-key joins and windows of event time against plain versions."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import rows

from lodeworks.operators import bitmaps, heavy, itemsets, joins, sketches
from lodeworks.sources.scratch import new_path
from lodeworks.streaming import start_window_counts, trend, window_counts


@pytest.mark.parametrize(("n", "places"), [(1, [0]), (9, [8]), (4000, [3, 3999]), (4000, list(range(0, 4000, 3)))])
def test_packed_bitmaps_come_back(n, places):
    width = -(-n // 64) * 8
    back = np.unpackbits(bitmaps._unpacked(bitmaps._packed(np.array(places), n), width))
    assert np.flatnonzero(back).tolist() == places


def plain_sets(baskets, bound, max_size):
    counts = Counter()
    for b in baskets:
        for size in range(2, max_size + 1):
            counts.update(combinations(sorted(set(b or [])), size))
    return sorted((list(k), len(k), n) for k, n in counts.items() if n > bound)


@pytest.mark.parametrize(("block", "round_size"), [(7, 5), (1 << 15, 200_000)])
def test_vertical_sets(spark, monkeypatch, block, round_size):
    monkeypatch.setattr(bitmaps, "BLOCK", block)
    rng = random.Random(4)
    baskets = [rng.sample("abcdefgh", rng.randint(0, 5)) for _ in range(120)] + [["a", "b", "a", "c"]] * 300 + [None, []]
    df = spark.createDataFrame([(b,) for b in baskets], "basket array<string>").repartition(3)
    weighted = itemsets.weigh_baskets(df, "basket")
    found = bitmaps.frequent_sets(weighted, 9, 4, round_size)
    assert sorted((r["items"], r["size"], r["n"]) for r in found.collect()) == plain_sets(baskets, 9, 4)
    assert bitmaps.frequent_sets(weighted, 10_000).count() == 0
    assert bitmaps.frequent_sets(weighted.limit(0), 1).count() == 0


def keys_of(seed, n=6000):
    rng = random.Random(seed)
    return [f"k{min(int(rng.paretovariate(0.9)), 3000)}" for _ in range(n)]


@pytest.mark.parametrize(("capacity", "known"), [(400, True), (3, False), (10_000, True)])
def test_heavy_hitters_and_their_bound(spark, capacity, known):
    keys = keys_of(1)
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)] * 50, "key string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")  # several batches a task
    try:
        kept = heavy.summaries(df, "key", capacity).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    true, loss, low = Counter(keys), sum(r["loss"] for r in kept), Counter()
    for r in kept:
        if r["key"] is not None:
            low[r["key"]] += r["low"]
    assert all(low[k] <= n <= low[k] + loss for k, n in true.items())
    again = spark.createDataFrame([tuple(r) for r in kept], "key string, low bigint, loss bigint")
    wanted = heavy.candidates(again, 10)
    assert (wanted is not None) == known
    best = sorted(true.items(), key=lambda x: (-x[1], x[0]))
    if known:
        assert {k for k, n in best if n >= best[9][1]} <= {r["key"] for r in wanted.collect()}
    for k in (1, 10, 5000):
        assert [tuple(r) for r in heavy.top_keys(df, "key", k, capacity).collect()] == best[:k]


def test_heavy_hitters_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "key string")
    assert heavy.top_keys(df, "key", 3).count() == heavy.top_keys(df.limit(0), "key", 3).count() == 0


def test_sketches_unite(spark):
    rng = random.Random(2)
    events = [(f"2024-01-{1 + i % 9:02d} 12:00:00", rng.randrange(4000) if i % 50 else None) for i in range(9000)] + [(None, 7)]
    df = spark.createDataFrame(events, "t string, user int").select(F.col("t").cast("timestamp").alias("t"), "user").repartition(5)
    stored = sketches.daily(df, "t", "user")
    exact = sketches.exact_since(df, "t", "user")
    want = [(d, len({u for t, u in events if t and u is not None and t[:10] >= d})) for d in sorted({t[:10] for t, _ in events if t})]
    assert rows(exact.select(F.col("day").cast("string"), "n")) == want
    both = exact.join(sketches.since(stored), "day")
    assert both.count() == 9 and both.where(~sketches.within_bound(F.col("estimate"), F.col("n"))).isEmpty()
    some = len({u for t, u in events if t and u is not None and "2024-01-03" <= t[:10] <= "2024-01-05"})
    assert abs(sketches.between(stored, "2024-01-03", "2024-01-05").first()[0] - some) <= 0.065 * some
    assert sketches.between(stored, "2030-01-01", "2030-01-02").first()[0] == 0


@pytest.mark.parametrize("bound", [64 << 20, 0])
def test_hot_keys_are_joined_apart(spark, bound):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("k"), "id")
    right = spark.range(380).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([(7, -1), (None, 0)], "k bigint, v bigint"))
    found = joins.skew_join(left, right, "k", share=0.1, fraction=1.0, max_bytes=bound)
    assert joins.hot_keys(left, "k", 0.1, 1.0) == [7]
    assert rows(found) == rows(left.join(right, "k"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) or bound == 0


def tweets(spark, path, name, lines):
    df = spark.createDataFrame(lines, "ts string, text string").select(F.col("ts").cast("timestamp").alias("ts"), "text")
    df.coalesce(1).write.parquet(f"{path}/{name}")


def test_windows_late_rows_and_a_restart(spark):
    source, out, state = (new_path(spark, n) for n in ("tweets", "windows", "state"))

    def run():
        stream = spark.readStream.schema("ts timestamp, text string").option("recursiveFileLookup", "true").parquet(source)
        start_window_counts(stream, "#", out, state, window="1 day", late="6 hours").awaitTermination()
        return sorted((str(r["start"]), r["token"], r["n"]) for r in window_counts(spark.read.parquet(out)).collect())

    tweets(spark, source, "a", [("2024-01-01 10:00:00", "#x #y z"), ("2024-01-01 23:00:00", "#x"), (None, "#x"), ("2024-01-02 01:00:00", "#y")])
    one = [("2024-01-01 00:00:00", "#x", 2), ("2024-01-01 00:00:00", "#y", 1), ("2024-01-02 00:00:00", "#y", 1)]
    assert run() == one
    # Late, but within six hours of what came before: counted. The latest time moves on.
    tweets(spark, source, "b", [("2024-01-01 22:00:00", "#x"), ("2024-01-03 12:00:00", "#z")])
    two = sorted([("2024-01-01 00:00:00", "#x", 3), *one[1:], ("2024-01-03 00:00:00", "#z", 1)])
    assert run() == two  # started again from its checkpoint
    # The first day has ended six hours ago and more: its late row is dropped, that of the third day is not.
    tweets(spark, source, "c", [("2024-01-01 09:00:00", "#x"), ("2024-01-03 09:00:00", "#z")])
    assert run() == [*two[:-1], ("2024-01-03 00:00:00", "#z", 2)] and run() == [*two[:-1], ("2024-01-03 00:00:00", "#z", 2)]
    found = trend(window_counts(spark.read.parquet(out)), "2024-01-02 00:00:00", 2)
    assert rows(found) == [("#x", 3, 0, 3)]
