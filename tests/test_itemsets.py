import random
from collections import Counter
from itertools import combinations

import pytest

from support import rows
from lodeworks.operators import itemsets


def brute(baskets, size, bound):
    found = Counter()
    for basket in baskets:
        found.update(combinations(sorted(set(basket or [])), size))
    return sorted(((*s, n) for s, n in found.items() if n > bound), key=repr)


def make(seed, n=300, items=14, longest=9):
    rng = random.Random(seed)
    names = [str(rng.randrange(1, 65_536)) for _ in range(items)]
    weights = [1 / (i + 1) for i in range(items)]
    # A third of the baskets are copies of one, some repeat items, some are empty.
    hot = [rng.choices(names, weights, k=longest)] * (n // 3)
    rest = [rng.choices(names, weights, k=rng.randrange(0, longest)) for _ in range(n - len(hot))]
    return hot + rest


@pytest.fixture(params=[1, 2])
def baskets(request):
    return make(request.param)


@pytest.fixture
def weighted(spark, baskets):
    df = spark.createDataFrame([(b,) for b in baskets], "ports array<string>")
    return itemsets.weigh_baskets(df, "ports")


@pytest.mark.parametrize("bound", [0, 12, 60, 10_000])
def test_all_sizes_equal_brute_force(weighted, baskets, bound):
    assert rows(itemsets.frequent_items(weighted, bound)) == brute(baskets, 1, bound)
    assert rows(itemsets.frequent_pairs(weighted, bound)) == brute(baskets, 2, bound)
    assert rows(itemsets.frequent_triples(weighted, bound)) == brute(baskets, 3, bound)


def test_larger_sets(weighted, baskets):
    got = sorted((tuple(r["items"]) + (r["n"],) for r in itemsets.frequent_sets(weighted, 5, max_size=5).collect()), key=repr)
    want = sorted((s for size in (2, 3, 4, 5) for s in brute(baskets, size, 5)), key=repr)
    assert got == want


def test_long_baskets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(itemsets, "BLOCK", 4)
    monkeypatch.setattr(itemsets, "LONG_PER_TASK", 20)
    baskets = make(5, n=60, items=40, longest=30) + [[str(i) for i in range(50)]] * 5
    weighted = itemsets.weigh_baskets(spark.createDataFrame([(b,) for b in baskets], "p array<string>"), "p")
    assert rows(itemsets.frequent_pairs(weighted, 3)) == brute(baskets, 2, 3)
    assert rows(itemsets.frequent_triples(weighted, 4)) == brute(baskets, 3, 4)


def test_many_frequent_items_and_pairs_go_through_joins(spark, baskets, weighted, monkeypatch):
    monkeypatch.setattr(itemsets, "MAX_INLINE_ITEMS", 2)
    monkeypatch.setattr(itemsets, "MAX_BROADCAST_BYTES", 2)
    assert rows(itemsets.frequent_pairs(weighted, 12)) == brute(baskets, 2, 12)
    assert rows(itemsets.frequent_triples(weighted, 12)) == brute(baskets, 3, 12)


def test_fp_growth_agrees_and_repeats_do_not_count(spark, baskets):
    df = spark.createDataFrame([(b,) for b in baskets], "ports array<string>")
    got = {tuple(r["items"]): r["n"] for r in itemsets.itemsets(df, "ports", 12).collect()}
    for size in (1, 2, 3):
        assert sorted(((*k, n) for k, n in got.items() if len(k) == size), key=repr) == brute(baskets, size, 12)
    # support never grows with the set
    assert all(n <= got[sub] for k, n in got.items() if len(k) > 1 for sub in combinations(k, len(k) - 1))


@pytest.mark.parametrize("bound", [2, 3, 4])
def test_exactly_at_the_bound_is_not_frequent(spark, bound):
    df = spark.createDataFrame([(["a", "b", "b"],)] * 3 + [(["a"],)], "p array<string>")
    weighted = itemsets.weigh_baskets(df, "p")
    assert rows(itemsets.frequent_pairs(weighted, bound)) == ([("a", "b", 3)] if bound < 3 else [])
    fp = {tuple(r["items"]): r["n"] for r in itemsets.itemsets(df, "p", bound).collect()}
    assert fp == {k: n for k, n in {("a",): 4, ("b",): 3, ("a", "b"): 3}.items() if n > bound}


def test_share_threshold_is_exact(weighted):
    n = 300
    for num, den in ((27, 1000), (1, 3), (0, 5)):
        bound = itemsets.share_threshold(weighted, num, den)
        assert all((c > bound) == (c * den > num * n) for c in range(n + 1))
