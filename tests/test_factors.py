"""Alternating least squares, top items and Lloyd rounds against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import rows

from lodeworks.operators import factors, lloyd, topn


def rated(n=400, seed=1):
    rng = np.random.default_rng(seed)
    # a third of all ratings is one item's
    return [(int(rng.integers(0, 40)), int(rng.integers(0, 25)) if i % 3 else 7, float(rng.integers(1, 6))) for i in range(n)]


SCHEMA = "UserID int, ItemID int, Rating double"


def plain_als(ratings, start, rank, reg, iters):
    users, items = dict(start), {}
    for _ in range(iters):
        for known, found, a, b in ((users, items, 0, 1), (items, users, 1, 0)):
            for i in {r[b] for r in ratings}:
                mine = [(np.array(known[r[a]]), r[2]) for r in ratings if r[b] == i]
                gram = sum(np.outer(f, f) for f, _ in mine) + reg * len(mine) * np.eye(rank)
                found[i] = np.linalg.solve(gram, sum(f * x for f, x in mine))
    return users, items


@pytest.mark.parametrize(("held", "split", "rows"), [(1 << 24, 4, 1 << 22), (200, 4, 1 << 22), (1 << 24, 1e-9, 40)])
def test_grid_equals_numpy(spark, monkeypatch, held, split, rows):
    monkeypatch.setattr(factors, "HELD", held)  # many blocks, ids that are split or none, and few rows at a time
    monkeypatch.setattr(factors, "SPLIT", split)
    monkeypatch.setattr(factors, "ROWS", rows)
    ratings = rated()
    df = spark.createDataFrame([*ratings, (None, 1, 2.0), (1, None, 2.0), (1, 1, None), (1, 1, float("nan"))], SCHEMA).repartition(4)
    held_out = rated(60, 2) + [(999, 1, 3.0), (1, 999, 3.0)]
    layout = factors.Layout(((2, 0.1), (2, 0.5), (3, 0.1), (3, 0.5)))
    seen = {r[0] for r in ratings}, {r[1] for r in ratings}
    used = [r for r in held_out if r[0] in seen[0] and r[1] in seen[1]]
    grid = factors.tune(df, spark.createDataFrame(held_out, SCHEMA), ranks=[2, 3], regs=[0.1, 0.5], iterations=[1, 2], seed=5)
    got = {(r.rank, r.reg, r.iters): r.val_rmse for r in grid.collect()}
    assert len(got) == 8
    start = {r.user: r.f for r in factors.start(factors.usable(df, "UserID", "ItemID", "Rating"), "user", layout, 5).collect()}
    for rank, reg, where in layout.places():
        for iters in (1, 2):
            users, items = plain_als(ratings, {u: f[where] for u, f in start.items()}, rank, reg, iters)
            want = np.sqrt(np.mean([(users[u] @ items[i] - x) ** 2 for u, i, x in used]))
            assert got[rank, reg, iters] == pytest.approx(want, rel=1e-9)


def test_fit_and_best(spark):
    df = spark.createDataFrame(rated(), SCHEMA)
    marked = factors.tune(df, df, df, ranks=[2], regs=[0.1, 1.0], iterations=[3]).collect()
    best = [r for r in marked if r.is_best]
    assert len(best) == 1 and best[0].test_rmse == pytest.approx(best[0].val_rmse) and sum(r.test_rmse is None for r in marked) == 1
    users, items = factors.fit(df, 2, 0.1, 3)
    assert users.count() == df.select("UserID").distinct().count() and items.where(F.size("f") != 2).isEmpty()
    with pytest.raises(ValueError):
        factors.fit(df, 2, 0.0)


def test_half_steps_are_one_shuffle_each_and_need_no_join(spark, monkeypatch):
    """A step once joined factors to ratings, and was stored and read again; grids of 40 steps ran out of time."""
    monkeypatch.setattr(factors, "SPLIT", 1e-9)
    layout = factors.Layout(((2, 0.1),))
    df = spark.createDataFrame([(f"u{u}", i, x) for u, i, x in rated()], "user string, item int, rating double")
    sides = factors.dealt(df, layout)
    sent = factors.first_sent(sides[0], layout, 5)
    for side in (sides[1], sides[0]) * 2:
        sent, none = factors.half_step(side, sent, layout, keep=False)
        assert none is None
    plan = sent._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange ") == 4 and "Join" not in plan
    # what the blocks are sent last are the factors of the users
    found = factors.run(df, layout, [2], 5)
    _, users, _ = next(found)
    want = {tuple(r.f) for r in users.collect()}
    got = {tuple(f) for r in sent.collect() for f in np.frombuffer(r.f).reshape(-1, 2).round(9).tolist()}
    assert got == {tuple(np.round(f, 9).tolist()) for f in want}


def test_few_ids_are_solved_from_sums(spark, monkeypatch):
    """Each user's factors once went to nearly as many blocks as the user had ratings; grids of 1 GB ran out of disk."""
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(f"u{rng.integers(0, 600)}", int(rng.integers(0, 6)), float(rng.integers(1, 6))) for _ in range(3000)],
                               "UserID string, ItemID int, Rating double")
    layout = factors.Layout(((2, 0.1), (3, 0.5)))
    settings = {"ranks": [2, 3], "regs": [0.1, 0.5], "iterations": [1, 2], "seed": 5}
    few = df.where("ItemID = 1 and UserID < 'u2'")
    want = [tuple(r) for r in factors.tune(df, few, few, **settings).collect()]
    monkeypatch.setattr(factors, "LARGE", 500)
    stored = factors.usable(df, "UserID", "ItemID", "Rating")
    by_user, by_item = factors.dealt(stored, layout)
    assert by_item.large and by_item.phases > 1 and by_item.n_blocks == by_user.n_blocks
    sent = factors.first_sent(by_user, layout, 5)
    # the factors of a user are sent once
    assert sum(len(r.f) for r in sent.collect()) == 8 * layout.width * df.select("UserID").distinct().count()
    got = [tuple(r) for r in factors.tune(df, few, few, **settings).collect()]
    assert [r[:3] for r in got] == [r[:3] for r in want] and [r[4] for r in got] == [r[4] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-9)
    assert [r[5] for r in got] == [x if x is None else pytest.approx(x, rel=1e-9) for x in (r[5] for r in want)]


def test_no_ratings(spark):
    df = spark.createDataFrame(rated(), SCHEMA)
    assert [r.val_rmse for r in factors.tune(df.limit(0), df, ranks=[2], regs=[0.1], iterations=[1]).collect()] == [None]
    assert factors.tune(df, df.limit(0), ranks=[2], regs=[0.1], iterations=[1]).first().val_rmse is None


@pytest.mark.parametrize("block", [8, 4_000_000])
def test_top_items_equal_all_pairs(spark, block):
    rng = np.random.default_rng(3)
    users = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(30)] + [(None, [1.0] * 4), (77, None)]
    items = [(i * 3, [float(x) / (1 + i % 7) ** 2 for x in rng.integers(-3, 4, 4)]) for i in range(60)] + [(None, [9.0] * 4)]
    frames = [spark.createDataFrame(x, f"{c} int, f array<double>").repartition(3) for x, c in ((users, "user"), (items, "item"))]
    found, work = topn.top_items(*frames, 4, block_values=block, part=5)
    want = []
    for u, f in users[:30]:
        scored = sorted((-sum(a * b for a, b in zip(f, g)), i) for i, g in items[:60])[:4]
        want += [(u, rank, i, pytest.approx(-s, abs=1e-9)) for rank, (s, i) in enumerate(scored, 1)]
    assert sorted(tuple(r) for r in found.collect()) == want
    n_pairs, n_scored = work.first()
    assert n_pairs == 1800 and n_scored < 1800


def test_top_items_of_few_or_none(spark):
    users = spark.createDataFrame([(1, [1.0]), (2, [0.0])], "user int, f array<double>")
    items = spark.createDataFrame([(5, [2.0]), (4, [2.0])], "item int, f array<double>")
    assert rows(topn.top_items(users, items, 3)[0]) == [(1, 1, 4, 2.0), (1, 2, 5, 2.0), (2, 1, 4, 0.0), (2, 2, 5, 0.0)]
    assert topn.top_items(users, items.limit(0), 3)[0].isEmpty() and topn.top_items(users.limit(0), items, 3)[0].isEmpty()


def plain_lloyd(points, centers, rounds):
    centers = np.array(centers, float)
    for _ in range(rounds):
        used = centers.copy()
        away = np.sqrt(((points[:, None] - centers) ** 2).sum(axis=2))
        own = away.argmin(axis=1)
        for c in np.unique(own):
            centers[c] = points[own == c].mean(axis=0)
    return own, away.min(axis=1), centers, used


@pytest.mark.parametrize("rounds", [1, 2, 6, 40])
def test_rounds_equal_plain_ones(spark, rounds):
    rng = np.random.default_rng(8)
    points = np.concatenate([rng.normal(c, 1.0, (n, 3)) for c, n in ((0, 150), (4, 30), (9, 20))])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, v array<double>").repartition(4)
    start = lloyd.first_rows(df, "id", "v", 6)
    fitted = lloyd.lloyd(df, "v", start, rounds)
    own, away, centers, _ = plain_lloyd(points, start, rounds)
    got = sorted((r.id, r.cluster, r.distance) for r in fitted.assigned.collect())
    assert [c for _, c, _ in got] == own.tolist() and np.allclose([d for *_, d in got], away)
    assert np.allclose([r.center for r in fitted.centers.orderBy("cluster").collect()], centers)
    log = fitted.rounds.orderBy("round").collect()
    assert log[0].n_distances == 200 * 6 and (rounds < 6 or log[-1].n_distances < 600)
    if rounds == 40:
        assert log[-1].moved == 0 and len(log) < 40


def test_rows_without_a_cluster_and_empty_clusters(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, None), (4, [None]), (5, [float("nan")]), (6, [1.0, 2.0]), (7, [0.0])],
                               "id int, v array<double>")
    fitted = lloyd.lloyd(df, "v", np.array([[0.0], [0.0], [9.0]]), 5)
    assert rows(fitted.assigned.select("id", "cluster")) == [(1, 1), (2, 0), (3, None), (4, None), (5, None), (6, None), (7, 1)]
    assert [(r.cluster, r.size, r.center[0]) for r in fitted.centers.orderBy("cluster").collect()] == [
        (0, 1, 1.0), (1, 2, 0.0), (2, 0, 9.0)]  # the second stays at 0 in the first round and wins its rows in the next
    with pytest.raises(ValueError):
        lloyd.lloyd(df, "v", np.zeros((0, 1)))
