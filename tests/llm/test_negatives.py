"""Hard negatives against a plain version with Python integers."""

import math
import random

import numpy as np
import pytest
from conftest import clashing, collected
from pyspark.sql import functions as F

from lodeworks.llm import negatives
from lodeworks.llm.queries import op11_hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, n_pos=5, n_neg=10, low=30, high=90, factor=256):
    known = [(i, [math.floor(factor * x) for x in v], label) for i, v, label in rows
             if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor, left, label in known:
        if anchor % 10:
            continue
        scored = sorted((-sum(a * b for a, b in zip(left, v, strict=False)), i, k) for i, v, k in known if i != anchor)
        for minus, positive, _ in [s for s in scored if s[2] == label][:n_pos]:
            fit = [s for s in scored if s[2] != label and low * -minus <= 100 * -s[0] <= high * -minus][:n_neg]
            out += [(anchor, positive, rank, i, -minus, -m) for rank, (m, i, _) in enumerate(fit, 1)]
    return sorted(out)


def made(seed, n, side=7, labels=4):
    """Few distinct values, so that many scores tie."""
    rng = random.Random(seed)
    return [(i, [rng.randint(-3, 9) / 8 for _ in range(side)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 64, 5), (33, 17, 41), (64, 64, 64), (70, 9, 100), (0, 4, 3), (5, 0, 3)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    a = rng.integers(-2**40, 2**40, shape[:2])
    b = rng.integers(-2**15, 2**15, shape[1:])
    wanted = a.astype(object) @ b.astype(object) if shape[1] else np.zeros((shape[0], shape[2]), int)
    assert (negatives.strassen(a, b, 4) == wanted).all()


def test_scores_that_may_not_fit_are_an_error():
    with pytest.raises(OverflowError):
        negatives.products(np.full((1, 2), 2**31), np.full((1, 2), 2**31))


@pytest.mark.parametrize("tile_rows", [3, 1000])
def test_mine_equals_plain(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(negatives, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 2 if tile_rows == 3 else 1024)
    monkeypatch.setattr(negatives, "HELD", 1 if tile_rows == 3 else 8)
    rows = made(1, 150)
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(5), ["id", "tile", "rank", "score", "place", "positives", "vector"])
    found = sorted(collected(negatives.mine(df, F.col("vec_id") % 10 == 0)))
    assert found == plain(rows) and len(found) > 200


def test_one_label_with_most_rows_and_other_settings(spark):
    rows = [(i, v, 0 if i % 3 else k) for i, v, k in made(2, 120)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = negatives.mine(df, F.col("vec_id") % 10 == 0, factor=8.0, positives=2, negatives=3, low=-20, high=100)
    assert sorted(collected(found)) == plain(rows, 2, 3, -20, 100, 8)


def test_rows_that_take_no_part(spark):
    fine = made(3, 60)
    bad = [(None, [1.0] * 7, 0), (100, None, 0), (110, [1.0] * 7, None), (120, [1.0, None, 1.0], 1),
           (130, [float("nan")] * 7, 1), (131, [float("inf")] + [0.0] * 6, 2)]
    df = spark.createDataFrame(fine + bad, SCHEMA)
    assert sorted(collected(negatives.mine(df, F.col("vec_id") % 10 == 0))) == plain(fine)


def test_uneven_lengths_count_as_padded(spark):
    rows = made(4, 40) + [(i, v[:i % 7], k) for i, v, k in [(i + 40, v, k) for i, v, k in made(5, 40)]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(collected(negatives.mine(df, F.col("vec_id") % 10 == 0))) == plain(rows)


def test_repeated_rows_each_count(spark):
    rows = made(6, 60)
    rows += [rows[10], rows[11], rows[11]]
    assert sorted(collected(negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0))) == plain(rows)


def test_no_rows_and_no_anchors(spark):
    df = spark.createDataFrame(made(7, 9), SCHEMA)
    assert collected(negatives.mine(df, F.col("vec_id") < 0)) == []
    assert collected(negatives.mine(df.where("vec_id < 0"), F.col("vec_id") % 10 == 0)) == []


def test_wide_components(spark):
    rows = [(i, [float(2**20 * (i % 5 - 2)), 1.0, float(i)], i % 2) for i in range(40)]
    assert sorted(collected(negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0))) == plain(rows)


def test_query_has_all_anchors(spark, sf_dir):
    found = op11_hard_negatives(spark, sf_dir)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    anchors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id % 100 = 0").count()
    assert found.select("anchor_id").distinct().count() <= anchors and found.where("rank > 10 or anchor_id = negative_id").isEmpty()
