import re

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from __spark_entry__ import queries
from support import rows
from lodeworks.operators import neural, recommend, sampling, trees
from lodeworks.plans import inputs
from lodeworks.sources import materialize, save_model

# --- recommendation ----------------------------------------------------------


@pytest.fixture(scope="module")
def pairs(spark):
    """Ratings with a rank-one structure plus one cold user and item."""
    base = spark.range(30).select(F.col("id").alias("UserID")).join(
        spark.range(20).select(F.col("id").alias("ItemID"))
    )
    rated = base.where((F.col("UserID") + F.col("ItemID")) % 3 > 0).select(
        F.col("UserID").cast("int"), F.col("ItemID").cast("int"),
        ((1 + F.col("UserID") % 5) * (1 + F.col("ItemID") % 4)).cast("double").alias("Rating"),
    )
    return materialize(rated)


def test_als_learns_and_drops_cold_pairs(spark, pairs):
    model = recommend.fit_als(pairs, rank=4, reg=0.01, iters=10)
    predicted = recommend.predict_pairs(model, pairs)
    level = pairs.agg(F.avg("Rating")).first()[0]
    from lodeworks.operators.evaluation import rmse

    error = rmse(predicted, "Rating", "prediction").first()[0]
    spread = rmse(pairs.withColumn("p", F.lit(level)), "Rating", "p").first()[0]
    assert error < spread / 3
    cold = spark.createDataFrame([(999, 1, 3.0), (1, 999, 3.0), (1, 1, 3.0)], "UserID int, ItemID int, Rating double")
    assert [r["UserID"] for r in recommend.predict_pairs(model, cold).collect()] == [1]


def test_same_seed_same_factors(pairs):
    a, b = (recommend.fit_als(pairs, iters=3).userFactors.orderBy("id").collect() for _ in range(2))
    assert a == b


def test_grid_has_a_row_per_setting_and_best_is_refitted(pairs):
    train, validation, test = sampling.split_frames(pairs, ["UserID", "ItemID"], [3, 1, 1], 137)
    grid = recommend.tune_als(train, validation, ranks=[2, 4], regs=[0.01, 0.5], iterations=[5])
    assert grid.count() == 4 and dict(grid.dtypes)["rank"] == "int"
    best = recommend.best_config(grid, train, test).collect()
    chosen = [r for r in best if r["is_best"]]
    assert len(chosen) == 1 and chosen[0]["val_rmse"] == min(r["val_rmse"] for r in best)
    assert chosen[0]["test_rmse"] is not None
    assert all(r["test_rmse"] is None for r in best if not r["is_best"])


def test_recommendations_are_ranked(pairs):
    model = recommend.fit_als(pairs, iters=3)
    got = recommend.recommend(model, 3)
    assert got.count() == 90 and rows(got.select("rank").distinct()) == [(1,), (2,), (3,)]
    few = recommend.recommend(model, 2, pairs.select("UserID").where("UserID < 3").distinct())
    assert few.count() == 6


@pytest.mark.parametrize("offset,dense", [(0, False), (2**31, True)])
def test_ids_beyond_int_are_renumbered(spark, offset, dense):
    df = spark.range(100).select((F.col("id") * 3 + offset).alias("u"))
    got = recommend.with_int_id(df, "u", "i")
    assert dict(got.dtypes)["i"] == "int" and got.select("i").distinct().count() == 100
    assert got.agg(F.max("i")).first()[0] == (99 if dense else 297)


# --- trees -------------------------------------------------------------------


@pytest.fixture(scope="module")
def cells(spark, sf_dir):
    return sampling.split_frames(inputs.biopsies(spark, sf_dir), ["id", "line"], [7, 3], 1234)


FIT = {"label": "class", "numeric": ["clump", "cell_size", "mitoses"], "categorical": ["bare_nuclei"]}


@pytest.fixture(scope="module")
def tree(cells):
    return trees.fit_tree(cells[0], max_depth=4, **FIT)


def test_tree_names_the_predicted_class(cells, tree):
    got = tree.transform(cells[1]).select("class", "label_index", "prediction", "predicted_class").distinct().collect()
    label = {r["label_index"]: str(r["class"]) for r in got}
    assert all(r["predicted_class"] == label[r["prediction"]] for r in got)
    assert any(str(r["class"]) != r["predicted_class"] for r in got)  # not an echo of the answer


def test_unseen_category_is_kept(spark, cells, tree):
    odd = cells[1].limit(5).withColumn("bare_nuclei", F.lit("new"))
    assert tree.transform(odd).count() == 5


def test_depths(cells):
    got = trees.compare_depths(*cells, depths=[2, 4], **FIT).collect()
    assert [r["max_depth"] for r in got] == [2, 4]
    assert all(r["depth"] <= r["max_depth"] and 0 <= r["f1"] <= 1 for r in got)
    assert got[0]["n_nodes"] <= got[1]["n_nodes"]


def test_one_fit_scores_all_depths(cells):
    depths = [0, 1, 2, 3, 5, 7]
    one = trees.score_depths(*cells, depths=depths, **FIT).collect()
    each = trees.compare_depths(*cells, depths=depths, **FIT).collect()
    assert [tuple(r)[:3] for r in one] == [tuple(r)[:3] for r in each]
    assert [r["f1"] for r in one] == pytest.approx([r["f1"] for r in each], rel=1e-12)


def test_rules_reproduce_the_predictions(spark, cells, tree):
    nodes = materialize(trees.tree_nodes(spark, tree))
    assert nodes.count() == trees.tree_of(tree).numNodes
    rules = trees.tree_rules(nodes).collect()
    assert len(rules) == nodes.where("is_leaf").count()
    scored = tree.transform(cells[1])
    total = 0
    for rule in rules:
        test = re.sub(r"\{([^}]*)\}", lambda m: "('" + m[1].replace(", ", "','") + "')", rule["rule"]) or "true"
        hit = scored.where(test)
        assert hit.where(F.col("prediction") != rule["prediction"]).count() == 0
        total += hit.count()
    assert total == scored.count()


def test_categories_go_by_their_names(spark):
    df = spark.range(90).select(
        F.element_at(F.array(F.lit("red"), F.lit("green"), F.lit("blue")), (F.col("id") % 3 + 1).cast("int")).alias("c"),
        F.lit(1.0).alias("x"), F.when(F.col("id") % 3 == 1, "yes").otherwise("no").alias("y"),
    )
    rules = trees.tree_rules(trees.tree_nodes(spark, trees.fit_tree(df, "y", ["x"], ["c"]))).collect()
    assert {r["rule"] for r in rules} <= {f"c{n} in {{{s}}}" for n in ("", " not") for s in ("green", "blue, red", "green, <other>", "blue, red, <other>")}
    assert len(rules) == 2


def test_saved_model_replaces_an_older_one(tree, cells, tmp_path):
    path = str(tmp_path / "model")
    save_model(tree, path)
    save_model(tree, path)
    again = PipelineModel.load(path)
    assert rows(again.transform(cells[1]).select("id", "line", "prediction")) == rows(
        tree.transform(cells[1]).select("id", "line", "prediction")
    )


# --- network -----------------------------------------------------------------


def test_network_learns_and_curve_flags_overfitting(spark):
    df = spark.range(200).select(
        F.array((F.col("id") % 2).cast("float"), (F.col("id") % 10 / 10).cast("float")).alias("v"),
        (F.col("id") % 2).cast("int").alias("y"), "id",
    )
    train, test = sampling.split_frames(neural.vector_input(df, "v", "y", keep=["id"]), ["id"], [4, 1], 1)
    curve = neural.fit_curve(train, test, 2, 2, [[4], [4, 4]], [2, 20]).collect()
    assert [(r["layers"], r["iters"]) for r in curve] == [("4", 2), ("4", 20), ("4-4", 2), ("4-4", 20)]
    assert curve[1]["train_loss"] <= curve[0]["train_loss"]
    assert curve[1]["val_acc"] == 1.0
    assert all(r["overfit"] == (r["val_loss"] > 3 * r["train_loss"]) for r in curve)


# --- registered model queries ------------------------------------------------


def test_model_queries_have_sound_rows(spark, sf_dir):
    run = {name: queries()[name](spark, sf_dir) for name in ("kmeans_assign", "kmeans_thermo_profile", "als_recommend")}
    vectors = inputs.digits(spark, sf_dir).count()
    assert run["kmeans_assign"].count() == vectors
    profile = run["kmeans_thermo_profile"]
    assert profile.agg(F.sum("size")).first()[0] == inputs.scanners(spark, sf_dir).count()
    assert profile.where("mirai_ratio < 0 or mirai_ratio > 1").count() == 0
    users = inputs.interactions(spark, sf_dir).select("UserID").distinct().count()
    assert run["als_recommend"].count() == 3 * users
