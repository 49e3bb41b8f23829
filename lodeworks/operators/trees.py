"""Decision-tree classification; the fitted tree as tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators.evaluation import f1_of_counts, f1_weighted
from lodeworks.sources.readers import rows_to_df
from lodeworks.sources.scratch import cached, materialize, new_path
from lodeworks.sources.workers import importable
from lodeworks.sources.writers import save_model


def fit_features(
    train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = ()
) -> PipelineModel:
    """Stages from raw columns to ``label_index`` and ``features``.

    Indexers see training rows only; unseen categories get an index of their own.
    """
    indexed = [f"{c}_index" for c in categorical]
    stages = [StringIndexer(inputCol=label, outputCol="label_index")]
    if categorical:
        stages.append(
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep")
        )
    stages.append(VectorAssembler(inputCols=[*numeric, *indexed], outputCol="features"))
    return Pipeline(stages=stages).fit(train)


def classifier(max_depth: int, min_per_node: int = 2, max_bins: int = 32) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        labelCol="label_index", featuresCol="features", maxDepth=max_depth,
        minInstancesPerNode=min_per_node, maxBins=max_bins,
    )


def fit_tree(
    train: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    max_depth: int = 5,
    min_per_node: int = 2,
    max_bins: int = 32,
) -> PipelineModel:
    """Index label and categories, assemble, fit the tree, name the predicted class."""
    prepared = fit_features(train, label, numeric, categorical)
    with cached(prepared.transform(train).select("features", "label_index")) as (vectors,):
        tree = classifier(max_depth, min_per_node, max_bins).fit(vectors)
    named = IndexToString(
        inputCol="prediction", outputCol="predicted_class", labels=prepared.stages[0].labels
    )
    return PipelineModel([*prepared.stages, tree, named])


def tree_of(model: PipelineModel) -> DecisionTreeClassificationModel:
    return next(s for s in model.stages if isinstance(s, DecisionTreeClassificationModel))


def compare_depths(
    train: DataFrame,
    test: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    depths: Sequence[int] = (2, 3, 4, 5, 6, 7),
    min_per_node: int = 2,
    max_bins: int = 32,
    threads: int = 3,
) -> DataFrame:
    """``max_depth, depth, n_nodes, f1`` of one tree per depth limit, over features made once.

    Up to ``threads`` trees are grown at a time: the passes of one leave cores idle.
    """
    prepared = fit_features(train, label, numeric, categorical)
    vectors = [prepared.transform(df).select("features", "label_index") for df in (train, test)]
    with cached(*vectors) as (train, test), ThreadPoolExecutor(threads) as pool:

        def grown(depth: int) -> tuple:
            tree = classifier(depth, min_per_node, max_bins).fit(train)
            score = f1_weighted(tree.transform(test), "label_index", "prediction").first()[0]
            return depth, tree.depth, tree.numNodes, score

        rows = list(pool.map(grown, depths))
    return rows_to_df(train.sparkSession, rows, "max_depth int, depth int, n_nodes int, f1 double")


@dataclass(frozen=True)
class Flat:
    """A fitted tree as arrays over its nodes, in the order of their ids; the root is node 0."""

    feature: np.ndarray  # -1 for a leaf
    threshold: np.ndarray  # goes left up to it; not a number where categories decide
    categories: np.ndarray  # node by category: goes left
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray

    def route(self, x: np.ndarray, depths: int) -> np.ndarray:
        """The prediction of each row's node at depth 0, 1, ... ``depths``; a leaf's goes on below it."""
        at = np.zeros(len(x), np.int64)
        out = [self.prediction[at]]
        for _ in range(depths):
            feature = self.feature[at]
            inner = np.flatnonzero(feature >= 0)
            node, value = at[inner], x[inner, feature[inner]]
            threshold = self.threshold[node]
            category = np.clip(np.nan_to_num(value), 0, self.categories.shape[1] - 1).astype(np.int64)
            goes_left = np.where(np.isnan(threshold), self.categories[node, category], value <= threshold)
            at[inner] = np.where(goes_left, self.left[node], self.right[node])
            out.append(self.prediction[at])
        return np.stack(out, axis=1)

    def cut(self, depth: int) -> tuple[int, int]:
        """Depth and number of nodes of the tree that stops at ``depth``: leaves of one parent and one class are merged."""

        def size(node: int, level: int) -> tuple[int, int, float | None]:
            """Depth and nodes below, and the class if the node ends as a leaf."""
            if level == depth or self.feature[node] < 0:
                return 0, 1, self.prediction[node]
            below = [size(child, level + 1) for child in (self.left[node], self.right[node])]
            if below[0][2] is not None and below[0][2] == below[1][2]:
                return 0, 1, below[0][2]
            return 1 + max(b[0] for b in below), 1 + below[0][1] + below[1][1], None

        return size(0, 0)[:2]


def flatten(spark: SparkSession, tree: DecisionTreeClassificationModel) -> Flat:
    """The nodes of a fitted tree, by way of its saved form. The driver holds a model's nodes as it is."""
    path = new_path(spark, "tree")
    save_model(tree, path)
    nodes = spark.read.parquet(f"{path}/data").orderBy("id").select(
        "id", "prediction", "leftChild", "rightChild", "split.featureIndex", "split.leftCategoriesOrThreshold", "split.numCategories").collect()
    n = len(nodes)
    widest = max([1, *[r["numCategories"] for r in nodes]])
    flat = Flat(np.full(n, -1), np.full(n, np.nan), np.zeros((n, widest), bool), np.zeros(n, np.int64), np.zeros(n, np.int64),
                np.array([r["prediction"] for r in nodes]))
    place = {r["id"]: i for i, r in enumerate(nodes)}
    for i, r in enumerate(nodes):
        if r["leftChild"] < 0:
            continue
        flat.feature[i], flat.left[i], flat.right[i] = r["featureIndex"], place[r["leftChild"]], place[r["rightChild"]]
        if r["numCategories"] < 0:
            flat.threshold[i] = r["leftCategoriesOrThreshold"][0]
        else:
            flat.categories[i, np.array(r["leftCategoriesOrThreshold"], int)] = True
    return flat


def score_depths(
    train: DataFrame,
    test: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    depths: Sequence[int] = (2, 3, 4, 5, 6, 7),
    min_per_node: int = 2,
    max_bins: int = 32,
) -> DataFrame:
    """The rows of ``compare_depths`` from one fit: ``max_depth, depth, n_nodes, f1``.

    A tree is grown from the top, so the tree of a smaller limit is the top of the
    deepest one. Each test row goes down that tree once and is scored at every depth; one
    aggregate has the confusion counts of all depths.
    """
    spark = train.sparkSession
    importable(spark)
    prepared = fit_features(train, label, numeric, categorical)
    with cached(prepared.transform(train).select("features", "label_index")) as (vectors,):
        deepest = classifier(max(depths), min_per_node, max_bins).fit(vectors)
    flat = flatten(spark, deepest)
    held, most = spark.sparkContext.broadcast(flat), max(depths)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            found = held.value.route(x, most)
            places = pa.array(np.arange(0, found.size + 1, most + 1, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("label_index"), pa.ListArray.from_arrays(places, pa.array(found.ravel()))],
                                             names=["label_index", "at_depth"])

    scored = prepared.transform(test).select("label_index", vector_to_array("features").alias("x")).mapInArrow(
        routed, "label_index double, at_depth array<double>")
    confusion = materialize(scored.select("label_index", F.posexplode("at_depth").alias("depth", "prediction")).groupBy(
        "depth", "label_index", "prediction").agg(F.count(F.lit(1)).alias("n")), "confusion")
    rows = []
    for depth in depths:
        cells = confusion.where(F.col("depth") == depth)
        rows.append((depth, *flat.cut(depth), f1_of_counts(cells, "label_index", "prediction", "n").first()[0]))
    held.destroy()
    return rows_to_df(spark, rows, "max_depth int, depth int, n_nodes int, f1 double")


def tree_nodes(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The node table of the fitted tree, read from the saved model's data files.

    A split is a ``threshold`` or the ``categories`` that go left, by their names.
    """
    path = new_path(spark, "tree")
    save_model(tree_of(model), path)
    raw = spark.read.parquet(f"{path}/data")
    features = rows_to_df(spark, _features(model), "_index int, feature string, _labels array<string>")
    leaf = F.col("leftChild") < 0
    values = F.col("split.leftCategoriesOrThreshold")
    nodes = raw.select(
        "id",
        "prediction",
        "impurity",
        F.col("impurityStats").alias("stats"),
        "gain",
        F.when(~leaf, F.col("leftChild")).alias("left"),
        F.when(~leaf, F.col("rightChild")).alias("right"),
        F.when(~leaf, F.col("split.featureIndex")).alias("_index"),
        F.when(~leaf & (F.col("split.numCategories") < 0), F.get(values, F.lit(0))).alias("threshold"),
        F.when(~leaf & (F.col("split.numCategories") >= 0), values).alias("_left_values"),
        leaf.alias("is_leaf"),
    )
    named = F.transform("_left_values", lambda v: F.get("_labels", v.cast("int")))
    return nodes.join(features, "_index", "left").select(
        *[c for c in nodes.columns if not c.startswith("_")], "feature", named.alias("categories")
    )


def _features(model: PipelineModel) -> list[tuple[int, str, list[str] | None]]:
    """Position, column and category names (the last one for unseen values) of each feature."""
    sources = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel) and stage.isSet(stage.inputCols):
            for name, out, labels in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray):
                sources[out] = (name, [*labels, "<other>"])
    columns = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    return [(i, *sources.get(column, (column, None))) for i, column in enumerate(columns)]


def tree_rules(nodes: DataFrame) -> DataFrame:
    """``leaf, rule, condition, prediction, stats``: the tests on the way from the root to each leaf.

    ``condition`` is the rule as SQL over the rows the tree was fitted on. One join per
    tree level over a table of nodes, down to the deepest leaf.
    """
    nodes = materialize(nodes, "nodes")
    among = F.concat(F.lit(" {"), F.array_join("categories", ", "), F.lit("}"))

    def test(compare: str, member: str) -> Column:
        bound = F.concat("feature", F.lit(compare), F.col("threshold").cast("string"))
        return F.coalesce(bound, F.concat("feature", F.lit(member), among))

    name = F.concat(F.lit("`"), "feature", F.lit("`"))
    quoted = F.transform("categories", lambda c: F.concat(F.lit("'"), F.replace(
        F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'")))
    member = F.concat(F.lit("coalesce(cast("), name, F.lit(" as string), '') in ("), F.array_join(quoted, ", "), F.lit(")"))
    goes_left = F.coalesce(F.concat(name, F.lit(" <= "), F.col("threshold").cast("string"), F.lit("d")), member)

    is_left, is_right = test(" <= ", " in"), test(" > ", " not in")
    steps = nodes.where(~F.col("is_leaf")).select(
        F.col("id").alias("_from"),
        F.inline(
            F.array(
                F.struct(F.col("left").alias("_to"), is_left.alias("_test"), goes_left.alias("_sql")),
                F.struct(F.col("right").alias("_to"), is_right.alias("_test"),
                         F.concat(F.lit("not ("), goes_left, F.lit(")")).alias("_sql")),
            )
        ),
    )
    frontier = nodes.where(F.col("id") == 0).select("id", F.lit("").alias("rule"), F.lit("true").alias("condition"))
    paths = frontier
    while not frontier.isEmpty():
        frontier = materialize(frontier.join(steps, F.col("id") == F.col("_from")).select(
            F.col("_to").alias("id"),
            F.concat_ws(" and ", F.nullif(F.col("rule"), F.lit("")), F.col("_test")).alias("rule"),
            F.concat_ws(" and ", "condition", "_sql").alias("condition"),
        ), "rules")
        paths = paths.unionByName(frontier)
    leaves = nodes.where("is_leaf").select("id", "prediction", "stats")
    return paths.join(leaves, "id").select(F.col("id").alias("leaf"), "rule", "condition", "prediction", "stats")
