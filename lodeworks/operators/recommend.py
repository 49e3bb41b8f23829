"""Rating prediction by alternating least squares, with an explicit validation grid."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.evaluation import mark_best, rmse
from lodeworks.operators.indexing import dense_index
from lodeworks.operators.topn import top_items
from lodeworks.sources.readers import rows_to_df
from lodeworks.sources.scratch import cached, materialize, shared_dir

INT_MAX = 2**31 - 1
GRID_SCHEMA = "rank int, reg double, iters int, val_rmse double"
SETTINGS = ["rank", "reg", "iters"]


def with_int_id(df: DataFrame, col: str, out: str) -> DataFrame:
    """Add an int id for ``col``: a cast where all values fit, dense numbers otherwise.

    Null stays null either way, and ``col`` stays beside its number.
    """
    low, high = df.agg(F.min(col), F.max(col)).first()
    if low is None or (isinstance(low, int) and -INT_MAX <= low and high <= INT_MAX):
        return df.withColumn(out, F.col(col).cast("int"))
    ids = dense_index(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], out)
    ids = materialize(ids.select(F.col(col).alias("_known"), F.col(out).cast("int").alias(out)), "ids")
    return df.join(ids, F.col(col) == F.col("_known"), "left").drop("_known")


def with_original(df: DataFrame, ids: DataFrame, number: str, col: str) -> DataFrame:
    """Replace the int id ``number`` by the value of ``col`` that ``ids`` has beside it."""
    known = ids.where(F.col(number).isNotNull()).select(F.col(number).alias("_number"), F.col(col).alias("_value")).distinct()
    joined = df.join(materialize(known, "ids"), F.col(number) == F.col("_number"))
    return joined.select(*[F.col("_value").alias(col) if c == number else F.col(c) for c in df.columns])


def fit_als(
    ratings: DataFrame,
    rank: int = 4,
    reg: float = 0.1,
    iters: int = 10,
    seed: int = 37,
    user: str = "UserID",
    item: str = "ItemID",
    rating: str = "Rating",
    blocks: int | None = None,
) -> ALSModel:
    """Explicit-feedback fit. Cold users and items are dropped from predictions."""
    shared_dir(ratings.sparkSession)  # long fits cut their lineage there
    als = ALS(
        rank=rank, maxIter=iters, regParam=reg, seed=seed, userCol=user, itemCol=item,
        ratingCol=rating, coldStartStrategy="drop",
    )
    if blocks is not None:
        als = als.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    return als.fit(ratings)


def predict_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Add ``prediction``; the actual rating stays on the row, so no join back is needed."""
    return model.transform(pairs)


def tune_als(
    train: DataFrame,
    validation: DataFrame,
    ranks: Sequence[int] = (4, 8, 12),
    regs: Sequence[float] = (0.01, 0.05, 0.1),
    iterations: Sequence[int] = (10, 15, 20),
    seed: int = 37,
    **columns: str,
) -> DataFrame:
    """Validation error per setting: ``rank, reg, iters, val_rmse``.

    The loop runs over settings only; each fit and each score is a Spark job and
    the driver keeps one number per setting.
    """
    rows = []
    with cached(train, validation) as (train, validation):  # laid out once for all settings
        for rank, reg, iters in _settings(ranks, regs, iterations):
            model = fit_als(train, rank, reg, iters, seed, **columns)
            rows.append((rank, reg, iters, _score(model, validation, columns)))
    return rows_to_df(train.sparkSession, rows, GRID_SCHEMA)


def best_config(
    metrics: DataFrame, train: DataFrame, test: DataFrame, seed: int = 37, **columns: str
) -> DataFrame:
    """Refit the setting with the lowest error and add ``test_rmse`` (null for the others)."""
    best = mark_best(metrics, "val_rmse", SETTINGS)
    setting = best.where("is_best").select(*SETTINGS).first()
    if setting is None:  # no setting has a score
        return best.withColumn("test_rmse", F.lit(None).cast("double"))
    rank, reg, iters = setting
    with cached(train) as (train,):
        model = fit_als(train, rank, reg, iters, seed, **columns)
        error = _score(model, test, columns)
    return best.withColumn("test_rmse", F.when(F.col("is_best"), F.lit(error)))


def tune_and_test(
    train: DataFrame,
    validation: DataFrame,
    test: DataFrame,
    ranks: Sequence[int] = (4, 8, 12),
    regs: Sequence[float] = (0.01, 0.05, 0.1),
    iterations: Sequence[int] = (10, 15, 20),
    seed: int = 37,
    **columns: str,
) -> DataFrame:
    """``tune_als`` and ``best_config`` in one: the best model so far is kept, so nothing is fitted twice."""
    rows, best = [], None
    with cached(train, validation) as (train, validation):
        for setting in _settings(ranks, regs, iterations):
            model = fit_als(train, *setting, seed, **columns)
            error = _score(model, validation, columns)
            rows.append((*setting, error))
            if error is not None and error == error and (best is None or (error, setting) < best[0]):
                best = (error, setting), model
        tested = _score(best[1], test, columns) if best else None
    marked = mark_best(rows_to_df(test.sparkSession, rows, GRID_SCHEMA), "val_rmse", SETTINGS)
    return marked.withColumn("test_rmse", F.when(F.col("is_best"), F.lit(tested).cast("double")))


def recommend(model: ALSModel, n: int, users: DataFrame | None = None) -> DataFrame:
    """The ``n`` items with the highest predicted rating per user: ``user, rank, item, score``.

    All users, or those of ``users`` that the model knows. Items that cannot be among the
    best of a user are not scored (``topn.py``).
    """
    user, item = model.getUserCol(), model.getItemCol()
    known = model.userFactors.select(F.col("id").alias(user), F.col("features").alias("f"))
    if users is not None:
        known = known.join(users.select(F.col(user).alias("_asked")).distinct(), F.col(user) == F.col("_asked"), "left_semi")
    items = model.itemFactors.select(F.col("id").alias(item), F.col("features").alias("f"))
    return top_items(known, items, n, user, item)[0]


def _settings(
    ranks: Iterable[int], regs: Iterable[float], iterations: Iterable[int]
) -> list[tuple[int, float, int]]:
    return [(k, r, i) for k in ranks for r in regs for i in iterations]


def _score(model: ALSModel, pairs: DataFrame, columns: dict[str, str]) -> float:
    return rmse(predict_pairs(model, pairs), columns.get("rating", "Rating"), "prediction").first()[0]
