"""Feed-forward classifier.

Spark's multilayer perceptron has sigmoid hidden units, a softmax output and is
trained with L-BFGS over all rows. A network with rectified units, a stochastic
optimiser and mini-batches learns other weights; sizes, data flow and the
overfitting check are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.evaluation import loss_and_accuracy
from lodeworks.sources.readers import rows_to_df
from lodeworks.sources.scratch import cached


def vector_input(df: DataFrame, arr: str, label: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep..., features, label`` from an array of numbers and a class number."""
    return df.select(
        *keep, array_to_vector(F.col(arr)).alias("features"), F.col(label).cast("double").alias("label")
    )


def fit_mlp(
    train: DataFrame,
    inputs: int,
    classes: int,
    hidden: Sequence[int] = (512, 512, 512),
    iters: int = 30,
    block: int = 128,
    seed: int = 1,
    initial=None,
) -> MultilayerPerceptronClassificationModel:
    """Fit on ``features, label``; ``initial`` continues from earlier weights."""
    net = MultilayerPerceptronClassifier(
        layers=[inputs, *hidden, classes], maxIter=iters, blockSize=block, seed=seed
    )
    if initial is not None:
        net = net.setInitialWeights(initial)
    return net.fit(train)


def fit_curve(
    train: DataFrame,
    validation: DataFrame,
    inputs: int,
    classes: int,
    architectures: Sequence[Sequence[int]],
    budgets: Sequence[int],
    factor: float = 3.0,
    block: int = 128,
    seed: int = 1,
) -> DataFrame:
    """Losses and accuracies of one fit per iteration budget and architecture.

    Every budget is a fit of its own: L-BFGS continued from earlier weights would have
    lost its curvature history. ``overfit`` marks a validation loss above ``factor``
    times the training loss.
    """
    rows = []
    with cached(train, validation) as (train, validation):
        for hidden in architectures:
            for budget in sorted(budgets):
                model = fit_mlp(train, inputs, classes, hidden, budget, block, seed)
                train_loss, train_acc = loss_and_accuracy(model.transform(train), "label").first()
                val_loss, val_acc = loss_and_accuracy(model.transform(validation), "label").first()
                rows.append((
                    "-".join(map(str, hidden)), budget, train_loss, val_loss, train_acc, val_acc,
                    val_loss > factor * train_loss,
                ))
    return rows_to_df(
        train.sparkSession, rows,
        "layers string, iters int, train_loss double, val_loss double, train_acc double, "
        "val_acc double, overfit boolean",
    )
