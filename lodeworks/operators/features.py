"""Feature engineering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    CountVectorizerModel, Imputer, IndexToString, StringIndexerModel, VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.columns import multi_hot_columns, scaled, thermometer_columns
from lodeworks.operators.counts import count_by, sort_counts, top_k
from lodeworks.operators.indexing import dense_index
from lodeworks.operators.reshape import explode_items
from lodeworks.sources.scratch import materialize, new_path

STORED, UNKNOWN = "label_table", "unknown_label"  # metadata of an index column whose labels are a stored table
MAX_MODEL_LABELS = 10_000  # label lists up to this size may live on the driver


def top_items(df: DataFrame, arr: str, n: int) -> DataFrame:
    """The ``n`` items found in most rows; a repeat within a row counts once."""
    items = explode_items(df.select(F.array_distinct(arr).alias(arr)), arr)
    return top_k(count_by(items, "item"), n, "item")


def multi_hot_topn(
    df: DataFrame, arr: str, n: int, prefix: str = "Port", by_rank: bool = False
) -> DataFrame:
    """Add one boolean per frequent item, named after the item or after its rank.

    Only the ``n`` names come to the driver, to become column names. A null array has
    none of the items. For thousands of items ``multi_hot_vector`` gives a shorter plan.
    """
    items = [row["item"] for row in top_items(df, arr, n).collect()]
    names = [f"{prefix}{i + 1 if by_rank else item}" for i, item in enumerate(items)]
    return df.withColumns(multi_hot_columns(F.col(arr), items, names))


def multi_hot_vector(df: DataFrame, arr: str, vocabulary: Sequence[str], out: str) -> DataFrame:
    """The same indicators as one sparse vector column, for long item lists."""
    model = CountVectorizerModel.from_vocabulary(
        list(vocabulary), inputCol=arr, outputCol=out, binary=True
    )
    return model.transform(df)


def thermometer(df: DataFrame, col: str, levels: int = 16, prefix: str | None = None) -> DataFrame:
    """Add ``levels + 1`` booleans: above 0, above 1, above 2, above 4 and so on."""
    return df.withColumns(thermometer_columns(F.col(col), levels, prefix or f"TE_{col}"))


def label_table(df: DataFrame, col: str) -> DataFrame:
    """``label, idx``: the values of ``col`` as text, by falling frequency (ties in text order)."""
    texts = df.select(F.col(col).cast("string").alias("label")).where(F.col("label").isNotNull())
    numbered = dense_index(count_by(texts, "label"), [F.desc("n"), F.col("label")], "idx")
    return materialize(numbered.select("label", F.col("idx").cast("double").alias("idx")), "labels")


def string_index(
    df: DataFrame, col: str, out: str, max_labels: int = MAX_MODEL_LABELS, nulls: str = "error"
) -> DataFrame:
    """Number the values of ``col`` by falling frequency (ties in the order of their text).

    ``nulls`` is an ``error``, or they ``keep`` a number of their own (the number of
    labels), or ``skip`` drops their rows. Up to ``max_labels`` labels become a fitted
    indexer, which leaves them in the column's metadata. More stay a distributed table
    that is numbered range by range and joined back, with equal numbers; the metadata
    says where it is stored. So ``index_to_string`` turns either back as it is, as long
    as the application runs; beyond it, pass it the ``label_table``.
    """
    if nulls not in ("error", "keep", "skip"):
        raise ValueError("nulls is error, keep or skip")
    texts = df.select(F.col(col).cast("string").alias(col)).where(F.col(col).isNotNull())
    labels = [row[col] for row in sort_counts(count_by(texts, col), col).limit(max_labels + 1).collect()]
    if len(labels) <= max_labels:
        text = f"{out}_text"
        indexer = indexer_of(labels, text, out, nulls)
        return indexer.transform(df.withColumn(text, F.col(col).cast("string"))).drop(text)
    path = new_path(df.sparkSession, "labels")
    label_table(df, col).write.parquet(path)
    table = df.sparkSession.read.parquet(path)
    if nulls == "skip":
        df = df.where(F.col(col).isNotNull())
    unknown = F.raise_error(F.lit(f"null in {col}")).cast("double") if nulls == "error" else F.lit(float(table.count()))
    joined = df.join(table, F.col(col).cast("string") == F.col("label"), "left")
    number = F.when(F.col("label").isNotNull(), F.col("idx")).otherwise(unknown)
    where = {STORED: path, **({UNKNOWN: "__unknown"} if nulls == "keep" else {})}
    return joined.select(*[df[c] for c in df.columns], number.alias(out, metadata=where))


def indexer_of(labels: Sequence[str], col: str, out: str, nulls: str = "error") -> StringIndexerModel:
    return StringIndexerModel.from_labels(
        list(labels), inputCol=col, outputCol=out, handleInvalid=nulls
    )


def index_to_string(
    df: DataFrame, col: str, out: str, labels: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """Original labels of an index column, from its metadata, a list or a ``label_table``.

    The number that stands for null where nulls were kept becomes ``__unknown``.
    """
    meta = df.schema[col].metadata or {}
    if labels is None and STORED in meta:
        named = index_to_string(df, col, out, df.sparkSession.read.parquet(meta[STORED]))
        unknown = F.when(F.col(col).isNotNull(), F.lit(meta.get(UNKNOWN)))
        return named.withColumn(out, F.coalesce(F.col(out), unknown))
    if isinstance(labels, DataFrame):
        named = labels.select(F.col("idx").alias("_idx"), F.col("label").alias(out))
        return df.join(named, F.col(col) == F.col("_idx"), "left").drop("_idx")
    stage = IndexToString(inputCol=col, outputCol=out)
    if labels is not None:
        stage = stage.setLabels(list(labels))
    return stage.transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """One vector from numeric and boolean columns."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def scale(df: DataFrame, cols: Sequence[str], divisor: float) -> DataFrame:
    """Replace the columns by themselves over ``divisor``, as doubles."""
    return df.withColumns({c: scaled(F.col(c), divisor) for c in cols})


def scale_array(df: DataFrame, col: str, divisor: float) -> DataFrame:
    """The same for every element of an array column."""
    return df.withColumn(col, F.transform(col, lambda x: scaled(x, divisor)))


def clean_missing(df: DataFrame, col: str, marker: str = "?", to_type: str = "int") -> DataFrame:
    """Turn the missing-value marker into null and the rest into numbers."""
    return df.withColumn(col, F.nullif(F.col(col), F.lit(marker)).try_cast(to_type))


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Fill nulls of numeric columns with the column's mean, median or mode."""
    as_double = df.withColumns({c: F.col(c).cast("double") for c in cols})
    return Imputer(inputCols=list(cols), outputCols=list(cols), strategy=strategy).fit(as_double).transform(as_double)
