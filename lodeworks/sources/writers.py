"""Text, table and model sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.util import DefaultParamsReader, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def format_lines(df: DataFrame, cols: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """One string column ``value`` per row: the fields joined with ``sep``, null as empty."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (cols or df.columns)]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def write_lines(df: DataFrame, path: str, cols: Sequence[str] | None = None, sep: str = ",") -> None:
    """Write a directory of text part files; an existing ``path`` is an error."""
    format_lines(df, cols, sep).write.mode("errorifexists").text(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    writer = df.write.format(fmt).mode(mode).options(**options)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_model(model: MLWritable, path: str) -> None:
    """Save a fitted model, replacing an older one at ``path``."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str):
    """What ``save_model`` wrote: a fitted pipeline or a single stage, ready to transform."""
    return DefaultParamsReader.loadParamsInstance(path, spark)
