"""Table, line and row sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    infer: bool = False,
    **options: str,
) -> DataFrame:
    """Read a table. CSV has a header and needs ``schema`` or ``infer=True``.

    Inference costs a second full scan of the files, so it has to be asked for.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        if schema is None and not infer:
            raise ValueError("CSV needs a schema (or infer=True, which scans the files twice)")
        reader = reader.option("header", "true")
        if schema is None:
            reader = reader.option("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv_columns(
    spark: SparkSession, path: str, schema: T.StructType | str, **options: str
) -> DataFrame:
    """The named columns of CSV files with a header, in any order and among others.

    Values are read as text and cast, so nothing is inferred and no column is parsed
    that is not asked for; a value that does not fit its type is an error.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return typed_projection(spark.read.options(header="true", **options).csv(path), schema)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per text line."""
    return spark.read.text(path)


def rows_to_df(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small driver-side result (metric rows and the like) as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)


def typed_projection(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give data-sized input an explicit schema: select and cast by field name."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
