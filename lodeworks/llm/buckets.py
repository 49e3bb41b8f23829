"""Intermediate tables in buckets of a key, so that joins on it leave them where they are."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lodeworks.sources.scratch import new_path


class Buckets:
    """Stores tables in the shared folder, dealt over as many buckets as a shuffle has partitions.

    Spark knows buckets of named tables only, so each table has a name of its own in the
    catalog until the block ends. Its files stay with the other intermediate tables.
    """

    def __init__(self, spark: SparkSession, key: str = "shard"):
        self.spark, self.key, self.names = spark, key, []
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def __enter__(self) -> Buckets:
        return self

    def store(self, df: DataFrame, name: str) -> DataFrame:
        table = f"lodeworks_{uuid.uuid4().hex}"
        df.write.format("parquet").option("path", new_path(self.spark, name)).bucketBy(self.parts, self.key).saveAsTable(table)
        self.names.append(table)
        return self.spark.table(table)

    def __exit__(self, *_: object) -> None:
        for table in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
