"""Intermediate tables and cached inputs that survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIT_PARTITIONS = 32  # partitions of the input of an iterative fit; raise it with the data


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own, because on a
    cluster a driver-side temporary folder is invisible to the executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lodeworks-"))
    return sc.getCheckpointDir().rstrip("/")


_run_folders: dict[str, str] = {}


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path in this application's part of the shared folder.

    The application's part is removed when its driver ends.
    """
    sc = spark.sparkContext
    run = _run_folders.get(sc.applicationId)
    if run is None:
        run = f"{shared_dir(spark)}/lodeworks-{sc.applicationId}-{uuid.uuid4().hex}"
        folder = sc._jvm.org.apache.hadoop.fs.Path(run)
        files = folder.getFileSystem(sc._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _run_folders[sc.applicationId] = run
    return f"{run}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once as parquet and return the stored table.

    Used where one intermediate result feeds several jobs. Later plans start
    from files (no long lineage to replay), prune its columns, and know its real
    size, so Catalyst broadcasts it only when it is under the configured limit.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(*stored: DataFrame) -> None:
    """Remove the tables of ``materialize``, when their consumers have run."""
    for df in stored:
        sc = df.sparkSession.sparkContext
        for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            folder = sc._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def step(df: DataFrame, name: str = "step") -> Iterator[DataFrame]:
    """``materialize`` for the length of a block: the table is removed when its consumers have run."""
    stored = materialize(df, name)
    try:
        yield stored
    finally:
        remove(stored)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the length of a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def swept(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries that run in the block remove the files of their shuffles as they end.

    Else the files stay until the driver happens to collect its garbage, which a driver
    with little to do does not.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def lay_out(df: DataFrame, parts: int = FIT_PARTITIONS) -> DataFrame:
    """Rows dealt by a hash of their content and sorted by it.

    The seeds of an iterative fit depend on which rows share a partition and in which
    order. Laid out like this they depend on the rows and ``parts`` alone, not on the
    input's files or the number of cores.
    """
    content = F.xxhash64(*df.columns)
    return df.repartition(parts, content).sortWithinPartitions(content)


@contextmanager
def cached(*frames: DataFrame, parts: int = FIT_PARTITIONS) -> Iterator[tuple[DataFrame, ...]]:
    """Keep the inputs of an iterative fit in memory (spilling), laid out the same way each time."""
    kept: list[DataFrame] = []
    try:
        for frame in frames:
            kept.append(lay_out(frame, parts).persist(StorageLevel.MEMORY_AND_DISK))
            kept[-1].count()
        yield tuple(kept)
    finally:
        for frame in kept:
            frame.unpersist()
