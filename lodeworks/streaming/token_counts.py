"""Running token counts over a stream of text, with the batch operators unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodeworks.operators.counts import count_by
from lodeworks.operators.filters import filter_prefix
from lodeworks.operators.reshape import tokenize

COMPACT_EVERY = 50  # batches after which the folders written so far become one


def start_prefix_counts(
    texts: DataFrame, prefix: str, out: str, checkpoint: str, col: str = "text",
    compact_every: int = COMPACT_EVERY, **tokenizing: object,
) -> StreamingQuery:
    """Count tokens with a prefix in all available input, one output folder per batch.

    Update mode writes only the tokens whose count changed. A batch that is
    replayed after a failure overwrites its own folder, so counts stay exact. Every
    ``compact_every`` batches the folders are merged into one.
    """
    tokens = filter_prefix(tokenize(texts, col, **tokenizing), prefix)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, out, batch_id)

    return (
        count_by(tokens, "token")
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def compact(spark: SparkSession, out: str, batch_id: int) -> None:
    """Merge all folders into ``batch=<id>-all``, then remove what it replaces.

    Counts only grow, so a reader that still sees an old folder gets the same result,
    and a replay finds the merged folder and leaves it.
    """
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    files = path(out).getFileSystem(sc._jsc.hadoopConfiguration())
    merged = f"{out}/batch={batch_id}-all"
    if not files.exists(path(f"{merged}/_SUCCESS")):
        old = [str(f.getPath()) for f in files.listStatus(path(out)) if not str(f.getPath()).endswith(f"={batch_id}-all")]
        latest_counts(spark.read.parquet(*old)).write.mode("overwrite").parquet(merged)
    for folder in files.listStatus(path(out)):
        name = folder.getPath().getName().removeprefix("batch=")
        if name != f"{batch_id}-all" and int(name.removesuffix("-all")) <= batch_id:
            files.delete(folder.getPath(), True)


def latest_counts(written: DataFrame) -> DataFrame:
    """The current count per token from the batches written so far (counts only grow)."""
    return written.groupBy("token").agg(F.max("n").alias("n"))
