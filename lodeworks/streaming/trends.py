"""Token counts by windows of event time, and the trend from one period to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodeworks.operators.filters import filter_prefix
from lodeworks.operators.reshape import tokenize


def start_window_counts(
    texts: DataFrame, prefix: str, out: str, checkpoint: str, ts: str = "ts", col: str = "text", window: str = "1 day",
    late: str = "1 day", **tokenizing: object,
) -> StreamingQuery:
    """Count tokens with a prefix per window of ``ts`` in all available input: ``start, token, n``, a folder per batch.

    A window takes rows up to ``late`` behind the latest time of the batches before; then
    its state is dropped, and later rows with it. A batch writes the counts that it
    changed; one that is replayed after a failure overwrites its own folder.
    """
    timed = texts.where(F.col(ts).isNotNull()).withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    tokens = filter_prefix(tokenize(timed, col, keep=["_ts"], **tokenizing), prefix)
    counted = tokens.groupBy(F.window("_ts", window).alias("window"), "token").agg(F.count(F.lit(1)).alias("n"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        counted.select(F.col("window.start").alias("start"), "token", "n")
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def window_counts(written: DataFrame) -> DataFrame:
    """The current count per window and token from the batches written so far (counts only grow)."""
    return written.groupBy("start", "token").agg(F.max("n").alias("n"))


def trend(counts: DataFrame, cut: str, min_exclusive: int) -> DataFrame:
    """``token, n_first, n_second, n_total``: tokens with more than ``min_exclusive`` rows in windows before ``cut``."""
    first = F.col("start") < F.lit(cut).cast("timestamp")
    both = counts.groupBy("token").agg(F.sum(F.when(first, F.col("n")).otherwise(0)).alias("n_first"),
                                       F.sum(F.when(first, 0).otherwise(F.col("n"))).alias("n_second"))
    return both.where(F.col("n_first") > min_exclusive).withColumn("n_total", F.col("n_first") + F.col("n_second"))
