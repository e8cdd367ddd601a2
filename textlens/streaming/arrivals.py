"""Queries that arrive as a stream, answered batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.session import scratch_path
from textlens.sources.store import path_exists


def answer_arrivals(
    arrivals: DataFrame,
    answer: Callable[[DataFrame], DataFrame],
    out: str | None = None,
    checkpoint: str | None = None,
    timeout: int | None = None,
) -> DataFrame:
    """Run ``answer`` on each micro-batch of a query stream and return the stored answers.

    A batch replaces its own ``batch_id`` folder, so a batch that is run again after a failure
    leaves its answers once. ``answer`` reads a fixed index; the stream itself keeps no state.
    Processes what is available and stops; raises ``TimeoutError`` when that takes longer than ``timeout``
    seconds, and a later run with the same folders goes on from there. Give ``out`` and ``checkpoint`` to go on later.
    """
    spark = arrivals.sparkSession
    out = out or scratch_path(spark, "answers")
    checkpoint = checkpoint or scratch_path(spark, "stream")

    def store(batch: DataFrame, batch_id: int) -> None:
        answer(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = arrivals.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    stream = writer.trigger(availableNow=True).start()
    if not stream.awaitTermination(timeout) and timeout is not None:
        stream.stop()
        raise TimeoutError(f"arrivals were not answered within {timeout} seconds")
    if not path_exists(spark, out):
        nothing = answer(spark.createDataFrame([], arrivals.schema))
        return nothing.withColumn("batch_id", F.lit(None).cast("long"))
    return spark.read.option("basePath", out).parquet(out).withColumn("batch_id", F.col("batch_id").cast("long"))
