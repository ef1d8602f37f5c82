"""Consumers of a message queue that can be stopped, or fail, at any time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagetrail.sources.messages import subscribe
from pagetrail.streaming.forbidden import received_messages


def consume(
    spark: SparkSession, queue: str, output: str, checkpoint: str, handle: Callable[[DataFrame], DataFrame] = received_messages
) -> None:
    """Handle all messages that have been published and not been acknowledged; results append to the parquet folders below ``output``.

    The results of a batch are one folder under the batch's number. A repeated batch writes its folder anew, so each message
    counts once, however often it is delivered.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        handle(batch).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    (
        subscribe(spark, queue).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def consumed(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(output).drop("batch")
