"""Usage counts kept up to date while the request log grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.operators.stats import metric_values
from pagetrail.sources.generations import current, publish

COUNTS = "metric string, value string, count bigint"


def add_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Add the log rows of one batch to the table of counts below ``path``.

    Each batch publishes a generation under its number, made from the one before it. A batch that is repeated after it was
    published changes nothing; one that failed is made anew from the same predecessor.
    """
    spark = batch.sparkSession
    counted = metric_values(batch).groupBy("metric", "value").agg(F.count("*").alias("count"))
    before = current(spark, path, before=batch_id)
    if before is not None:
        counted = spark.read.schema(COUNTS).parquet(before).unionByName(counted)
        counted = counted.groupBy("metric", "value").agg(F.sum("count").alias("count"))
    publish(spark, path, counted.write.parquet, number=batch_id)


def keep_counts(log_stream: DataFrame, path: str, checkpoint: str) -> None:
    """Bring the counts below ``path`` up to everything that has arrived; no state is kept but the published table."""
    (
        log_stream.writeStream.foreachBatch(lambda batch, batch_id: add_batch(batch, batch_id, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    """(metric, value, count) as of the last finished batch, at any time."""
    folder = current(spark, path)
    return spark.read.schema(COUNTS).parquet(folder) if folder else spark.createDataFrame([], COUNTS)
