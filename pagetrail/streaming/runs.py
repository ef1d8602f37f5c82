"""Running a streaming query over what has arrived, and reading its results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pagetrail.session import scratch_path


def read_arrivals(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Stream over the parquet files ``path`` matches, in the order they arrive."""
    return spark.readStream.schema(schema).parquet(path)


def append_to_files(stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> None:
    """Process everything available and append it to a parquet table, each row exactly once over all runs."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def appended(stream: DataFrame, purpose: str) -> DataFrame:
    """One run of ``append_to_files`` into a new folder, read back."""
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, purpose), scratch_path(spark, f"{purpose}-checkpoint")
    append_to_files(stream, path, checkpoint)
    return spark.read.schema(stream.schema).parquet(path)
