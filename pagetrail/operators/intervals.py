"""Joins of moments with the intervals they fall into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.session import materialize


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def interval_join(rows: DataFrame, intervals: DataFrame, moment: str, start: str, end: str, how: str = "left") -> DataFrame:
    """``rows`` with the columns of each interval that their ``moment`` lies in, ``start`` included and ``end`` not.

    Intervals are cut into buckets of time as wide as they are on average, so all of them together have at most twice as many
    pieces as there are intervals. Rows and pieces meet by an equi-join on the bucket and a test of the range; a bucket with
    very many rows can be split like any key. Rows without a moment and intervals without both ends meet nothing.
    Column names of the two tables must differ.
    """
    bounded = intervals.filter(F.col(start) < F.col(end))
    low, high = _micros(F.col(start)), _micros(F.col(end))
    width = bounded.agg(F.greatest(F.ceil(F.avg(high - low)), F.lit(1)).cast("bigint").alias("width")).first()["width"] or 1

    def bucket(micros: Column) -> Column:
        return F.floor(micros / width).cast("bigint")

    pieces = bounded.withColumn("_piece", F.explode(F.sequence(bucket(low), bucket(high - 1))))
    placed = rows.withColumn("_bucket", bucket(_micros(F.col(moment))))
    inside = (F.col(moment) >= F.col(start)) & (F.col(moment) < F.col(end))
    return placed.join(pieces, (F.col("_bucket") == F.col("_piece")) & inside, how).drop("_bucket", "_piece")


def consecutive(events: DataFrame, moment: str, *order: str, end: str = "until") -> DataFrame:
    """``events`` with ``end``, the moment of the next event; null for the last.

    Events are sorted over all tasks. The end of the last event of a sorted part is the first moment of the next part.
    """
    key = [moment, *order]
    parts = events.repartitionByRange(*key).withColumn("_part", F.spark_partition_id())
    parts = materialize(parts, "consecutive")
    heads = parts.groupBy("_part").agg(F.min(moment).alias("_first"))  # a row per sorted part
    after = F.lead("_first").over(Window.orderBy("_part")).alias("_after")
    heads = heads.select("_part", after)
    inside = F.lead(moment).over(Window.partitionBy("_part").orderBy(*key))
    following = parts.withColumn(end, inside).join(F.broadcast(heads), "_part")
    return following.withColumn(end, F.coalesce(end, "_after")).drop("_part", "_after")
