"""Text, CSV and log-table outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_lines(lines: DataFrame, path: str, column: str = "line") -> None:
    """One text file for a short report (a few lines; use ``df.write.text`` for anything larger)."""
    lines.select(column).coalesce(1).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_log(rows: DataFrame, path: str, moment: str = "request_time") -> None:
    """Append log rows to a parquet table partitioned by day."""
    by_day(rows, F.col(moment)).write.mode("append").partitionBy("day").parquet(path)


def by_day(rows: DataFrame, moment: Column) -> DataFrame:
    return rows.withColumn("day", F.to_date(moment))
