"""The usage report over the request log and the failure log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.logs import age_group
from pagetrail.session import materialize


def success_vs_failure(logs: DataFrame, failed: DataFrame) -> DataFrame:
    """One row (successful, unsuccessful): logged requests minus failures, and failures.

    Some failures have no request row, so the first number undercounts and can be negative; the report defines it so.
    """
    requests = logs.agg(F.count("*")).scalar()
    counted = failed.agg(F.count("*").alias("unsuccessful"))
    return counted.select((requests - F.col("unsuccessful")).alias("successful"), "unsuccessful")


def banned_requests(logs: DataFrame) -> DataFrame:
    return logs.filter("is_banned").agg(F.count("*").alias("banned_requests"))


def _counted(logs: DataFrame, column: str) -> DataFrame:
    return logs.groupBy(column).agg(F.count("*").alias("count"))


def by_gender(logs: DataFrame) -> DataFrame:
    return _counted(logs, "gender").orderBy(F.desc("count"), "gender")


def top_countries(logs: DataFrame, n: int = 5) -> DataFrame:
    return _counted(logs, "country").orderBy(F.desc("count"), "country").limit(n)


def top_age_group(logs: DataFrame) -> DataFrame:
    grouped = logs.select(age_group(F.col("age")).alias("age_group"))
    return _counted(grouped, "age_group").orderBy(F.desc("count"), "age_group").limit(1)


def top_income_group(logs: DataFrame) -> DataFrame:
    return _counted(logs, "income").orderBy(F.desc("count"), "income").limit(1)


def stats_report(logs: DataFrame, failed: DataFrame) -> DataFrame:
    """(position, metric, rows): the six results in the order of the report, the rows of each as a JSON list in order.

    The log is counted once for all results, and the counts are written. Each result then takes its own first rows: every task
    keeps as many as the result shows, so no task ranks all values of a metric.
    """
    counts = metric_values(logs).groupBy("metric", "value").agg(F.count("*").alias("count"))
    counts = materialize(counts, "metric-counts")
    flags = counts.filter("metric = 'is_banned'").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("value") == "true", F.col("count"))), F.lit(0)).alias("banned"),
    )
    failures = failed.agg(F.count("*")).scalar()
    compared = F.to_json(F.struct((F.col("total") - failures).alias("successful"), failures.alias("unsuccessful")))
    banned = F.to_json(F.struct(F.col("banned").alias("banned_requests")))

    # Name and position of each result, its column, and how many rows it shows.
    grouped = [(3, "male_vs_female", "gender", None), (4, "top_5_countries", "country", 5),
               (5, "top_age_group", "age_group", 1), (6, "top_income_group", "income", 1)]
    report = flags.select(
        F.inline(F.array(_line(1, "success_vs_failure", compared), _line(2, "banned_requests", banned)))
    )
    for position, name, column, limit in grouped:
        own = counts.filter(F.col("metric") == column)
        if limit is not None:
            own = own.orderBy(F.desc("count"), "value").limit(limit)
        row = F.to_json(F.struct(F.col("value").alias(column), "count"), {"ignoreNullFields": "false"})
        place = F.struct(-F.col("count"), F.col("value").isNotNull(), "value", row.alias("row"))
        listed = own.agg(F.array_sort(F.collect_list(place)).alias("listed"))
        rows = F.array_join(F.transform("listed", lambda x: x["row"]), ",")
        report = report.unionByName(listed.select(F.inline(F.array(_line(position, name, rows)))))
    return report


def _line(position: int, name: str, rows: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"), F.lit(name).alias("metric"), F.concat(F.lit("["), rows, F.lit("]")).alias("rows")
    )


def metric_values(logs: DataFrame) -> DataFrame:
    """(metric, value): each log row's contribution to the grouped statistics, for running counts."""
    values = {
        "gender": F.col("gender"),
        "country": F.col("country"),
        "age_group": age_group(F.col("age")),
        "income": F.col("income"),
        "is_banned": F.col("is_banned").cast("string"),
    }
    entries = [F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in values.items()]
    return logs.select(F.inline(F.array(*entries)))
