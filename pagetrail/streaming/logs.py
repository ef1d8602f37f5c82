"""Request and failure logs written while requests arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.operators.requests import build_failed_log, build_request_log, route_requests
from pagetrail.sources.sinks import by_day
from pagetrail.streaming.runs import append_to_files

LOGS = {"request_logs": build_request_log, "failed_request_logs": build_failed_log}


def log_stream(requests: DataFrame, pages: DataFrame, log: str, profile: str = "v5") -> DataFrame:
    """Rows of one of ``LOGS`` out of a request stream; ``pages`` is a table and re-read with every run."""
    return by_day(LOGS[log](route_requests(requests, pages, profile)), F.col("request_time"))


def append_logs(requests: DataFrame, pages: DataFrame, output: str, profile: str = "v5") -> None:
    """Append the rows of all requests that arrived since the last run, partitioned by day."""
    for log in LOGS:
        rows = log_stream(requests, pages, log, profile)
        append_to_files(rows, f"{output}/{log}", f"{output}/_checkpoints/{log}", partition_by="day")
