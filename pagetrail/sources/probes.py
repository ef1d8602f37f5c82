"""Probe results: CSV files and the client's printed log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.functions.probes import zone_label

PROBE_SCHEMA = (
    "timestamp string, request_id bigint, url string, status int, zone string, latency_ms double, error string"
)

# The printed forms of a probe and of an experiment marker.
ANSWERED = r"status=(\d+) zone=(\S*) latency_ms=([\d.]+) path=(.*)"
UNANSWERED = r"error=(\S+) latency_ms=([\d.]+) path=(.*?) detail=(.*)"
PROBE = rf"(\S+) request=(\d+) (?:{ANSWERED}|{UNANSWERED})"
MARKER = r"(MARKER_T0_STOP|MARKER_T0_START|EXPERIMENT_START|EXPERIMENT_END) (\S+)"
LINE = rf"^(?:{PROBE}|{MARKER})$"
_PARTS = ("at", "request", "status", "zone", "latency", "path", "error", "error_latency", "error_path", "detail", "marker", "marker_at")
# Stands between the parts of a matched line; in a line it counts as a blank.
_BETWEEN = "\u0001"


def probe_scan(spark: SparkSession, paths: str | list[str], streaming: bool = False) -> DataFrame:
    """Probe CSV files with typed columns; an answer without a zone is labelled ``missing``."""
    reader = spark.readStream if streaming else spark.read
    rows = reader.schema(PROBE_SCHEMA).option("header", True).csv(paths)
    return rows.select(
        F.to_timestamp("timestamp").alias("ts"),
        "request_id",
        "url",
        "status",
        F.when(F.col("status").isNotNull(), zone_label(F.col("zone"))).alias("zone"),
        "latency_ms",
        F.coalesce("error", F.lit("")).alias("error"),
    )


def parse_probe_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Printed log lines as rows of kind ``probe`` or ``marker``; other lines are left out.

    Each line is matched once, and the parts of the match become an array.
    """
    form = _BETWEEN.join(f"${i}" for i in range(1, len(_PARTS) + 1))
    parts = F.split(F.regexp_replace(F.translate(F.col(column), _BETWEEN, " "), LINE, form), _BETWEEN)
    matched = lines.select(parts.alias("parts")).filter(F.size("parts") == len(_PARTS))
    named = matched.select(*(F.nullif(F.get("parts", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(_PARTS)))
    answered = F.col("status").isNotNull()
    return named.select(
        F.when(F.col("marker").isNotNull(), F.lit("marker")).otherwise(F.lit("probe")).alias("kind"),
        F.to_timestamp(F.coalesce("at", "marker_at")).alias("ts"),
        "marker",
        F.col("request").cast("bigint").alias("request_id"),
        F.col("status").cast("int").alias("status"),
        F.when(answered, zone_label(F.col("zone"))).alias("zone"),
        F.coalesce("latency", "error_latency").cast("double").alias("latency_ms"),
        F.when(answered, F.col("path")).otherwise(F.col("error_path")).alias("path"),
        "error",
        "detail",
    )


def markers_of_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """(marker, ts) of a printed log; only its few marker lines are parsed."""
    return markers(parse_probe_log(lines.filter(F.col(column).startswith("MARKER_")), column))


def markers(parsed: DataFrame) -> DataFrame:
    return parsed.filter("kind = 'marker'").select("marker", "ts")
