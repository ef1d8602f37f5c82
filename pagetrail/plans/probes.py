"""Registered queries over availability probes."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagetrail import adapters
from pagetrail.adapters import duckdb, failover_markers, probe_results, table
from pagetrail.functions.probes import probe_url, zone_of_metadata
from pagetrail.operators import probes as ops
from pagetrail.session import scratch_path
from pagetrail.sources import probes as sources

WALL_CLOCK = "timestamp_ntz"


def probe_scan(spark, sf_dir):
    folder = scratch_path(spark, "probe-csv")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    url = F.lit("http://lb/health").alias("url")
    rows = probe_results(spark, sf_dir).select(stamp, "request_id", url, "status", "zone", "latency_ms", "error")
    rows.write.option("header", True).csv(folder)
    return sources.probe_scan(spark, folder).withColumn("ts", F.col("ts").cast(WALL_CLOCK))


def _log_lines(spark, sf_dir):
    folder = scratch_path(spark, "probe-log")
    adapters.probe_log_lines(spark, sf_dir).write.text(folder)
    return spark.read.text(folder)


def _parsed(lines):
    return sources.parse_probe_log(lines).withColumn("ts", F.col("ts").cast(WALL_CLOCK))


def parse_probe_log(spark, sf_dir):
    return _parsed(_log_lines(spark, sf_dir))


def probe_summary(spark, sf_dir):
    return ops.probe_summary(probe_results(spark, sf_dir))


def zone_distribution(spark, sf_dir):
    return ops.zone_distribution(probe_results(spark, sf_dir)).withColumn("ratio", F.round("ratio", 9))


def error_counts(spark, sf_dir):
    return ops.error_counts(probe_results(spark, sf_dir))


def zone_timeline(spark, sf_dir):
    return ops.zone_timeline(probe_results(spark, sf_dir))


def failover_phases(spark, sf_dir):
    """Phases of the printed log, whose markers are among its lines."""
    lines = _log_lines(spark, sf_dir)
    marked = sources.markers_of_log(lines).withColumn("ts", F.col("ts").cast(WALL_CLOCK))
    return ops.failover_phases(_parsed(lines).filter("kind = 'probe'"), marked)


def failover_markers_join(spark, sf_dir):
    return ops.failover_phases(probe_results(spark, sf_dir), failover_markers(spark))


def timing_summary(spark, sf_dir):
    timings = table(spark, sf_dir, "events").select(F.col("event_type").alias("phase"), F.col("value").alias("seconds"))
    rounded = [F.round(name, 6).alias(name) for name in ("mean", "p50", "p95")]
    return ops.timing_summary(timings).select("phase", "n", "max", *rounded)


def normalize_probe_url(spark, sf_dir):
    targets = adapters.shaped(table(spark, sf_dir, "pages"), adapters.PROBE_TARGET)
    return targets.select("page_id", probe_url(F.col("server"), F.col("path")).alias("url"))


def metadata_zones(spark, sf_dir):
    """Requests per zone of the instance that answers them, from the instance's metadata path."""
    user, regions = F.col("user_id").cast("string"), F.array(*map(F.lit, ("west1-a", "west1-b", "east4-c")))
    named = F.concat(F.lit("projects/"), user, F.lit("/zones/us-"), F.get(regions, (F.col("user_id") % 3).cast("int")), F.lit(" "))
    zone = F.when(F.col("user_id") % 5 == 4, F.lit(None)).when(F.col("user_id") % 5 == 3, F.lit("projects/zones/")).otherwise(named)
    return table(spark, sf_dir, "events").groupBy(zone_of_metadata(zone).alias("zone")).agg(F.count("*").alias("requests"))


QUERIES = {
    f.__name__: f
    for f in (
        probe_scan, parse_probe_log, probe_summary, zone_distribution, error_counts, zone_timeline, failover_phases,
        timing_summary, normalize_probe_url, metadata_zones,
    )
}
QUERIES["failover_phases_table"] = failover_markers_join

_PHASE = f"""CASE WHEN ts < TIMESTAMP '{adapters.STOP}' THEN 'before' WHEN ts < TIMESTAMP '{adapters.START}' THEN 'down'
    ELSE 'restored' END"""


def _phases(source: str) -> str:
    return f"""SELECT {_PHASE} AS phase, zone, COUNT(*) AS requests, COUNT(*) FILTER (status < 400) AS successes
        FROM {source} WHERE status IS NOT NULL GROUP BY 1, 2"""


TIMELINE_SQL = duckdb(
    """SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start, zone, COUNT(*) AS requests,
       COUNT(*) FILTER (status < 400) AS successes FROM probe_results WHERE status IS NOT NULL GROUP BY 1, 2""",
    "probe_results")

ORACLE = {
    "probe_scan": duckdb(
        """SELECT date_trunc('second', ts) AS ts, request_id, 'http://lb/health' AS url, status,
           CASE WHEN status IS NOT NULL THEN zone END AS zone, latency_ms, error FROM probe_results""", "probe_results"),
    "parse_probe_log": duckdb(
        f"""SELECT 'probe' AS kind, date_trunc('second', ts) AS ts, CAST(NULL AS VARCHAR) AS marker, request_id, status,
              CASE WHEN status IS NOT NULL THEN zone END AS zone, latency_ms,
              'health' AS path, CASE WHEN status IS NULL THEN 'URLError' END AS error,
              CASE WHEN status IS NULL THEN 'timed out' END AS detail FROM probe_results
            UNION ALL SELECT 'marker', m.ts, m.marker, NULL, NULL, NULL, NULL, NULL, NULL, NULL
            FROM (VALUES ('MARKER_T0_STOP', TIMESTAMP '{adapters.STOP}'),
                         ('MARKER_T0_START', TIMESTAMP '{adapters.START}')) m(marker, ts)""", "probe_results"),
    "probe_summary": duckdb(
        """SELECT COUNT(*) AS total_requests, COUNT(*) FILTER (status < 400) AS successes,
           COUNT(*) FILTER (status IS NULL OR status >= 400) AS failures FROM probe_results""", "probe_results"),
    "zone_distribution": duckdb(
        """SELECT zone, COUNT(*) AS requests, ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 9) AS ratio
           FROM probe_results WHERE status < 400 GROUP BY 1""", "probe_results"),
    "error_counts": duckdb(
        """SELECT CASE WHEN status >= 400 THEN 'http_' || status ELSE split_part(error, ':', 1) END AS error,
           COUNT(*) AS failures FROM probe_results WHERE status IS NULL OR status >= 400 GROUP BY 1""", "probe_results"),
    "zone_timeline": TIMELINE_SQL,
    "failover_phases": duckdb(_phases("(SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM probe_results)"),
                              "probe_results"),
    "failover_phases_table": duckdb(_phases("probe_results"), "probe_results"),
    "timing_summary": """SELECT event_type AS phase, COUNT(*) AS n, MAX(value) AS max, ROUND(AVG(value), 6) AS mean,
        ROUND(quantile_cont(value, 0.5), 6) AS p50, ROUND(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1""",
    "normalize_probe_url": duckdb(
        r"""SELECT page_id, rtrim(CASE WHEN regexp_matches(server, '^https?://') THEN server ELSE 'http://' || server END, '/')
            || '/' || ltrim(trim(path), '/') AS url FROM probe_targets""", "probe_targets"),
    "metadata_zones": """SELECT CASE WHEN user_id % 5 >= 3 THEN 'unknown' WHEN user_id % 3 = 0 THEN 'us-west1-a'
        WHEN user_id % 3 = 1 THEN 'us-west1-b' ELSE 'us-east4-c' END AS zone, COUNT(*) AS requests FROM events GROUP BY 1""",
}
