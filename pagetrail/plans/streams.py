"""Registered streaming queries: everything available is processed, then the result is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagetrail import adapters
from pagetrail.adapters import duckdb, existing_pages, table
from pagetrail.operators.probes import zone_timeline
from pagetrail.operators.requests import forbidden_events
from pagetrail.plans.probes import WALL_CLOCK
from pagetrail.plans.requests import (
    _FORBIDDEN_V5, CHANNEL_SQL, FAILED_LOG_SQL, REQUEST_LOG_SQL, ROUTED_CTES, _forbidden, _routed,
)
from pagetrail.plans.stats import AGE_GROUP_SQL
from pagetrail.session import scratch_path
from pagetrail.sources import messages
from pagetrail.streaming import consumer, forbidden, logs, runs, stats


def _event_stream(spark, sf_dir):
    # a pattern: streaming sources take folders or patterns, not single files
    return runs.read_arrivals(spark, f"{sf_dir}/events.parque[t]", table(spark, sf_dir, "events").schema)


def forbidden_stream(spark, sf_dir):
    requests = adapters.as_http_requests(_event_stream(spark, sf_dir))
    return runs.appended(forbidden.forbidden_stream(requests), "forbidden")


def forbidden_stream_v3(spark, sf_dir):
    """The first generation reports over the topic only."""
    requests = adapters.as_http_requests(_event_stream(spark, sf_dir))
    return runs.appended(forbidden.forbidden_stream(requests, "v3"), "forbidden-v3")


def _logged(spark, sf_dir, log):
    requests = adapters.as_http_requests(_event_stream(spark, sf_dir))
    rows = logs.log_stream(requests, existing_pages(spark, sf_dir), log)
    return runs.appended(rows, log.replace("_", "-")).drop("day")


def request_log_stream(spark, sf_dir):
    return _logged(spark, sf_dir, "request_logs")


def failed_log_stream(spark, sf_dir):
    return _logged(spark, sf_dir, "failed_request_logs")


def stats_stream(spark, sf_dir):
    path, checkpoint = scratch_path(spark, "stats-counts"), scratch_path(spark, "stats-checkpoint")
    stats.keep_counts(adapters.as_request_logs(_event_stream(spark, sf_dir)), path, checkpoint)
    return stats.current_counts(spark, path)


def zone_timeline_stream(spark, sf_dir):
    """Windows that are over: their end lies at least a minute before the last answered probe."""
    probes = adapters.as_probe_results(_event_stream(spark, sf_dir)).withColumn("ts", F.col("ts").cast("timestamp"))
    closed = runs.appended(zone_timeline(probes, watermark="1 minute"), "timeline")
    return closed.withColumn("window_start", F.col("window_start").cast(WALL_CLOCK))


def redelivery_stream(spark, sf_dir):
    """Messages of refused requests, each delivered twice, kept once."""
    requests = adapters.as_http_requests(_event_stream(spark, sf_dir))
    moment = F.col("ts").cast("timestamp").alias("ts")
    refused = forbidden_events(requests).select("request_id", moment, F.encode("message", "UTF-8").alias("value"))
    delivered = refused.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")
    received = forbidden.received_messages(delivered)
    once = runs.appended(forbidden.drop_redelivered(received, "request_id", "ts", "1 minute"), "messages")
    return once.withColumn("ts", F.col("ts").cast(WALL_CLOCK))


def message_consumer(spark, sf_dir):
    """Messages of refused requests from a queue. The consumer is stopped after the first published part and started again."""
    queue, output, checkpoint = (scratch_path(spark, f"queue-{name}") for name in ("messages", "output", "checkpoint"))
    refused = forbidden_events(adapters.as_http_requests(table(spark, sf_dir, "events")))
    sent = refused.select(
        F.col("request_id").alias("message_id"), F.col("ts").cast("timestamp").alias("published"),
        F.encode("message", "UTF-8").alias("value"),
    )
    for part in (0, 1):
        messages.publish(sent.filter(F.col("message_id") % 2 == part), queue)
        consumer.consume(spark, queue, output, checkpoint)
    return consumer.consumed(spark, output).withColumn("published", F.col("published").cast(WALL_CLOCK))


QUERIES = {
    f.__name__: f
    for f in (forbidden_stream, forbidden_stream_v3, request_log_stream, failed_log_stream, stats_stream, zone_timeline_stream,
              redelivery_stream, message_consumer)
}


def _count(metric: str, value: str) -> str:
    return f"SELECT '{metric}' AS metric, {value} AS value, COUNT(*) AS count FROM request_logs GROUP BY 1, 2"


ORACLE = {
    "forbidden_stream": CHANNEL_SQL,
    "forbidden_stream_v3": duckdb(
        f"""SELECT request_id, ts, 'Pub/Sub' AS channel, '[FORBIDDEN ACCESS via Pub/Sub] ' || message AS line
            FROM ({_forbidden('v3', "'Forbidden: Export to ' || country || ' is prohibited.'")})""", "http_requests", routed=_routed("v3")),
    "request_log_stream": duckdb(REQUEST_LOG_SQL, "http_requests", **ROUTED_CTES),
    "failed_log_stream": duckdb(FAILED_LOG_SQL, "http_requests", **ROUTED_CTES),
    "stats_stream": duckdb(
        " UNION ALL ".join([
            _count("gender", "gender"), _count("country", "country"), _count("age_group", AGE_GROUP_SQL),
            _count("income", "income"), _count("is_banned", "CAST(is_banned AS VARCHAR)"),
        ]), "request_logs"),
    "zone_timeline_stream": duckdb(
        """SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start, zone, COUNT(*) AS requests,
           COUNT(*) FILTER (status < 400) AS successes FROM probe_results WHERE status IS NOT NULL GROUP BY 1, 2
           HAVING time_bucket(INTERVAL '10 seconds', min(ts)) + INTERVAL '10 seconds'
                  <= (SELECT max(ts) - INTERVAL '1 minute' FROM probe_results WHERE status IS NOT NULL)""",
        "probe_results"),
    "redelivery_stream": duckdb(
        f"SELECT request_id, ts, message AS value FROM ({_forbidden('v5', _FORBIDDEN_V5)})", "http_requests",
        routed=_routed("v5")),
    "message_consumer": duckdb(
        f"SELECT request_id AS message_id, ts AS published, message AS value FROM ({_forbidden('v5', _FORBIDDEN_V5)})", "http_requests",
        routed=_routed("v5")),
}
