"""The driver's tables in the shapes the operators take.

This is the only module that knows the driver's tables. Expressions are plain SQL and shared with the DuckDB side of
the checks; where the dialects differ, both forms stand here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "corpus"

# Request log rows out of events; {tod} is the dialect's HH:MM:SS of ts.
REQUEST_LOG = {
    "id": "event_id",
    "country": "CASE user_id % 7 WHEN 0 THEN 'Iran' WHEN 1 THEN 'Germany' WHEN 2 THEN '' WHEN 3 THEN 'France' "
    "WHEN 4 THEN 'Cuba' WHEN 5 THEN 'Brazil' ELSE 'Japan' END",
    "client_ip": "CASE WHEN user_id % 50 = 49 THEN '' ELSE concat('10.0.', "
    "CAST(CAST(floor((user_id % 120) / 64.0) AS BIGINT) AS VARCHAR(20)), '.', "
    "CAST((user_id % 120) % 64 AS VARCHAR(20))) END",
    "gender": "CASE user_id % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE '' END",
    "age": "CASE WHEN user_id % 11 = 0 THEN NULL ELSE CAST(10 + (user_id * 7) % 65 AS INT) END",
    "income": "CASE user_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'Unknown' END",
    "is_banned": "user_id % 7 IN (0, 4)",
    "time_of_day": "{tod}",
    "requested_file": "concat(CAST(event_id % 100 AS VARCHAR(20)), '.html')",
    "request_time": "ts",
}

# Raw requests out of events; headers still one column each.
HTTP_REQUEST = {
    "request_id": "event_id",
    "ts": "ts",
    "method": "CASE event_id % 13 WHEN 0 THEN 'POST' WHEN 1 THEN 'DELETE' ELSE 'GET' END",
    "path": "CASE event_id % 19 WHEN 0 THEN '' "
    "WHEN 1 THEN concat('corpus/', CAST(event_id % 400 AS VARCHAR(20)), '.html') WHEN 2 THEN 'no-such-file' "
    "WHEN 3 THEN concat(CAST(event_id % 400 AS VARCHAR(20)), '.html') "
    "ELSE CAST(event_id % 400 AS VARCHAR(20)) END",
    "x_country": "CASE user_id % 7 WHEN 0 THEN ' Iran ' WHEN 1 THEN 'Germany' WHEN 2 THEN NULL WHEN 3 THEN 'France' "
    "WHEN 4 THEN 'Cuba' WHEN 5 THEN 'iran' ELSE 'Japan' END",
    "x_client_ip": "CASE user_id % 4 WHEN 0 THEN NULL "
    "WHEN 1 THEN concat('10.0.0.', CAST(user_id % 64 AS VARCHAR(20)), ', 172.16.0.1') "
    "ELSE concat('10.0.1.', CAST(user_id % 64 AS VARCHAR(20))) END",
    "x_forwarded_for": "CASE event_id % 3 WHEN 0 THEN '203.0.113.9 , 10.0.0.1' WHEN 1 THEN '  ' ELSE NULL END",
    "x_gender": "CASE user_id % 3 WHEN 0 THEN 'Male' WHEN 1 THEN ' Female ' ELSE ' ' END",
    "x_age": "CASE event_id % 6 WHEN 0 THEN '12.9' WHEN 1 THEN 'abc' WHEN 2 THEN '' WHEN 3 THEN '41' "
    "WHEN 4 THEN ' 67 ' ELSE NULL END",
    "x_income": "CASE user_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE NULL END",
    "x_is_banned": "CASE event_id % 5 WHEN 0 THEN 'YES' WHEN 1 THEN '0' WHEN 2 THEN 'true' ELSE NULL END",
    "remote_addr": "'192.0.2.1'",
}
HEADERS = {
    "X-Country": "x_country",
    "x-client-ip": "x_client_ip",
    "X-Forwarded-For": "x_forwarded_for",
    "X-gender": "x_gender",
    "X-AGE": "x_age",
    "X-income": "x_income",
    "X-Is-Banned": "x_is_banned",
}

PROBE = {
    "request_id": "event_id",
    "ts": "ts",
    "status": "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN NULL WHEN event_type = 'error' THEN 503 "
    "ELSE 200 END",
    "zone": "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '' WHEN event_id % 2 = 0 "
    "OR (ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00') THEN 'zone-a' "
    "ELSE 'zone-b' END",
    "latency_ms": "value",
    "error": "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'URLError: timed out' ELSE '' END",
}
STOP, START = "2024-01-10 00:00:00", "2024-01-15 00:00:00"

# Probe targets out of pages.url: with scheme, without, with trailing slashes.
PROBE_TARGET = {
    "page_id": "page_id",
    "server": "CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^https?://', '') "
    "ELSE concat(url, '//') END",
    "path": "CASE page_id % 4 WHEN 0 THEN concat('//', CAST(page_id AS VARCHAR(20)), '.html ') WHEN 1 THEN '' "
    "WHEN 2 THEN ' /a/b.html' ELSE 'index.html' END",
}

FORBIDDEN_POST = {
    "request_id": "request_id",
    "body": "CASE request_id % 4 WHEN 0 THEN concat('{{\"country\":\"', country, '\",\"path\":\"', path, '\"}}') "
    "WHEN 1 THEN concat('{{\"country\":\"', country, '\"}}') "
    "WHEN 2 THEN concat('{{\"path\":\"', path, '\"}}') ELSE '{{}}' END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shaped(rows: DataFrame, shape: dict[str, str], **holes: str) -> DataFrame:
    return rows.selectExpr(*[f"{text.format(**holes)} AS {name}" for name, text in shape.items()])


def as_request_logs(events: DataFrame) -> DataFrame:
    return shaped(events, REQUEST_LOG, tod="date_format(ts, 'HH:mm:ss')")


def as_http_requests(events: DataFrame) -> DataFrame:
    flat = shaped(events, HTTP_REQUEST)
    entries = F.create_map(*[part for name, column in HEADERS.items() for part in (F.lit(name), F.col(column))])
    return flat.select("request_id", "ts", "method", "path", entries.alias("headers"), "remote_addr")


def as_probe_results(events: DataFrame) -> DataFrame:
    return shaped(events, PROBE)


def request_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_request_logs(table(spark, sf_dir, "events"))


def http_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_http_requests(table(spark, sf_dir, "events"))


def probe_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_probe_results(table(spark, sf_dir, "events"))


def existing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("page"))


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, file_id, content): the driver's pages with links to other pages appended."""
    pages = table(spark, sf_dir, "pages")
    total = pages.agg(F.count("*")).scalar()
    link = "i -> concat('<a HREF=\"', CAST((page_id * 7 + i * i * 13) % n AS STRING), '.html\"> This is a link </a>')"
    return pages.withColumn("n", total).selectExpr(
        "concat(CAST(page_id AS STRING), '.html') AS path",
        "page_id AS file_id",
        f"concat(coalesce(html, ''), array_join(transform(sequence(0, CAST(page_id % 6 AS INT)), {link}), ' ')) AS content",
    )


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst, mult): a multigraph over parts, one link per line item."""
    total = table(spark, sf_dir, "part").agg(F.count("*")).scalar()
    links = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % total).alias("src"), F.col("l_partkey").alias("dst")
    )
    return links.groupBy("src", "dst").agg(F.count("*").alias("mult"))


def failover_markers(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"SELECT marker, ts FROM VALUES ('MARKER_T0_STOP', TIMESTAMP_NTZ '{STOP}'), "
        f"('MARKER_T0_START', TIMESTAMP_NTZ '{START}') AS m(marker, ts)"
    )


def probe_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): the probes as printed lines, with the two markers among them."""
    probes = probe_results(spark, sf_dir)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    head = F.concat(stamp, F.lit(" request="), F.col("request_id").cast("string"))
    tail = F.concat(F.lit(" latency_ms="), F.col("latency_ms").cast("string"), F.lit(" path=health"))
    answered = F.concat(
        head, F.lit(" status="), F.col("status").cast("string"), F.lit(" zone="), F.col("zone"), tail
    )
    failed = F.concat(head, F.lit(" error=URLError"), tail, F.lit(" detail=timed out"))
    lines = probes.select(F.when(F.col("status").isNull(), failed).otherwise(answered).alias("value"))
    marks = failover_markers(spark).select(
        F.concat_ws(" ", "marker", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("value")
    )
    return lines.unionByName(marks)


# --- DuckDB forms ---------------------------------------------------------------------------------------------


def _select(shape: dict[str, str], source: str, **holes: str) -> str:
    columns = ", ".join(f"{text.format(**holes)} AS {name}" for name, text in shape.items())
    return f"SELECT {columns} FROM {source}"


DUCKDB_CTES = {
    "request_logs": _select(REQUEST_LOG, "events", tod="strftime(ts, '%H:%M:%S')"),
    "http_requests": _select(HTTP_REQUEST, "events"),
    "probe_results": _select(PROBE, "events"),
    "probe_targets": _select(PROBE_TARGET, "pages"),
    "web_pages": """SELECT concat(CAST(page_id AS VARCHAR), '.html') AS path, page_id AS file_id,
        concat(html, array_to_string(list_transform(range(0, page_id % 6 + 1), lambda i:
            concat('<a HREF="', CAST((page_id * 7 + i * i * 13) % n AS VARCHAR), '.html"> This is a link </a>')), ' '))
            AS content
        FROM pages CROSS JOIN (SELECT COUNT(*) AS n FROM pages) c""",
    "graph_nodes": "SELECT p_partkey AS node FROM part",
    "graph_edges": """SELECT l_orderkey % n AS src, l_partkey AS dst, COUNT(*) AS mult
        FROM lineitem CROSS JOIN (SELECT COUNT(*) AS n FROM part) c GROUP BY 1, 2""",
}


def duckdb(sql: str, *ctes: str, **extra: str) -> str:
    """``sql`` behind the named adapter CTEs and the ``extra`` ones, in that order."""
    parts = [f"{name} AS ({DUCKDB_CTES[name]})" for name in ctes] + [f"{name} AS ({body})" for name, body in extra.items()]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql
