"""Registered queries over raw HTTP requests."""

from __future__ import annotations

from functools import partial

from pagetrail import adapters
from pagetrail.adapters import duckdb, existing_pages, http_requests
from pagetrail.operators import requests as ops

POD = "web-0"


def routed(spark, sf_dir, profile="v5"):
    return ops.route_requests(http_requests(spark, sf_dir), existing_pages(spark, sf_dir), profile)


def parse_headers(spark, sf_dir):
    return ops.parse_headers(http_requests(spark, sf_dir))


def route_requests(spark, sf_dir, profile="v5"):
    return routed(spark, sf_dir, profile).select("request_id", "outcome", "status", "body")


def missing_pages(spark, sf_dir):
    return ops.missing_pages(http_requests(spark, sf_dir), existing_pages(spark, sf_dir))


def audit_events(spark, sf_dir, profile="v9"):
    return ops.audit_events(routed(spark, sf_dir, profile), profile, POD)


def build_request_log(spark, sf_dir):
    return ops.build_request_log(routed(spark, sf_dir))


def build_failed_log(spark, sf_dir):
    return ops.build_failed_log(routed(spark, sf_dir))


def forbidden_events(spark, sf_dir, profile="v5"):
    return ops.forbidden_events(http_requests(spark, sf_dir), profile, POD)


def parse_forbidden_posts(spark, sf_dir):
    refused = forbidden_events(spark, sf_dir)
    return ops.parse_forbidden_posts(adapters.shaped(refused, adapters.FORBIDDEN_POST))


QUERIES = {
    f.__name__: f
    for f in (
        parse_headers, route_requests, missing_pages, audit_events, build_request_log, build_failed_log,
        forbidden_events, parse_forbidden_posts,
    )
}
for _profile in ("v3", "v4", "v8", "v9"):
    QUERIES[f"route_requests_{_profile}"] = partial(route_requests, profile=_profile)
for _profile in ("v3", "v4", "v5", "v8"):
    QUERIES[f"audit_events_{_profile}"] = partial(audit_events, profile=_profile)
for _profile in ("v3", "v4", "v8", "v9"):
    QUERIES[f"forbidden_events_{_profile}"] = partial(forbidden_events, profile=_profile)

# The embargo list, written out so that a wrong name in the operators shows.
_EMBARGO = "'North Korea', 'Iran', 'Cuba', 'Myanmar', 'Iraq', 'Libya', 'Sudan', 'Zimbabwe', 'Syria'"
_PARSED = f"""SELECT request_id, ts, method, path, COALESCE(trim(x_country), '') AS country,
    CASE WHEN ip LIKE '%,%' THEN trim(split_part(ip, ',', 1)) ELSE ip END AS client_ip,
    COALESCE(NULLIF(trim(x_gender), ''), 'Unknown') AS gender,
    CAST(trunc(TRY_CAST(trim(x_age) AS DOUBLE)) AS INT) AS age,
    COALESCE(NULLIF(trim(x_income), ''), 'Unknown') AS income,
    COALESCE(lower(trim(x_is_banned)) IN ('1', 'true', 'yes', 'y'), FALSE)
        OR COALESCE(trim(x_country), '') IN ({_EMBARGO}) AS is_banned,
    strftime(ts, '%H:%M:%S') AS time_of_day
    FROM (SELECT *, COALESCE(NULLIF(trim(x_client_ip), ''), NULLIF(trim(x_forwarded_for), ''), remote_addr, '') AS ip
          FROM http_requests)"""


def _routed(profile: str) -> str:
    """Outcome, status and body per request, spelled out per profile."""
    country = "COALESCE(x_country, '')" if profile == "v3" else "trim(COALESCE(x_country, ''))"
    name = "split_part(path, '/', -1)" if profile == "v3" else "path"
    bare = name if profile == "v3" else "CASE WHEN path LIKE 'corpus/%' THEN substr(path, 8) ELSE path END"
    embargo = f"WHEN country IN ({_EMBARGO}) THEN 'forbidden_country'"
    empty = f"WHEN {name} = '' THEN 'empty_name'"
    checks = f"{empty} {embargo}" if profile == "v5" else f"{embargo} {empty}"
    denied = 403 if profile == "v9" else 400
    return f"""SELECT *, CASE outcome WHEN 'not_implemented' THEN 501 WHEN 'empty_name' THEN 400
            WHEN 'forbidden_country' THEN {denied} WHEN 'not_found' THEN 404 ELSE 200 END AS status,
        CASE outcome WHEN 'not_implemented' THEN 'Not Implemented' WHEN 'empty_name' THEN 'No filename provided'
            WHEN 'forbidden_country' THEN 'Permission Denied' WHEN 'not_found' THEN 'Not Found' END AS body
        FROM (SELECT r.*, CASE WHEN method <> 'GET' THEN 'not_implemented' {checks}
                WHEN page NOT IN (SELECT concat(CAST(page_id AS VARCHAR), '.html') FROM pages) THEN 'not_found'
                ELSE 'ok' END AS outcome
              FROM (SELECT *, {country} AS country,
                    CASE WHEN {bare} LIKE '%.html' THEN {bare} ELSE concat({bare}, '.html') END AS page
                    FROM http_requests) r)"""


def _route(profile: str) -> str:
    return duckdb("SELECT request_id, outcome, status, body FROM routed", "http_requests", routed=_routed(profile))


def _audit(profile: str, *cases: tuple[str, str, str]) -> str:
    """cases: outcome, text of the message, severity. A missing page is shown by its completed name but in v3."""
    path = "'/' || path" if profile == "v3" else "'/' || CASE WHEN outcome = 'not_found' THEN page ELSE path END"
    message = " ".join(f"WHEN '{outcome}' THEN {text}" for outcome, text, _ in cases)
    severity = " ".join(f"WHEN '{outcome}' THEN '{level}'" for outcome, _, level in cases)
    pod = f"'{POD}'" if profile == "v9" else "CAST(NULL AS VARCHAR)"
    return duckdb(f"""SELECT request_id, outcome AS event, CASE outcome {message} END AS message, method, {path} AS path,
        CASE WHEN outcome = 'forbidden_country' THEN country END AS country, {pod} AS pod,
        CASE outcome {severity} END AS severity
        FROM routed WHERE outcome IN ({", ".join(f"'{outcome}'" for outcome, _, _ in cases)})""",
        "http_requests", routed=_routed(profile))


_FORBIDDEN_V5 = "'Forbidden: Export to ' || country || ' is prohibited. Path: /' || path"
_FORBIDDEN_V9 = f"'Forbidden export: country=' || country || ' path=/' || path || ' pod={POD}'"


def _forbidden(profile: str, message: str) -> str:
    return f"""SELECT request_id, ts, country, '/' || path AS path, {message} AS message
        FROM routed WHERE outcome = 'forbidden_country'"""


REQUEST_LOG_SQL = """SELECT p.request_id AS id, p.country, client_ip, gender, age, income, is_banned, time_of_day,
    p.path AS requested_file, p.ts AS request_time
    FROM parsed p JOIN routed r USING (request_id) WHERE outcome IN ('forbidden_country', 'not_found', 'ok')"""
FAILED_LOG_SQL = """SELECT request_id AS id, ts AS request_time, path AS requested_file, status AS error_code
    FROM routed WHERE status <> 200"""
ROUTED_CTES = {"parsed": _PARSED, "routed": _routed("v5")}
CHANNEL_SQL = duckdb(
    """SELECT request_id, ts, 'Pub/Sub' AS channel, '[FORBIDDEN ACCESS via Pub/Sub] ' || message AS line FROM refused
       UNION ALL SELECT request_id, ts, 'HTTP',
           '[FORBIDDEN ACCESS via HTTP] Country: ' || country || ', Path: ' || path FROM refused""",
    "http_requests", routed=_routed("v5"), refused=_forbidden("v5", _FORBIDDEN_V5))

ORACLE = {
    "parse_headers": duckdb(_PARSED, "http_requests"),
    "route_requests": _route("v5"),
    **{f"route_requests_{profile}": _route(profile) for profile in ("v3", "v4", "v8", "v9")},
    "missing_pages": duckdb("SELECT page, COUNT(*) AS requests FROM routed WHERE outcome = 'not_found' GROUP BY 1",
                            "http_requests", routed=_routed("v5")),
    "audit_events": _audit(
        "v9",
        ("not_implemented", "'501 Not Implemented: method=' || method || ' path=/' || path", "WARNING"),
        ("forbidden_country", _FORBIDDEN_V9, "CRITICAL"),
        ("not_found", "'404 Not Found: path=/' || page", "WARNING")),
    **{f"audit_events_{profile}": _audit(
        profile,
        ("not_implemented", "'Method ' || method || ' not implemented. Path: /' || path", "WARNING"),
        ("forbidden_country", _FORBIDDEN_V5, "CRITICAL"),
        ("not_found", "'File pages/' || page || ' not found'", "WARNING")) for profile in ("v4", "v8")},
    "audit_events_v3": _audit(
        "v3",
        ("not_implemented", "'Method ' || method || ' not implemented'", "ERROR"),
        ("not_found", "'File pages/' || page || ' not found'", "WARNING")),
    "audit_events_v5": duckdb("""SELECT request_id, 'request_timing' AS event, 'request_timing' AS message, method,
            '/' || path AS path, CASE WHEN outcome = 'forbidden_country' THEN country END AS country,
            CAST(NULL AS VARCHAR) AS pod, 'INFO' AS severity
        FROM routed WHERE outcome IN ('forbidden_country', 'not_found', 'ok')""", "http_requests", routed=_routed("v5")),
    "build_request_log": duckdb(REQUEST_LOG_SQL, "http_requests", **ROUTED_CTES),
    "build_failed_log": duckdb(FAILED_LOG_SQL, "http_requests", **ROUTED_CTES),
    "forbidden_events": duckdb(_forbidden("v5", _FORBIDDEN_V5), "http_requests", routed=_routed("v5")),
    "forbidden_events_v3": duckdb(
        _forbidden("v3", "'Forbidden: Export to ' || country || ' is prohibited.'"), "http_requests",
        routed=_routed("v3")),
    **{f"forbidden_events_{profile}": duckdb(_forbidden(profile, _FORBIDDEN_V5), "http_requests", routed=_routed(profile))
       for profile in ("v4", "v8")},
    "forbidden_events_v9": duckdb(_forbidden("v9", _FORBIDDEN_V9), "http_requests", routed=_routed("v9")),
    "parse_forbidden_posts": duckdb(
        """SELECT request_id, country, path, '[FORBIDDEN ACCESS via HTTP] Country: ' || country || ', Path: ' || path AS line
           FROM (SELECT request_id, COALESCE(json_extract_string(body, '$.country'), 'Unknown') AS country,
                        COALESCE(json_extract_string(body, '$.path'), '/') AS path FROM posts)""",
        "http_requests", routed=_routed("v5"), refused=_forbidden("v5", _FORBIDDEN_V5),
        posts="SELECT " + ", ".join(f"{sql.format()} AS {name}" for name, sql in adapters.FORBIDDEN_POST.items())
        + " FROM refused"),
}
