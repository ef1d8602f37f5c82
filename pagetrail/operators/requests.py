"""HTTP requests: metadata, routing outcome, log rows, audit events, embargo messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetrail.functions import http
from pagetrail.functions.logs import UNKNOWN, time_of_day
from pagetrail.session import materialize

DEFAULT_BUCKET = "corpus"

NOT_IMPLEMENTED = "not_implemented"
EMPTY_NAME = "empty_name"
FORBIDDEN = "forbidden_country"
NOT_FOUND = "not_found"
OK = "ok"
RESERVED = "reserved"


@dataclass(frozen=True)
class Profile:
    """How one generation of the site decides a request."""

    embargo_status: int = 400
    strips_country: bool = True
    keeps_directories: bool = True
    empty_before_embargo: bool = False
    reserved: tuple[str, ...] = ()
    forbidden_text: str = "Forbidden: Export to {country} is prohibited. Path: /{path}"
    posts_refusals: bool = True  # over HTTP, besides the topic


# The five generations and their message texts.
PROFILES = {
    "v3": Profile(
        strips_country=False,
        keeps_directories=False,
        forbidden_text="Forbidden: Export to {country} is prohibited.",
        posts_refusals=False,
    ),
    "v4": Profile(),
    "v5": Profile(empty_before_embargo=True, reserved=("stats",)),
    "v8": Profile(reserved=("health",)),
    "v9": Profile(
        embargo_status=403,
        reserved=("health",),
        forbidden_text="Forbidden export: country={country} path=/{path} pod={pod}",
        posts_refusals=False,
    ),
}

# Response body of each outcome that does not send a page.
BODIES = {
    NOT_IMPLEMENTED: "Not Implemented",
    EMPTY_NAME: "No filename provided",
    FORBIDDEN: "Permission Denied",
    NOT_FOUND: "Not Found",
}


def fill(template: str, **values: Column) -> Column:
    """Text with ``{name}`` holes filled by columns."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        before, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        pieces += [F.lit(before), F.coalesce(values[name], F.lit(""))]
    return F.concat(*pieces, F.lit(rest))


def parse_headers(requests: DataFrame) -> DataFrame:
    """Requests (method, path, headers, remote_addr, ts, ...) with their client metadata in place of the headers."""
    kept = [name for name in requests.columns if name not in ("headers", "remote_addr")]
    first = http.first
    country = F.coalesce(first("X-country"), F.lit(""))
    return http.with_headers(requests).select(
        *kept,
        country.alias("country"),
        http.client_ip(F.col("remote_addr")).alias("client_ip"),
        F.coalesce(first("X-gender"), F.lit(UNKNOWN)).alias("gender"),
        http.age(first("X-age")).alias("age"),
        F.coalesce(first("X-income"), F.lit(UNKNOWN)).alias("income"),
        http.is_banned(country).alias("is_banned"),
        time_of_day(F.col("ts")).alias("time_of_day"),
    )


def _country(profile: Profile) -> Column:
    raw = http.raw("X-country")
    return F.coalesce(http.strip(raw) if profile.strips_country else raw, F.lit(""))


def _page(profile: Profile, bucket: str) -> Column:
    path = F.col("path")
    return http.page_of_full_path(path, bucket) if profile.keeps_directories else http.page_of_last_segment(path)


def decide(requests: DataFrame, profile: str, bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Requests with ``routed_country``, ``page`` and the ``outcome`` known before the page lookup.

    ``outcome`` is NULL where only the lookup can tell. A missing path is an empty one.
    """
    rules = PROFILES[profile]
    requests = requests.withColumn("path", F.coalesce("path", F.lit("")))
    name = F.col("path") if rules.keeps_directories else F.substring_index("path", "/", -1)
    empty = F.when(name == "", F.lit(EMPTY_NAME))
    embargo = F.when(http.is_embargoed(F.col("routed_country")), F.lit(FORBIDDEN))
    checks = [empty, embargo] if rules.empty_before_embargo else [embargo, empty]
    reserved = F.when((F.col("method") == "GET") & F.col("path").isin(*rules.reserved), F.lit(RESERVED))
    not_implemented = F.when(F.col("method") != "GET", F.lit(NOT_IMPLEMENTED))
    return (
        http.without_headers(http.with_headers(requests, ("X-country",)).withColumn("routed_country", _country(rules)))
        .withColumn("outcome", F.coalesce(*([reserved] if rules.reserved else []), not_implemented, *checks))
        .withColumn("page", F.when(F.col("outcome").isNull(), _page(rules, bucket)))
    )


def route_requests(
    requests: DataFrame, pages: DataFrame, profile: str = "v5", bucket: str = DEFAULT_BUCKET
) -> DataFrame:
    """Requests with ``outcome``, ``status`` and ``body`` (NULL where a page is sent).

    ``pages`` is (page): the names that exist; a name may repeat. Requests decided without a lookup join on keys of
    their own, which match no page and spread evenly, so they do not gather in the task of the NULL key. The names
    are written once without repeats: the join then reads both sides from plain exchanges and can split a hot page.
    """
    decided = decide(requests, profile, bucket)
    own_key = F.concat(F.lit("#"), F.col("request_id").cast("string"))
    known = materialize(pages.select(F.col("page").alias("_known")).distinct(), "page-names")
    looked_up = decided.withColumn("_key", F.coalesce("page", own_key)).join(
        known, F.col("_key") == F.col("_known"), "left"
    )
    outcome = F.coalesce("outcome", F.when(F.col("_known").isNull(), F.lit(NOT_FOUND)), F.lit(OK))
    return with_response(looked_up.withColumn("outcome", outcome).drop("_key", "_known"), profile)


def with_response(routed: DataFrame, profile: str) -> DataFrame:
    outcome = F.col("outcome")
    status = (
        F.when(outcome == NOT_IMPLEMENTED, 501)
        .when(outcome == EMPTY_NAME, 400)
        .when(outcome == FORBIDDEN, PROFILES[profile].embargo_status)
        .when(outcome == NOT_FOUND, 404)
        .otherwise(200)
    )
    body = F.when(F.lit(False), F.lit(""))
    for name, text in BODIES.items():
        body = body.when(outcome == name, F.lit(text))
    return routed.withColumn("status", status).withColumn("body", body)


def missing_pages(
    requests: DataFrame, pages: DataFrame, profile: str = "v5", bucket: str = DEFAULT_BUCKET
) -> DataFrame:
    """(page, requests): asked-for pages that do not exist.

    Requests are counted per page before the anti join, so a hot page is one row by then.
    """
    asked = decide(requests, profile, bucket).filter("page IS NOT NULL")
    return asked.groupBy("page").agg(F.count("*").alias("requests")).join(pages, "page", "left_anti")


def build_request_log(routed: DataFrame) -> DataFrame:
    """Request-log rows of the ``v5`` outcomes: all but other methods, empty names and reserved paths."""
    logged = routed.filter(F.col("outcome").isin(FORBIDDEN, NOT_FOUND, OK))
    return parse_headers(logged).select(
        F.col("request_id").alias("id"),
        "country",
        "client_ip",
        "gender",
        "age",
        "income",
        "is_banned",
        "time_of_day",
        F.col("path").alias("requested_file"),
        F.col("ts").alias("request_time"),
    )


def build_failed_log(routed: DataFrame) -> DataFrame:
    """Failure-log rows: every outcome that is not a success."""
    return routed.filter("status <> 200").select(
        F.col("request_id").alias("id"),
        F.col("ts").alias("request_time"),
        F.col("path").alias("requested_file"),
        F.col("status").alias("error_code"),
    )


def forbidden_events(requests: DataFrame, profile: str = "v5", pod: str = "", bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """(request_id, ts, country, path, message): requests refused for their country.

    Row by row and without the page lookup, so it works on streams as well.
    """
    refused = decide(requests, profile, bucket).filter(F.col("outcome") == FORBIDDEN)
    country, path = F.col("routed_country"), F.col("path")
    message = fill(PROFILES[profile].forbidden_text, country=country, path=path, pod=F.lit(pod))
    return refused.select(
        "request_id", "ts", country.alias("country"), F.concat(F.lit("/"), path).alias("path"), message.alias("message")
    )


def audit_events(routed: DataFrame, profile: str = "v9", pod: str = "") -> DataFrame:
    """(request_id, event, message, method, path, country, pod, severity): what each generation writes to its log.

    From v4 on, a name is completed (bucket left out, ending added) before the lookup, so lines about missing pages
    show the completed name; v5 logs the asked-for one. Only v9 names its pod.
    """
    outcome, page = F.col("outcome"), F.col("page")
    completed = (outcome == NOT_FOUND) if profile in ("v4", "v8", "v9") else F.lit(False)
    path = F.when(completed, page).otherwise(F.col("path"))
    values = {
        "method": F.col("method"),
        "path": path,
        "page": page,
        "country": F.col("routed_country"),
        "pod": F.lit(pod),
    }
    # Message and severity per outcome and generation.
    plain = {
        NOT_IMPLEMENTED: ("Method {method} not implemented. Path: /{path}", "WARNING"),
        FORBIDDEN: (PROFILES[profile].forbidden_text, "CRITICAL"),
        NOT_FOUND: ("File pages/{page} not found", "WARNING"),
    }
    forms = {
        "v3": {
            NOT_IMPLEMENTED: ("Method {method} not implemented", "ERROR"),
            NOT_FOUND: ("File pages/{page} not found", "WARNING"),
        },
        "v4": plain,
        "v5": dict.fromkeys((FORBIDDEN, NOT_FOUND, OK), ("request_timing", "INFO")),
        "v8": plain,
        "v9": {
            NOT_IMPLEMENTED: ("501 Not Implemented: method={method} path=/{path}", "WARNING"),
            FORBIDDEN: (PROFILES["v9"].forbidden_text, "CRITICAL"),
            NOT_FOUND: ("404 Not Found: path=/{path}", "WARNING"),
        },
    }[profile]
    message = severity = F.when(F.lit(False), F.lit(""))
    for name, (template, level) in forms.items():
        message = message.when(outcome == name, fill(template, **values))
        severity = severity.when(outcome == name, F.lit(level))
    event = F.lit("request_timing") if profile == "v5" else outcome
    return routed.filter(outcome.isin(*forms)).select(
        "request_id",
        event.alias("event"),
        message.alias("message"),
        "method",
        F.concat(F.lit("/"), path).alias("path"),
        F.when(outcome == FORBIDDEN, F.col("routed_country")).alias("country"),
        F.lit(pod if profile == "v9" else None).cast("string").alias("pod"),
        severity.alias("severity"),
    )


# Defaults and line texts of the two report channels.
POST_DEFAULTS = {"country": "Unknown", "path": "/"}
HTTP_LINE = "[FORBIDDEN ACCESS via HTTP] Country: {country}, Path: {path}"
TOPIC_LINE = "[FORBIDDEN ACCESS via Pub/Sub] {message}"


def parse_forbidden_posts(posts: DataFrame, column: str = "body") -> DataFrame:
    """JSON reports ``{country, path}`` with defaults for what is missing, plus the formatted line."""
    fields = F.from_json(F.col(column), "country string, path string", {"mode": "PERMISSIVE"})
    others = [name for name in posts.columns if name != column]
    parsed = posts.withColumn("_fields", fields).select(
        *others,
        *[F.coalesce(F.col(f"_fields.{name}"), F.lit(default)).alias(name) for name, default in POST_DEFAULTS.items()],
    )
    return parsed.withColumn("line", fill(HTTP_LINE, country=F.col("country"), path=F.col("path")))


def channel_lines(forbidden: DataFrame, profile: str = "v5") -> DataFrame:
    """(request_id, ts, channel, line): each refused request as reported over the topic and, by the profiles that do so, over HTTP."""
    channels = {"Pub/Sub": fill(TOPIC_LINE, message=F.col("message"))}
    if PROFILES[profile].posts_refusals:
        channels["HTTP"] = fill(HTTP_LINE, country=F.col("country"), path=F.col("path"))
    lines = [F.struct(F.lit(name).alias("channel"), line.alias("line")) for name, line in channels.items()]
    return forbidden.select("request_id", "ts", F.inline(F.array(*lines)))
