from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagetrail.functions import http
from pagetrail.operators import requests as ops

SCHEMA = "request_id long, ts timestamp, method string, path string, headers map<string,string>, remote_addr string"
NOW = datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([("1.html",), ("2.html",)], "page string")


def requests(spark, *items):
    rows = [(i, NOW, method, path, headers, "192.0.2.1") for i, (method, path, headers) in enumerate(items)]
    return spark.createDataFrame(rows, SCHEMA)


def outcomes(spark, pages, profile, *items):
    routed = ops.route_requests(requests(spark, *items), pages, profile).orderBy("request_id")
    return [(row.status, row.outcome) for row in routed.collect()]


CASES = [
    ("POST", "1", {"X-country": "Iran"}),
    ("GET", "", {"X-country": "Cuba"}),
    ("GET", "", {}),
    ("GET", "1", {"X-country": " Iran "}),
    ("GET", "1", {"X-country": "iran"}),
    ("GET", "1", {"X-country": "Iran"}),
    ("GET", "corpus/2.html", {}),
    ("GET", "deep/1", {}),
    ("GET", "9", {}),
]

REFUSED, EMPTY, OK, MISSING, OTHER = (
    (400, "forbidden_country"), (400, "empty_name"), (200, "ok"), (404, "not_found"), (501, "not_implemented"),
)


@pytest.mark.parametrize(
    ("profile", "expected"),
    [
        ("v5", [OTHER, EMPTY, EMPTY, REFUSED, OK, REFUSED, OK, MISSING, MISSING]),
        ("v4", [OTHER, REFUSED, EMPTY, REFUSED, OK, REFUSED, OK, MISSING, MISSING]),
        ("v8", [OTHER, REFUSED, EMPTY, REFUSED, OK, REFUSED, OK, MISSING, MISSING]),
        ("v3", [OTHER, REFUSED, EMPTY, OK, OK, REFUSED, OK, OK, MISSING]),
        ("v9", [OTHER, (403, REFUSED[1]), EMPTY, (403, REFUSED[1]), OK, (403, REFUSED[1]), OK, MISSING, MISSING]),
    ],
)
def test_profiles(spark, pages, profile, expected):
    assert outcomes(spark, pages, profile, *CASES) == expected


def test_reserved_paths(spark, pages):
    health = ("GET", "health", {"X-country": "Iran"})
    assert outcomes(spark, pages, "v8", health) == [(200, "reserved")]
    assert outcomes(spark, pages, "v9", ("POST", "health", {})) == [OTHER]
    assert outcomes(spark, pages, "v4", ("GET", "health", {})) == [MISSING]
    assert outcomes(spark, pages, "v5", ("GET", "stats", {})) == [(200, "reserved")]


def test_headers(spark):
    items = [
        ("GET", "1", {"x-COUNTRY": " Peru ", "X-forwarded-for": "10.0.0.1 , 10.0.0.2", "X-client-ip": " ", "X-banned": "Y"}),
        ("GET", "1", {"X-Gender": "\tFemale ", "X-age": "12.9", "X-is-banned": "0", "X-banned": "1"}),
        ("GET", "1", {"X-country": "Syria", "X-client-ip": "10.1.1.1"}),
    ]
    parsed = ops.parse_headers(requests(spark, *items)).orderBy("request_id").collect()
    assert [(r.country, r.client_ip, r.gender, r.age, r.income, r.is_banned) for r in parsed] == [
        ("Peru", "10.0.0.1", "Unknown", None, "Unknown", True),
        ("", "192.0.2.1", "Female", 12, "Unknown", False),
        ("Syria", "10.1.1.1", "Unknown", None, "Unknown", True),
    ]
    assert parsed[0].time_of_day == "03:04:05"


def test_age(spark):
    texts = ["12.9", "abc", "", " 67 ", "-3.7", "1_0", "1e2", "inf", "nan", "12f", "0x10", ".5", "5.", "1e400", "99999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(http.age(http.strip(F.col("t"))).alias("age"))
    assert [row.age for row in df.collect()] == [12, None, None, 67, -3, 10, 100, None, None, None, None, 0, 5, None, None]


def test_log_fan_out(spark, pages, rows):
    routed = ops.route_requests(requests(spark, *CASES), pages)
    assert rows(ops.build_request_log(routed), "id") == [(3,), (4,), (5,), (6,), (7,), (8,)]
    assert rows(ops.build_failed_log(routed), "id", "error_code") == [
        (0, 501), (1, 400), (2, 400), (3, 400), (5, 400), (7, 404), (8, 404),
    ]
    assert ops.build_request_log(routed).filter("id = 6").first().requested_file == "corpus/2.html"


def test_missing_pages(spark, pages, rows):
    assert rows(ops.missing_pages(requests(spark, *CASES, ("GET", "9", {})), pages)) == [("9.html", 2), ("deep/1.html", 1)]


def test_forbidden_messages(spark, rows):
    refused = requests(spark, ("GET", "a/1", {"X-country": "Cuba"}))
    texts = {p: ops.forbidden_events(refused, p, "pod-1").first().message for p in ("v3", "v5", "v9")}
    assert texts == {
        "v3": "Forbidden: Export to Cuba is prohibited.",
        "v5": "Forbidden: Export to Cuba is prohibited. Path: /a/1",
        "v9": "Forbidden export: country=Cuba path=/a/1 pod=pod-1",
    }


def test_audit_events(spark, pages, rows):
    routed = ops.route_requests(requests(spark, *CASES[:1], *CASES[5:6], *CASES[8:]), pages, "v9")
    assert rows(ops.audit_events(routed, "v9", "w"), "event", "severity", "message") == [
        ("forbidden_country", "CRITICAL", "Forbidden export: country=Iran path=/1 pod=w"),
        ("not_found", "WARNING", "404 Not Found: path=/9.html"),
        ("not_implemented", "WARNING", "501 Not Implemented: method=POST path=/1"),
    ]
    old = ops.route_requests(requests(spark, *CASES[:1]), pages, "v3")
    assert rows(ops.audit_events(old, "v3"), "severity", "message") == [("ERROR", "Method POST not implemented")]


def test_posts(spark, rows):
    bodies = ['{"country":"Iran","path":"/x"}', '{"country":"Cuba"}', "{}", "not json", None]
    posts = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "request_id long, body string")
    assert rows(ops.parse_forbidden_posts(posts), "request_id", "line") == [
        (0, "[FORBIDDEN ACCESS via HTTP] Country: Iran, Path: /x"),
        (1, "[FORBIDDEN ACCESS via HTTP] Country: Cuba, Path: /"),
        (2, "[FORBIDDEN ACCESS via HTTP] Country: Unknown, Path: /"),
        (3, "[FORBIDDEN ACCESS via HTTP] Country: Unknown, Path: /"),
        (4, "[FORBIDDEN ACCESS via HTTP] Country: Unknown, Path: /"),
    ]


def test_missing_paths_and_repeated_page_names(spark, pages):
    twice = pages.unionByName(pages)
    assert outcomes(spark, twice, "v5", ("GET", None, {}), ("GET", "1", {}), ("GET", None, {"X-country": "Cuba"})) == [EMPTY, OK, EMPTY]


@pytest.mark.parametrize(
    ("profile", "message", "path"),
    [
        ("v3", "File pages/9.html not found", "/corpus/9"),
        ("v4", "File pages/9.html not found", "/9.html"),
        ("v5", "request_timing", "/corpus/9"),
        ("v8", "File pages/9.html not found", "/9.html"),
        ("v9", "404 Not Found: path=/9.html", "/9.html"),
    ],
)
def test_missing_pages_are_reported_by_their_completed_name(spark, pages, profile, message, path):
    routed = ops.route_requests(requests(spark, ("GET", "corpus/9", {})), pages, profile)
    found = ops.audit_events(routed, profile, "pod-1").first()
    assert (found.message, found.path, found.pod) == (message, path, "pod-1" if profile == "v9" else None)
