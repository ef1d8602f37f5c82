from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pagetrail import jobs
from pagetrail.functions.probes import probe_url, zone_of_metadata
from pagetrail.operators import probes as ops
from pagetrail.operators.intervals import consecutive, interval_join
from pagetrail.sources.probes import markers, parse_probe_log, probe_scan

LOG = """EXPERIMENT_START 2024-01-01T00:00:00.000001+00:00
2024-01-01T00:00:01+00:00 request=1 status=200 zone=zone-a latency_ms=3.5 path=health
2024-01-01T00:00:02+00:00 request=2 status=200 zone=zone-b latency_ms=4.5 path=health
some other output
MARKER_T0_STOP 2024-01-01T00:00:03+00:00
2024-01-01T00:00:04+00:00 request=3 status=503 zone=missing latency_ms=1.0 path=health
2024-01-01T00:00:05+00:00 request=4 error=URLError latency_ms=9.0 path=health detail=<urlopen error timed out>
2024-01-01T00:00:06+00:00 request=5 status=200 zone=zone-a latency_ms=2.0 path=health
MARKER_T0_START 2024-01-01T00:00:07+00:00
2024-01-01T00:00:08+00:00 request=6 status=200 zone=zone-a latency_ms=2.0 path=health"""


@pytest.fixture(scope="module")
def parsed(spark):
    return parse_probe_log(spark.createDataFrame([(line,) for line in LOG.splitlines()], "value string"))


def test_log_lines(parsed, rows):
    probes = parsed.filter("kind = 'probe'")
    assert probes.count() == 6 and markers(parsed).count() == 3
    failed = probes.filter("request_id = 4").first()
    assert (failed.status, failed.error, failed.detail, failed.latency_ms) == (None, "URLError", "<urlopen error timed out>", 9.0)
    assert rows(ops.probe_summary(probes)) == [(6, 4, 2)]
    assert rows(ops.zone_distribution(probes)) == [("zone-a", 3, 0.75), ("zone-b", 1, 0.25)]
    assert rows(ops.error_counts(probes)) == [("URLError", 1), ("http_503", 1)]


def test_phases(parsed, rows):
    phases = ops.failover_phases(parsed.filter("kind = 'probe'"), markers(parsed))
    assert rows(phases) == [
        ("before", "zone-a", 1, 1), ("before", "zone-b", 1, 1), ("down", "missing", 1, 0), ("down", "zone-a", 1, 1),
        ("restored", "zone-a", 1, 1),
    ]


@pytest.mark.parametrize(
    ("events", "expected"),
    [
        ([], "bbbbbbbb"),
        ([(2, "START")], "bbbbbbbb"),
        ([(2, "STOP")], "bbdddddd"),
        ([(2, "STOP"), (4, "START")], "bbddrrrr"),
        ([(1, "STOP"), (3, "START"), (5, "STOP"), (6, "START")], "bddrrdrr"),
        ([(1, "STOP"), (2, "STOP"), (4, "START")], "bdddrrrr"),
    ],
)
def test_phases_of_any_number_of_outages(spark, events, expected):
    start = datetime(2024, 1, 1)
    probes = spark.createDataFrame([(i, start + timedelta(seconds=i)) for i in range(8)], "request_id int, ts timestamp")
    marks = [(f"MARKER_T0_{kind}", start + timedelta(seconds=i)) for i, kind in events] + [("EXPERIMENT_START", start)]
    found = ops.with_phase(probes, spark.createDataFrame(marks, "marker string, ts timestamp")).orderBy("request_id")
    assert "".join(r.phase[0] for r in found.collect()) == expected


def test_a_hundred_thousand_intervals(spark):
    """Markers every second, probes at every half: found by an equi-join on buckets, without a list of all markers."""
    kind = F.when(F.col("id") % 2 == 0, "MARKER_T0_STOP").otherwise("MARKER_T0_START").alias("marker")
    marks = spark.range(100_000).select(kind, F.timestamp_seconds("id").alias("ts"))
    probes = spark.range(-1000, 100_500).select("id", F.timestamp_micros(F.col("id") * 1_000_000 + 500_000).alias("ts"))
    probes = probes.unionByName(spark.createDataFrame([(-5000, None)], "id long, ts timestamp"))
    found = ops.with_phase(probes, marks)
    expected = F.when(F.col("ts").isNull(), F.lit(None)).when(F.col("id") < 0, "before").when(
        (F.col("id") % 2 == 0) & (F.col("id") < 99_999), "down").otherwise("restored")
    assert found.filter(~F.col("phase").eqNullSafe(expected)).isEmpty() and found.count() == 101_501
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "NestedLoop" not in plan and "Join" in plan


def test_interval_join_equals_brute_force(spark, rows):
    import random

    r = random.Random(3)
    start = datetime(2024, 1, 1)
    spans = [(i, a := r.randrange(1000), a + r.choice([0, 1, 5, 400, -3])) for i in range(60)]
    at = lambda s: start + timedelta(seconds=s)
    intervals = spark.createDataFrame([(i, at(a), at(b)) for i, a, b in spans] + [(99, at(0), None)], "name int, since timestamp_ntz, until timestamp_ntz")
    probes = spark.createDataFrame([(s, at(s)) for s in range(0, 1500, 7)], "id int, ts timestamp_ntz")
    expected = []
    for s in range(0, 1500, 7):
        own = [i for i, a, b in spans if a <= s < b]
        expected += [(s, i) for i in own] or [(s, None)]
    assert rows(interval_join(probes, intervals, "ts", "since", "until"), "id", "name") == sorted(expected, key=repr)


def test_consecutive_events(spark, rows):
    events = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 3 % 1000).alias("at"))
    found = consecutive(events.repartition(7), "at")
    pairs = sorted((r.at, r.until) for r in found.collect() if r.until)
    moments = sorted(r.at for r in events.collect())
    assert pairs == list(zip(moments, moments[1:])) and found.filter("until IS NULL").count() == 1


def test_log_lines_with_odd_parts(spark):
    lines = [
        "2024-01-01T00:00:01+00:00 request=1 status=200 zone= latency_ms=3.5 path=a detail=b",
        "2024-01-01T00:00:01+00:00 request=2 error=E latency_ms=3.5 path= detail=",
        "2024-01-01T00:00:01+00:00 request=3 error=E latency_ms=3.5 path=x",
        "x\u0001\u0001\u0001\u0001\u0001\u0001\u0001\u0001\u0001\u0001\u0001", "", "MARKER_T0_STOP", "MARKER_T0_STOP 2024-01-01T00:00:03+00:00 ",
    ]
    found = parse_probe_log(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.request_id, r.zone, r.path, r.error, r.detail) for r in found] == [
        (1, "missing", "a detail=b", None, None), (2, None, None, "E", None),
    ]


def test_timeline(parsed, rows):
    timeline = ops.zone_timeline(parsed.filter("kind = 'probe'"), "5 seconds")
    assert sum(r.requests for r in timeline.collect()) == 5
    assert rows(timeline.filter("zone = 'zone-a'"), "requests") == [(1,), (2,)]


def test_csv(spark, tmp_path, rows):
    (tmp_path / "p.csv").write_text(
        "timestamp,request_id,url,status,zone,latency_ms,error\n"
        "2024-01-01T00:00:01+00:00,1,http://x/,200,,3.5,\n"
        "2024-01-01T00:00:02+00:00,2,http://x/,,,9.0,URLError: <urlopen error>\n"
    )
    found = probe_scan(spark, str(tmp_path / "p.csv"))
    assert rows(found, "request_id", "zone", "error") == [(1, "missing", ""), (2, None, "URLError: <urlopen error>")]
    jobs.probe_report(spark, str(tmp_path / "p.csv"), f"{tmp_path}/out")
    assert spark.read.json(f"{tmp_path}/out/summary").first().total_requests == 2


def test_urls(spark):
    cases = [("34.1.1.1", "/index.html"), ("https://x//", " "), ("http://x", "//a/b "), ("HTTP://x", "")]
    df = spark.createDataFrame(cases, "s string, p string").select(probe_url(F.col("s"), F.col("p")))
    assert [r[0] for r in df.collect()] == ["http://34.1.1.1/index.html", "https://x/", "http://x/a/b", "http://HTTP://x/"]


def test_metadata_zone(spark):
    df = spark.createDataFrame([("projects/1/zones/us-west1-b",), ("",), (None,)], "p string")
    assert [r[0] for r in df.select(zone_of_metadata(F.col("p"))).collect()] == ["us-west1-b", "unknown", "unknown"]


@pytest.mark.parametrize("values", [[0.5], [0.001, 0.0011], [0.1] * 50 + [0.2, 0.3001, 0.3002, 0.9], list(range(101))])
def test_timing_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([("p", float(v)) for v in values], "phase string, seconds double")
    exact = df.agg(*[F.percentile("seconds", q) for q in (0.5, 0.95)]).first()
    found = ops.timing_summary(df).first()
    assert (found.p50, found.p95) == pytest.approx(tuple(exact))
    assert (found.n, found["max"]) == (len(values), max(values))


@pytest.mark.parametrize("case", ["microseconds", "hot value", "one value", "extremes"])
def test_quantiles_of_any_values(spark, case):
    import numpy as np

    made = np.random.default_rng(5)
    values = {
        "microseconds": made.uniform(0, 0.001, 3000),
        "hot value": np.concatenate([np.full(2500, 0.25), made.exponential(1, 500)]),
        "one value": np.full(7, 3.5),
        "extremes": np.concatenate([made.uniform(0, 1, 50), [1e300, -1e300, np.inf]]),
    }[case]
    rows = [("a", float(x)) for x in values] + [(None, 1.0), (None, 2.0), ("b", None)]
    found = {r.phase: r for r in ops.timing_summary(spark.createDataFrame(rows, "phase string, seconds double")).collect()}
    assert (found[None].n, found[None].p50, found["a"].n, found["a"].max) == (2, 1.5, len(values), values.max())
    for name, q in (("p50", 0.5), ("p95", 0.95)):
        assert found["a"][name] == pytest.approx(np.quantile(values, q))


@pytest.mark.parametrize("spread", [1e-9, 1.0, 1e12])
def test_quantiles_take_two_scans_whatever_the_spread(spark, monkeypatch, spread):
    import numpy as np

    made = np.random.default_rng(6).lognormal(0, 3, 5000) * spread
    frame = spark.createDataFrame([("p", float(x)) for x in made], "phase string, seconds double")
    scanned = []
    before = ops.materialize

    def counting(df, *rest):
        scanned.append(df._jdf.queryExecution().executedPlan().toString().count("ExistingRDD"))
        return before(df, *rest)

    monkeypatch.setattr(ops, "materialize", counting)
    found = ops.timing_summary(frame, accuracy=100).first()  # brackets of a twenty-fifth of the rows
    assert sum(scanned) == 2
    assert (found.p50, found.p95) == pytest.approx(tuple(np.quantile(made, [0.5, 0.95])), rel=1e-12)


def test_a_misplaced_bracket_is_opened(spark, monkeypatch):
    frame = spark.range(1000).select(F.lit("p").alias("phase"), F.col("id").cast("double").alias("seconds"))
    wrong = F.array(F.lit(990.0), F.lit(995.0), F.lit(1.0), F.lit(2.0))
    monkeypatch.setattr(ops.F, "percentile_approx", lambda *_: F.first(wrong))
    found = ops.timing_summary(frame, accuracy=100).first()
    assert (found.p50, found.p95) == pytest.approx((499.5, 949.05))
