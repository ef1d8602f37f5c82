"""Availability probes: totals, zones, errors, phases, timings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.functions.probes import error_label, succeeded
from pagetrail.operators.intervals import consecutive, interval_join
from pagetrail.session import materialize

# The sketch of timings knows the place of a value up to this part of all of them.
ACCURACY = 20_000


def probe_summary(probes: DataFrame) -> DataFrame:
    """One row: total_requests, successes, failures."""
    ok = F.count_if(succeeded(F.col("status")))
    return probes.agg(
        F.count("*").alias("total_requests"), ok.alias("successes"), (F.count("*") - ok).alias("failures")
    )


def zone_distribution(probes: DataFrame) -> DataFrame:
    """(zone, requests, ratio) over successful probes."""
    answered = probes.filter(succeeded(F.col("status")))
    total = answered.agg(F.count("*")).scalar()
    zones = answered.groupBy("zone").agg(F.count("*").alias("requests"))
    return zones.select("zone", "requests", (F.col("requests") / total).alias("ratio")).orderBy("zone")


def error_counts(probes: DataFrame) -> DataFrame:
    """(error, failures) over failed probes."""
    failed = probes.filter(~succeeded(F.col("status")))
    label = error_label(F.col("status"), F.col("error"))
    return failed.groupBy(label.alias("error")).agg(F.count("*").alias("failures")).orderBy("error")


def zone_timeline(probes: DataFrame, width: str = "10 seconds", watermark: str | None = None) -> DataFrame:
    """(window_start, zone, requests, successes) of answered probes; batch or stream."""
    answered = probes.filter("status IS NOT NULL")
    if watermark:
        answered = answered.withWatermark("ts", watermark)
    counted = answered.groupBy(F.window("ts", width), "zone").agg(
        F.count("*").alias("requests"), F.sum(succeeded(F.col("status")).cast("bigint")).alias("successes")
    )
    return counted.select(F.col("window.start").alias("window_start"), "zone", "requests", "successes")


def phase_intervals(markers: DataFrame, kind: str = "timestamp") -> DataFrame:
    """(phase, since, until) of an experiment: down from a stop marker to the next start marker, restored from there to the
    next stop marker. The last one has no end, nothing is listed before the first stop marker, and other markers do not count.
    """
    events = markers.filter(F.col("marker").isin("MARKER_T0_STOP", "MARKER_T0_START") & F.col("ts").isNotNull())
    # a start at the moment of a stop comes after it
    events = events.select(F.col("ts").cast(kind).alias("since"), (F.col("marker") == "MARKER_T0_START").alias("starts"))
    first_stop = events.filter("NOT starts").agg(F.min("since")).scalar()
    ordered = consecutive(events, "since", "starts").filter(F.col("since") >= first_stop)
    phase = F.when(F.col("starts"), "restored").otherwise("down").alias("phase")
    # of several markers at one moment the last one counts
    return ordered.filter("until IS NULL OR since < until").select(phase, "since", "until")


def with_phase(probes: DataFrame, markers: DataFrame) -> DataFrame:
    """Probes with ``phase``: before the first stop marker, and then that of the interval between markers they fall into.

    A marker at the moment of a probe is passed. Probes without a moment have no phase.
    """
    intervals = materialize(phase_intervals(markers, probes.schema["ts"].dataType.simpleString()), "phase-intervals")
    joined = interval_join(probes, intervals.filter("until IS NOT NULL"), "ts", "since", "until")
    last = intervals.filter("until IS NULL")  # one row
    reached = F.col("ts") >= last.select("since").scalar()
    phase = F.coalesce("phase", F.when(reached, last.select("phase").scalar()), F.lit("before"))
    return joined.select(*probes.columns, F.when(F.col("ts").isNotNull(), phase).alias("phase"))


def failover_phases(probes: DataFrame, markers: DataFrame) -> DataFrame:
    """(phase, zone, requests, successes) of answered probes."""
    answered = with_phase(probes, markers).filter("status IS NOT NULL")
    return answered.groupBy("phase", "zone").agg(
        F.count("*").alias("requests"), F.count_if(succeeded(F.col("status"))).alias("successes")
    )


def timing_summary(timings: DataFrame, quantiles: dict[str, float] | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """(phase, n, mean, max, <quantiles>) of timings (phase, seconds); quantiles exact and interpolated.

    The first scan sums up and keeps a sketch per phase, whose quantiles a little below and above a wanted position bracket
    it. The second scan counts what lies below each bracket, and the values in it one by one: about ``4 / accuracy`` of a
    phase, or all values of a phase with few rows. A bracket that the sketch should have misplaced is opened to all values.
    """
    quantiles = quantiles or {"p50": 0.5, "p95": 0.95}
    values = timings.filter("seconds IS NOT NULL").select("phase", "seconds")
    around = [x for q in quantiles.values() for x in (max(q - 2 / accuracy, 0.0), min(q + 2 / accuracy, 1.0))]
    summary = values.groupBy("phase").agg(
        F.count("*").alias("n"), F.avg("seconds").alias("mean"), F.max("seconds").alias("max"), F.min("seconds").alias("min"),
        F.percentile_approx("seconds", F.array(*map(F.lit, around)), F.lit(accuracy)).alias("around"),
    )
    summary = materialize(summary, "timing-summary")

    def wanted(i: int, name: str, q: float):
        exact = F.lit(q) * (F.col("n") - 1)
        few = F.col("n") <= 4 * accuracy
        low, high = (F.when(few, F.col(end)).otherwise(F.get("around", F.lit(2 * i + k))) for k, end in ((0, "min"), (1, "max")))
        return F.struct(
            F.lit(name).alias("quantile"), F.floor(exact).alias("first"), F.ceil(exact).alias("second"),
            (exact - F.floor(exact)).alias("part"), low.alias("low"), high.alias("high"),
        )

    each = F.array(*[wanted(i, *item) for i, item in enumerate(quantiles.items())])
    brackets = materialize(summary.select("phase", "min", "max", F.inline(each)), "timing-brackets")
    points = materialize(_points(values, brackets), "timing-points")
    astray = points.filter("point IS NULL").select("phase", "quantile")
    if not astray.isEmpty():
        missed = brackets.alias("b").join(
            astray.alias("a"), F.expr("b.phase <=> a.phase AND b.quantile = a.quantile"), "left_semi"
        )
        again = _points(values, missed.withColumns({"low": F.col("min"), "high": F.col("max")}))
        points = points.filter("point IS NOT NULL").unionByName(again)
    columns = [F.max(F.when(F.col("quantile") == name, F.col("point"))).alias(name) for name in quantiles]
    by_phase = points.groupBy(F.col("phase").alias("_phase")).agg(*columns)
    same = summary["phase"].eqNullSafe(by_phase["_phase"])
    return summary.drop("min", "around").join(by_phase, same, "left").drop("_phase")


def _points(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """(phase, quantile, point) for brackets (phase, quantile, first, second, part, low, high); a point outside its bracket is null."""
    own = brackets.withColumnRenamed("phase", "_phase")
    met = values.join(own, values["phase"].eqNullSafe(own["_phase"]) & (F.col("seconds") <= F.col("high"))).drop("_phase")
    key = ["phase", "quantile", "first", "second", "part"]
    value = F.when(F.col("seconds") >= F.col("low"), F.col("seconds")).alias("value")
    counted = met.groupBy(*key, value).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("phase", "quantile").orderBy(F.col("value").asc_nulls_first()))
    placed = counted.withColumn("upto", upto)

    def at(position: str):
        held = F.col("value").isNotNull() & (F.col(position) < F.col("upto")) & (F.col(position) >= F.col("upto") - F.col("n"))
        return F.max(F.when(held, F.col("value"))).alias(f"{position}_value")

    found = placed.groupBy("phase", "quantile", "part").agg(at("first"), at("second"))
    point = F.col("first_value") + (F.col("second_value") - F.col("first_value")) * F.col("part")
    exact = F.when(F.col("part") == 0, F.col("first_value")).otherwise(point)
    return found.select("phase", "quantile", exact.alias("point"))
