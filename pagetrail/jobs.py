"""Command-line jobs: ``python -m pagetrail.jobs <job> ...`` or the same behind spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.operators import country, graph, income, pages, probes, split, stats
from pagetrail.operators.pagerank import page_rank, top_ranked
from pagetrail.operators.requests import build_failed_log, build_request_log, forbidden_events, route_requests
from pagetrail.operators.star import build_star, denormalize, ip_conflicts, row_counts
from pagetrail.session import build_session, materialize, scratch_scope
from pagetrail.sources import corpus, tables
from pagetrail.sources.probes import markers, parse_probe_log, probe_scan
from pagetrail.sources.sinks import append_log, write_csv, write_lines
from pagetrail.streaming import forbidden, runs

TOP_FILES = {"incoming": "top_5_incoming", "outgoing": "top_5_outgoing", "bigram": "top_5_bigrams"}


def _lines(spark: SparkSession, lines: list[str]) -> DataFrame:
    return spark.createDataFrame([(line,) for line in lines], "line string")


def corpus_report(
    spark: SparkSession, source: str, output: str, max_files: int | None = None, on_bad_utf8: str = "drop"
) -> None:
    """Top in-links, out-links and bigrams of a folder or pattern of HTML files, one text folder each.

    ``source`` may also be a table written by ``compact_corpus``. Options, summary and the outcome of each file are the same
    for both. What was read is counted by the job that reads it.
    """
    if corpus.is_table(spark, source):
        table = spark.read.parquet(source)
        listed, chosen = table.select("path", "bytes"), corpus.first_rows(table, max_files)
        wanted = corpus.first_rows(listed, max_files)
    else:
        listed, wanted = corpus.listing(spark, source), corpus.listing(spark, source, max_files)
        chosen = corpus.pages_of(corpus.first_files(spark, source, max_files))
    found = listed.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first().asDict()
    corpus.require(found["files"] > 0, f"no HTML files under {source}")
    used = min(max_files, found["files"]) if max_files is not None and max_files > 0 else found["files"]
    read, seen = corpus.observed(chosen)
    read = materialize(read.select("path", "file_id", "content", "bytes", "damaged"), "pages")
    seen = seen.get
    scanned = corpus.kept_pages(read, on_bad_utf8)
    _write_top_lists(materialize(pages.format_top_links(pages.top_lists(scanned)), "top-lists"), output)
    outcomes = corpus.file_outcomes(wanted, read, on_bad_utf8)
    outcomes.write.mode("overwrite").option("header", True).csv(f"{output}/files")
    skipped = seen["damaged"] if on_bad_utf8 == "skip" else 0
    processed = seen["files"] - skipped
    summary = [f"Input: {source}", f"Files processed: {processed}", f"Bytes found: {found['bytes']}"]
    if processed < used:
        summary.append(f"Files skipped: {used - processed}")
    if seen["damaged"]:
        summary.append(f"Files damaged: {seen['damaged']}")
    if seen["files"] < used:
        summary.append(f"Files unreadable: {used - seen['files']}")
    if used < found["files"]:
        summary.append(f"(Subset of {found['files']} files.)")
    write_lines(_lines(spark, summary), f"{output}/run")


def _write_top_lists(report: DataFrame, output: str) -> None:
    for kind, name in TOP_FILES.items():
        write_lines(report.filter(F.col("kind") == kind).orderBy("position"), f"{output}/{name}")


def compact_corpus(spark: SparkSession, source: str, output: str) -> None:
    """HTML files to one parquet table, so that later jobs list and open few large files."""
    corpus.compacted(spark, source).write.mode("overwrite").parquet(output)


def page_rank_report(spark: SparkSession, source: str, output: str) -> None:
    """Degree statistics, all ranks and the top five of a folder of numbered HTML files."""
    scanned = corpus.numbered_pages(spark, source)
    links = materialize(pages.extract_links_numeric(scanned), "page-links")
    nodes = links.select(F.col("file_id").alias("node"))
    corpus.require(not nodes.isEmpty(), f"no numbered HTML files under {source}")
    edges = materialize(graph.link_edges(links), "link-edges")
    graph.degree_stats(nodes, edges).coalesce(1).write.mode("overwrite").json(f"{output}/degree_stats")
    result = page_rank(nodes, edges)
    result.ranks.write.mode("overwrite").parquet(f"{output}/ranks")
    top = top_ranked(spark.read.parquet(f"{output}/ranks"))
    line = F.format_string("Page %d.html: %.6f", "node", "pr").alias("line")
    write_lines(top.select(line), f"{output}/top_5")


def process_requests(spark: SparkSession, requests: DataFrame, page_names: DataFrame, output: str, profile: str = "v5") -> None:
    """Route requests and append their request-log, failure-log and refusal rows below ``output``."""
    routed = materialize(route_requests(requests, page_names, profile), "routed")
    append_log(build_request_log(routed), f"{output}/request_logs")
    append_log(build_failed_log(routed), f"{output}/failed_request_logs")
    append_log(forbidden_events(requests, profile), f"{output}/forbidden", moment="ts")


def stream_forbidden(requests: DataFrame, output: str, profile: str = "v5") -> None:
    """Append the refusal lines of all requests that arrived since the last run."""
    runs.append_to_files(forbidden.forbidden_stream(requests, profile), f"{output}/lines", f"{output}/checkpoint")


def stats_lines(spark: SparkSession, logs_path: str, output: str) -> None:
    """The usage report, one ``name: rows`` line per result."""
    logs = spark.read.parquet(f"{logs_path}/request_logs")
    failed = spark.read.parquet(f"{logs_path}/failed_request_logs")
    report = stats.stats_report(logs, failed)
    write_lines(report.orderBy("position").select(F.concat_ws(": ", "metric", "rows").alias("line")), output)


def migrate(spark: SparkSession, logs_path: str, output: str, previous: str | None = None) -> None:
    """Logs to star tables below ``output``, plus the audit lines. ``previous`` names an earlier star to extend."""
    logs = spark.read.parquet(f"{logs_path}/request_logs")
    failed = spark.read.parquet(f"{logs_path}/failed_request_logs")
    tables.write_star(build_star(logs, failed, tables.read_star(spark, previous) if previous else None), output)
    counts = row_counts(tables.read_star(spark, output))
    conflicts = ip_conflicts(logs).select(F.lit("ip_conflicts_in_source").alias("name"), "ip_conflicts_in_source")
    audit = conflicts.union(counts).toDF("name", "n")
    write_lines(audit.select(F.concat_ws("=", "name", F.col("n").cast("string")).alias("line")), f"{output}/audit")


def train(
    spark: SparkSession, star_path: str, output: str, prefix: str = "model_outputs", rounds: int = 300, depth: int = 6
) -> None:
    """Both models on the re-joined star: prediction CSVs and the metrics lines."""
    rows = materialize(denormalize(tables.read_star(spark, star_path)), "training-rows")
    corpus.require(not rows.isEmpty(), "no rows in the star tables; run migrate first")
    places = country.country_predictions(materialize(split.country_split(rows), "country-split"))
    places = materialize(places.drop("event_id"), "country-predictions")
    incomes = income.train_income_model(materialize(split.income_split(rows), "income-split"), rounds, depth)
    guesses = materialize(incomes.predictions.drop("event_id"), "income-predictions")
    write_csv(places, f"{output}/{prefix}_country_test_predictions.csv")
    write_csv(guesses, f"{output}/{prefix}_income_test_predictions.csv")
    lines = income.model_metrics(
        country.accuracy(places, "country", "predicted_country").first()[0],
        country.accuracy(guesses, "actual_income", "predicted_income").first()[0],
        prefix,
    )
    write_lines(_lines(spark, lines), f"{output}/{prefix}_metrics.txt")


def probe_report(spark: SparkSession, source: str, output: str, kind: str = "csv") -> None:
    """Totals, zones, errors and timeline of probe CSVs, or of a printed log with its failover phases."""
    if kind == "csv":
        rows = probe_scan(spark, source)
    else:
        parsed = materialize(parse_probe_log(spark.read.text(source)), "probe-log")
        rows = parsed.filter("kind = 'probe'")
        probes.failover_phases(rows, markers(parsed)).coalesce(1).write.mode("overwrite").json(f"{output}/phases")
    results = {
        "summary": probes.probe_summary(rows),
        "zones": probes.zone_distribution(rows),
        "errors": probes.error_counts(rows),
        "timeline": probes.zone_timeline(rows),
    }
    for name, result in results.items():
        result.write.mode("overwrite").json(f"{output}/{name}")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pagetrail")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *arguments: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name)
        for argument in arguments:
            added.add_argument(argument, required=True)
        return added

    report = job("corpus-report", "--pages", "--output")
    report.add_argument("--max-files", type=int)
    report.add_argument("--on-bad-utf8", choices=("drop", "skip"), default="drop")
    job("compact-corpus", "--pages", "--output")
    job("page-rank", "--pages", "--output")
    job("process-requests", "--requests", "--page-names", "--output").add_argument("--profile", default="v5")
    job("stream-forbidden", "--requests", "--output").add_argument("--profile", default="v5")
    job("stats", "--logs", "--output")
    job("migrate", "--logs", "--output").add_argument("--previous")
    training = job("train", "--star", "--output")
    training.add_argument("--prefix", default="model_outputs")
    training.add_argument("--rounds", type=int, default=300)
    job("probes", "--source", "--output").add_argument("--kind", choices=("csv", "log"), default="csv")
    return parser


def main(arguments: list[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    spark = build_session(f"pagetrail-{options.job}")
    with scratch_scope(spark):
        _run(spark, options)


def _run(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.job == "corpus-report":
        corpus_report(spark, options.pages, options.output, options.max_files, options.on_bad_utf8)
    elif options.job == "compact-corpus":
        compact_corpus(spark, options.pages, options.output)
    elif options.job == "page-rank":
        page_rank_report(spark, options.pages, options.output)
    elif options.job == "process-requests":
        requests, names = spark.read.parquet(options.requests), spark.read.parquet(options.page_names)
        process_requests(spark, requests, names, options.output, options.profile)
    elif options.job == "stream-forbidden":
        schema = spark.read.parquet(options.requests).schema
        stream_forbidden(runs.read_arrivals(spark, options.requests, schema), options.output, options.profile)
    elif options.job == "stats":
        stats_lines(spark, options.logs, options.output)
    elif options.job == "migrate":
        migrate(spark, options.logs, options.output, options.previous)
    elif options.job == "train":
        train(spark, options.star, options.output, options.prefix, options.rounds)
    else:
        probe_report(spark, options.source, options.output, options.kind)


if __name__ == "__main__":
    main()
