from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pagetrail import jobs
from pagetrail.operators import probes as probe_ops
from pagetrail.operators.requests import channel_lines, forbidden_events, route_requests
from pagetrail.sources import generations, messages
from pagetrail.streaming import consumer, forbidden, logs, runs, stats

SCHEMA = "request_id long, ts timestamp, method string, path string, headers map<string,string>, remote_addr string"
START = datetime(2024, 1, 1)


def arrivals(spark, folder, ids):
    rows = [
        (i, START + timedelta(seconds=i), "GET", str(i), {"X-country": "Cuba" if i % 3 else "Peru"}, "192.0.2.1") for i in ids
    ]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_forbidden_stream_appends_once_over_runs(spark, tmp_path, rows):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    arrivals(spark, source, range(10))
    stream = runs.read_arrivals(spark, source, spark.read.parquet(source).schema)
    jobs.stream_forbidden(stream, out)
    jobs.stream_forbidden(stream, out)
    arrivals(spark, source, range(10, 15))
    jobs.stream_forbidden(stream, out)
    batch = channel_lines(forbidden_events(spark.read.parquet(source)))
    assert rows(spark.read.parquet(f"{out}/lines")) == rows(batch)


def test_channels_follow_the_profile(spark, tmp_path):
    source = f"{tmp_path}/in"
    arrivals(spark, source, range(10))
    for profile, channels in (("v3", {"Pub/Sub"}), ("v5", {"Pub/Sub", "HTTP"}), ("v9", {"Pub/Sub"})):
        stream = runs.read_arrivals(spark, source, spark.read.parquet(source).schema)
        jobs.stream_forbidden(stream, f"{tmp_path}/{profile}", profile)
        assert {r.channel for r in spark.read.parquet(f"{tmp_path}/{profile}/lines").collect()} == channels


def test_logs_append_once_over_runs_and_feed_the_report(spark, tmp_path, rows):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    pages = spark.createDataFrame([("1.html",), ("2.html",), ("3.html",)], "page string")
    arrivals(spark, source, range(6))
    stream = runs.read_arrivals(spark, source, spark.read.parquet(source).schema)
    logs.append_logs(stream, pages, out)
    arrivals(spark, source, range(6, 9))
    logs.append_logs(stream, pages, out)
    routed = route_requests(spark.read.parquet(source), pages)
    for name, build in logs.LOGS.items():
        assert rows(spark.read.parquet(f"{out}/{name}").drop("day")) == rows(build(routed))
    jobs.stats_lines(spark, out, f"{tmp_path}/report")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/report").collect()]
    assert any(line.startswith('top_5_countries: [{"country":"Cuba","count":6}') for line in lines) and len(lines) == 6


def usage(spark, n):
    return spark.range(n).select(
        F.lit("Peru").alias("country"), F.lit("Male").alias("gender"), F.lit(20).alias("age"),
        F.lit("low").alias("income"), F.lit(False).alias("is_banned"),
    )


def test_running_counts_grow(spark, tmp_path, rows):
    source, path, checkpoint = f"{tmp_path}/logs", f"{tmp_path}/counts", f"{tmp_path}/checkpoint"
    assert rows(stats.current_counts(spark, path)) == []
    usage(spark, 3).write.mode("append").parquet(source)
    stream = runs.read_arrivals(spark, source, spark.read.parquet(source).schema)
    stats.keep_counts(stream, path, checkpoint)
    assert ("country", "Peru", 3) in rows(stats.current_counts(spark, path))
    usage(spark, 4).write.mode("append").parquet(source)
    stats.keep_counts(stream, path, checkpoint)
    stats.keep_counts(stream, path, checkpoint)
    assert rows(stats.current_counts(spark, path)) == [
        ("age_group", "18-24", 7), ("country", "Peru", 7), ("gender", "Male", 7), ("income", "low", 7), ("is_banned", "false", 7),
    ]


def test_a_repeated_batch_changes_nothing(spark, tmp_path, rows, monkeypatch):
    path = f"{tmp_path}/counts"
    for batch_id, n in ((0, 2), (1, 5), (1, 5), (1, 99)):
        stats.add_batch(usage(spark, n), batch_id, path)
    assert ("country", "Peru", 7) in rows(stats.current_counts(spark, path))

    def failing(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(generations, "hadoop_path", failing)
        with pytest.raises(RuntimeError):
            stats.add_batch(usage(spark, 3), 2, path)
    assert ("country", "Peru", 7) in rows(stats.current_counts(spark, path))
    stats.add_batch(usage(spark, 3), 2, path)
    assert ("country", "Peru", 10) in rows(stats.current_counts(spark, path))


def test_unfinished_generations_are_not_read(spark, tmp_path, rows):
    root = f"{tmp_path}/store"
    for n in (1, 2, 3):
        generations.publish(spark, root, spark.range(n).write.parquet)

    def broken(path):
        spark.range(9).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        generations.publish(spark, root, broken)
    assert spark.read.parquet(generations.current(spark, root)).count() == 3
    assert spark.read.parquet(generations.current(spark, root, before=3)).count() == 2
    assert generations.current(spark, root, before=2) is None  # only the newest two stay
    generations.publish(spark, root, spark.range(4).write.parquet)
    assert spark.read.parquet(generations.current(spark, root)).count() == 4


def messages_of(spark, ids):
    data = [(i, START + timedelta(seconds=i), bytearray(f"text {i}".encode())) for i in ids]
    return spark.createDataFrame(data, messages.SCHEMA)


def test_consumer_gets_unacknowledged_messages_again(spark, tmp_path, rows):
    queue, out, checkpoint = f"{tmp_path}/queue", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    messages.publish(messages_of(spark, range(4)), queue)
    consumer.consume(spark, queue, out, checkpoint)
    messages.publish(messages_of(spark, range(4, 7)), queue)

    def crash(batch):
        batch.write.parquet(f"{tmp_path}/seen")
        raise RuntimeError("stopped before the commit")

    with pytest.raises(Exception, match="stopped before the commit"):
        consumer.consume(spark, queue, out, checkpoint, crash)
    assert rows(spark.read.parquet(f"{tmp_path}/seen"), "message_id") == [(4,), (5,), (6,)]
    messages.publish(messages_of(spark, range(7, 9)), queue)
    consumer.consume(spark, queue, out, checkpoint)
    consumer.consume(spark, queue, out, checkpoint)
    found = consumer.consumed(spark, out)
    assert rows(found, "message_id", "value") == [(i, f"text {i}") for i in range(9)]
    assert found.filter("message_id = 8").first().published == START + timedelta(seconds=8)


def test_acknowledgements_outlive_a_checkpoint(spark, tmp_path, rows):
    queue, out = f"{tmp_path}/queue", f"{tmp_path}/out"
    messages.publish(messages_of(spark, range(3)), queue)
    consumer.consume(spark, queue, out, f"{tmp_path}/one")
    reader = messages._Reader(queue, "default")
    consumer.consume(spark, queue, out, f"{tmp_path}/one")  # the next start tells the source what the last run committed
    reader.commit({"batch": 1})
    assert reader.acknowledged() == 1 and reader.initialOffset() == {"batch": 1}
    messages.publish(messages_of(spark, range(3, 5)), queue)
    spark.range(1).write.parquet(f"{queue}/unrelated")
    consumer.consume(spark, queue, f"{tmp_path}/again", f"{tmp_path}/two")
    assert rows(consumer.consumed(spark, f"{tmp_path}/again"), "message_id") == [(3,), (4,)]
    assert reader.partitions({"batch": 2}, {"batch": 2}) == []


def probe_rows(spark, folder, seconds):
    rows = [(START + timedelta(seconds=s), 200, "zone-a") for s in seconds]
    spark.createDataFrame(rows, "ts timestamp, status int, zone string").coalesce(1).write.mode("append").parquet(folder)


def test_timeline_with_watermark_emits_closed_windows(spark, tmp_path):
    source = f"{tmp_path}/probes"
    probe_rows(spark, source, range(25))
    schema = spark.read.parquet(source).schema
    closed = probe_ops.zone_timeline(runs.read_arrivals(spark, source, schema), watermark="5 seconds")
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    runs.append_to_files(closed, out, checkpoint)
    probe_rows(spark, source, range(100, 101))
    runs.append_to_files(closed, out, checkpoint)
    found = {r.window_start: r.requests for r in spark.read.parquet(out).collect()}
    assert found == {START: 10, START + timedelta(seconds=10): 10, START + timedelta(seconds=20): 5}


def test_redelivered_messages_are_kept_once(spark, tmp_path):
    source = f"{tmp_path}/messages"
    rows = [(i % 4, START + timedelta(seconds=i), bytearray(b"text \xc3\xa9")) for i in range(8)]
    spark.createDataFrame(rows, "message_id long, ts timestamp, value binary").write.parquet(source)
    stream = runs.read_arrivals(spark, source, spark.read.parquet(source).schema)
    once = forbidden.drop_redelivered(forbidden.received_messages(stream), "message_id", "ts", "1 minute")
    found = runs.appended(once, "messages")
    assert found.count() == 4 and found.first().value == "text é"
