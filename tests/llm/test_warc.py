import gzip
import hashlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from pagetrail.llm import warc
from pagetrail.session import scratch_path

LONG = "Lorem ipsum " * 20
PAYLOADS = [LONG, "\r\n\r\n" * 60, "a\r\n\r\n" + "b" * 200 + "\r\n\r", "é🙂" * 80, LONG, "", None, LONG, "ab\r\n" * 50, "short", "short", "WARC/1.1\r\n" * 20]


def pages(spark):
    rows = [(i, f"http://a.example/{i}\r\nX: y", p) for i, p in enumerate(PAYLOADS)]
    rows += [(None, None, LONG), (3, "again", LONG), (0, "twice", LONG), (None, "u", "z" * 100), (None, "u", "z" * 100)]
    return rows, spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumnRenamed("url", "url")


@pytest.mark.parametrize("chunk_bytes", [3, 64, 1 << 20])
def test_round_trip(spark, chunk_bytes):
    rows, frame = pages(spark)
    path = scratch_path(spark, "warc-test")
    warc.write_warc(frame, path, chunk_bytes)
    found = warc.read_warc(spark, path).collect()
    assert len(found) == len(rows)

    def plain(text):
        data = (text or "").encode()
        return len(data), hashlib.sha256(data).hexdigest()

    assert Counter((r.page_id, r.stated_bytes, r.stated_digest) for r in found) == Counter((i, *plain(p)) for i, _, p in rows)
    for r in found:
        if r.record_type == "response":
            assert (r.read_bytes, r.read_digest) == (r.stated_bytes, r.stated_digest) and r.refers_to is None
        else:
            assert r.read_bytes == 0 and r.refers_to == 0 and r.stated_digest == plain(LONG)[1] and r.page_id != 0
    assert sum(r.record_type == "revisit" for r in found) == 4
    assert {r.url for r in found if r.page_id == 5} == {"http://a.example/5%0D%0AX: y"}


def test_archives_are_warc_files(spark):
    _, frame = pages(spark)
    path = scratch_path(spark, "warc-test")
    warc.write_warc(frame.coalesce(1), path, 100)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(path).glob("part-*.gz")))
    kinds, numbers = Counter(), {}
    while data:
        head, _, data = data.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines)
        assert first == "WARC/1.1" and data[int(fields["Content-Length"]) :][:4] == b"\r\n\r\n"
        data = data[int(fields["Content-Length"]) + 4 :]
        kinds[fields["WARC-Type"]] += 1
        if fields["WARC-Type"] == "response":
            numbers[fields["WARC-Record-ID"]] = 1
        if fields["WARC-Type"] == "continuation":
            origin = fields["WARC-Segment-Origin-ID"]
            numbers[origin] += 1
            assert int(fields["WARC-Segment-Number"]) == numbers[origin]
    assert kinds["revisit"] == 4 and kinds["response"] == 13 and kinds["continuation"] > 5


def test_empty_table(spark):
    _, frame = pages(spark)
    path = scratch_path(spark, "warc-test")
    warc.write_warc(frame.limit(0), path)
    assert warc.read_warc(spark, path).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    found = warc.op6_warc(spark, f"/root/testdata/{sf}")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW pages AS SELECT * FROM '/root/testdata/{sf}/pages.parquet'")
    expected = connection.sql(warc.ORACLE["op6_warc"])
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())


def test_only_chunks_are_shuffled(spark, monkeypatch):
    """No plan moves a whole html between tasks, and chunks stay within their size."""
    _, frame = pages(spark)
    plans = []
    before = warc.materialize

    def recording(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return before(df, *rest)

    monkeypatch.setattr(warc, "materialize", recording)
    monkeypatch.setattr(warc, "records", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or written(df))
    written = lambda df: df.select(warc.F.lit("x").alias("value"))
    warc.write_warc(frame, scratch_path(spark, "warc-test"), 64)
    assert "Exchange" not in plans[0] and "html" in plans[0]
    assert all("html" not in plan for plan in plans[1:])
    assert "Exchange" in plans[-1] and "data" in plans[-1]
