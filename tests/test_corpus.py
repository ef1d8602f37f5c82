import duckdb
import pytest

from pagetrail import jobs
from pagetrail.adapters import web_pages
from pagetrail.plans import corpus as plans
from pagetrail.sources import corpus


@pytest.fixture
def folder(tmp_path):
    files = {
        "1.html": b'<a HREF="2.html">one two</a> one two',
        "10.html": b'<a HREF="1.html"></a><a HREF="2.html"></a>',
        "2.html": b"bad \xff byte",
        "about.html": b'<a href="1.html">x</a>',
        "notes.txt": b"not a page",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    return str(tmp_path)


@pytest.fixture
def tables(spark, tmp_path):
    """Sixty pages, one of them without html."""
    html = "CASE WHEN id <> 12 THEN concat('<p>\u00e9 \ufffd ', id, '</p>') END AS html"
    spark.range(60).selectExpr("id AS page_id", html).write.parquet(f"{tmp_path}/tables/pages.parquet")
    return f"{tmp_path}/tables"


@pytest.mark.parametrize(("name", "id_type"), [("corpus_scan", "STRING"), ("corpus_scan_numeric", "BIGINT")])
def test_registered_scan_returns_every_page(spark, tables, rows, name, id_type):
    """The query and its SQL return each page once, with its whole text."""
    pages = rows(web_pages(spark, tables).selectExpr(f"CAST(file_id AS {id_type})", "length(content)", "content"))
    assert len(pages) == 60 and all(content for _, _, content in pages)
    assert rows(plans.QUERIES[name](spark, tables)) == pages
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{tables}/pages.parquet/*.parquet'")
    assert sorted(duck.sql(plans.ORACLE[name]).fetchall(), key=repr) == pages


def test_scan_drops_bytes_or_skips_files(spark, folder, rows):
    dropped = corpus.corpus_scan(spark, folder)
    assert rows(dropped, "file_id") == [("1",), ("10",), ("2",), ("about",)]
    assert dropped.filter("file_id = '2'").first().content == "bad  byte"
    assert rows(corpus.corpus_scan(spark, folder, "skip"), "file_id") == [("1",), ("10",), ("about",)]
    with pytest.raises(ValueError):
        corpus.corpus_scan(spark, folder, "replace")


def test_numeric_scan(spark, folder, rows):
    assert rows(corpus.corpus_scan_numeric(spark, folder), "file_id") == [(1,), (10,)]


def test_first_n_by_path(spark, folder, rows, tmp_path):
    first = [("1",), ("10",)]
    assert rows(corpus.corpus_first_n(spark, folder, 2), "file_id") == first
    assert [corpus.corpus_first_n(spark, folder, n).count() for n in (0, None, 1, 4, 20_000)] == [4, 4, 1, 4, 4]
    jobs.compact_corpus(spark, folder, f"{tmp_path}/table")
    table = spark.read.parquet(f"{tmp_path}/table")
    assert rows(corpus.table_first_n(table, 2), "file_id") == first
    assert [corpus.table_first_n(table, n).count() for n in (0, None, 1, 20_000)] == [4, 4, 1, 4]
    assert corpus.table_first_n(table, None, "skip").count() == 3
    (tmp_path / "none").mkdir()
    for n in (2, 20_000):
        with pytest.raises(ValueError):
            corpus.corpus_first_n(spark, f"{tmp_path}/none", n)


def test_listing_reads_no_content(spark, folder):
    plan = corpus._files(spark, folder).select("path")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


def read(spark, path):
    return [row.value for row in spark.read.text(path).collect()]


def test_corpus_report_job(spark, folder, tmp_path):
    out = f"{tmp_path}/report"
    jobs.corpus_report(spark, folder, out)
    assert read(spark, f"{out}/top_5_incoming") == ["File 1: 2 incoming links", "File 2: 2 incoming links"]
    assert read(spark, f"{out}/top_5_outgoing")[0] == "File 10: 2 outgoing links"
    assert read(spark, f"{out}/top_5_bigrams")[0] == "'one two': 2 occurrences"
    assert {"Files processed: 4", "Files damaged: 1"} <= set(read(spark, f"{out}/run"))
    jobs.corpus_report(spark, folder, out, max_files=2)
    assert "(Subset of 4 files.)" in read(spark, f"{out}/run")


@pytest.mark.parametrize(("mode", "fate", "processed"), [("drop", "repaired", 4), ("skip", "skipped", 3)])
def test_outcome_of_each_file(spark, folder, tmp_path, mode, fate, processed):
    for source, out in ((folder, f"{tmp_path}/files"), (f"{tmp_path}/table", f"{tmp_path}/rows")):
        if source != folder:
            jobs.compact_corpus(spark, folder, source)
        jobs.corpus_report(spark, source, out, on_bad_utf8=mode)
        rows = spark.read.option("header", True).csv(f"{out}/files").collect()
        assert {r.path.rsplit("/", 1)[1]: r.outcome for r in rows} == {
            "1.html": "read", "10.html": "read", "2.html": fate, "about.html": "read",
        }
        lines = read(spark, f"{out}/run")
        assert f"Files processed: {processed}" in lines and ("Files skipped: 1" in lines) == (mode == "skip")


def test_files_that_cannot_be_read(spark, rows):
    files = spark.createDataFrame([("a/1.html", bytearray(b"x")), ("a/2.html", None)], "path string, content binary")
    pages, seen = corpus.observed(corpus.pages_of(files))
    assert pages.count() == 1 and seen.get == {"files": 1, "bytes": 1, "damaged": 0}
    listed = spark.createDataFrame([("a/1.html", 1), ("a/2.html", 7)], "path string, bytes bigint")
    assert rows(corpus.file_outcomes(listed, pages)) == [("a/1.html", 1, "read"), ("a/2.html", 7, "unreadable")]


def test_summary_comes_from_the_reading_job(spark, folder, tmp_path, monkeypatch):
    """Files are opened once: content is read by the job that writes the pages, and by no other."""
    opened = []
    before = corpus.pages_of
    monkeypatch.setattr(corpus, "pages_of", lambda files: opened.append(1) or before(files))
    jobs.corpus_report(spark, folder, f"{tmp_path}/once")
    assert len(opened) == 1


def test_page_rank_job(spark, folder, tmp_path):
    out = f"{tmp_path}/ranks"
    jobs.page_rank_report(spark, folder, out)
    assert len(read(spark, f"{out}/top_5")) == 2
    assert spark.read.json(f"{out}/degree_stats").count() == 2


def test_compacted_corpus_gives_the_same_reports(spark, folder, tmp_path):
    table = f"{tmp_path}/table"
    jobs.compact_corpus(spark, folder, table)
    jobs.corpus_report(spark, folder, f"{tmp_path}/a")
    jobs.corpus_report(spark, table, f"{tmp_path}/b")
    for name in jobs.TOP_FILES.values():
        assert read(spark, f"{tmp_path}/a/{name}") == read(spark, f"{tmp_path}/b/{name}")
    jobs.page_rank_report(spark, table, f"{tmp_path}/ranks")
    assert spark.read.parquet(f"{tmp_path}/ranks/ranks").count() == 3


def test_empty_folder_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.corpus_report(spark, str(tmp_path), f"{tmp_path}/out")
