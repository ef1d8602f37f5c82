"""Registered queries over the page corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail import adapters
from pagetrail.adapters import duckdb, web_pages
from pagetrail.operators import graph, pages
from pagetrail.session import materialize
from pagetrail.sources import corpus

FIRST_N = 25


def _whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as the scan of a folder gives it: (path, file_id, content binary)."""
    return web_pages(spark, sf_dir).withColumn("content", F.encode("content", "UTF-8"))


def _damaged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_whole_files``, every tenth with two bytes more that are no UTF-8."""
    raw = F.col("content")
    damaged = F.concat(F.unhex(F.lit("FF")), raw, F.unhex(F.lit("C3")))
    return _whole_files(spark, sf_dir).withColumn("content", F.when(F.col("file_id") % 10 == 0, damaged).otherwise(raw))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_damaged_files`` (path, content) of which some could not be read."""
    content = F.when(F.col("file_id") % 25 == 7, F.lit(None)).otherwise(F.col("content"))
    return _damaged_files(spark, sf_dir).select("path", content.alias("content"))


def _listing(scanned: DataFrame) -> DataFrame:
    return scanned.select("file_id", F.length("content").cast("bigint").alias("chars"), "content")


def corpus_scan(spark, sf_dir):
    """Every page; the bytes that damaged ones have in excess are dropped."""
    return _listing(corpus.kept_pages(corpus.pages_of(_damaged_files(spark, sf_dir))))


def corpus_scan_skip(spark, sf_dir):
    return _listing(corpus.kept_pages(corpus.pages_of(_files(spark, sf_dir)), "skip"))


def corpus_scan_numeric(spark, sf_dir):
    """Every page by its number. The scan leaves out damaged files whole, so it gets undamaged ones."""
    return _listing(corpus.numbered(_whole_files(spark, sf_dir)))


def corpus_first_n(spark, sf_dir):
    return _listing(corpus.kept_pages(corpus.pages_of(corpus.first_rows(_files(spark, sf_dir), FIRST_N))))


def corpus_outcomes(spark, sf_dir):
    """What became of each file, with what the reading job saw on its way."""
    files = _files(spark, sf_dir)
    read, seen = corpus.observed(corpus.pages_of(files))
    read = materialize(read.select("path", "bytes", "damaged"), "read-files")
    listed = web_pages(spark, sf_dir).select("path", F.octet_length("content").cast("bigint").alias("bytes"))
    seen = seen.get
    outcomes = corpus.file_outcomes(listed, read)
    return outcomes.withColumns({"files_read": F.lit(seen["files"]), "files_damaged": F.lit(seen["damaged"])})


def corpus_run_metrics(spark, sf_dir):
    return pages.corpus_run_metrics(web_pages(spark, sf_dir))


def extract_links(spark, sf_dir):
    return pages.extract_links(web_pages(spark, sf_dir))


def extract_links_numeric(spark, sf_dir):
    return pages.extract_links_numeric(web_pages(spark, sf_dir)).select("file_id", F.explode("targets").alias("target"))


def incoming_counts(spark, sf_dir):
    return pages.incoming_counts(web_pages(spark, sf_dir))


def outgoing_counts(spark, sf_dir):
    return pages.outgoing_counts(web_pages(spark, sf_dir))


def top_incoming(spark, sf_dir):
    return pages.top(incoming_counts(spark, sf_dir), "file_id", "incoming")


def top_outgoing(spark, sf_dir):
    return pages.top(outgoing_counts(spark, sf_dir), "file_id", "outgoing")


def page_tokens(spark, sf_dir):
    tokens = pages.page_tokens(web_pages(spark, sf_dir))
    return tokens.select("file_id", F.posexplode("words").alias("position", "word"))


def page_bigrams(spark, sf_dir):
    return pages.page_bigrams(web_pages(spark, sf_dir))


def bigram_counts(spark, sf_dir):
    return pages.bigram_counts(web_pages(spark, sf_dir))


def top_bigrams(spark, sf_dir):
    return pages.top(bigram_counts(spark, sf_dir), "bigram", "occurrences")


def format_top_links(spark, sf_dir):
    return pages.format_top_links(pages.top_lists(web_pages(spark, sf_dir)))


def link_edges(spark, sf_dir):
    return graph.link_edges(pages.extract_links_numeric(web_pages(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        corpus_scan, corpus_scan_skip, corpus_scan_numeric, corpus_first_n, corpus_outcomes, corpus_run_metrics, extract_links,
        extract_links_numeric,
        incoming_counts, outgoing_counts, top_incoming, top_outgoing, page_tokens, page_bigrams, bigram_counts,
        top_bigrams, format_top_links, link_edges,
    )
}

_LINKS = """SELECT file_id, unnest(regexp_extract_all(content, '(?i)HREF="([0-9]+)\\.html"', 1)) AS target FROM web_pages"""
_EXACT = """SELECT file_id, CAST(unnest(regexp_extract_all(content, 'HREF="([0-9]+)\\.html"', 1)) AS BIGINT) AS target FROM web_pages"""
_WORDS = r"""SELECT file_id, list_filter(regexp_extract_all(lower(regexp_replace(content, '<[^>]+>', ' ', 'g')),
    '[\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[a-z]+')) AS words FROM web_pages"""
_PAIRS = """SELECT file_id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigram
    FROM tokens"""
_INCOMING = "SELECT target AS file_id, COUNT(*) AS incoming FROM links GROUP BY 1"
_OUTGOING = """SELECT file_id, CAST(SUM(len(regexp_extract_all(content, '(?i)HREF="([0-9]+)\\.html"', 1))) AS BIGINT) AS outgoing
    FROM web_pages GROUP BY 1"""
_BIGRAMS = "SELECT bigram, COUNT(*) AS occurrences FROM pairs GROUP BY 1"
_SCAN = "SELECT {id} AS file_id, CAST(length(content) AS BIGINT) AS chars, content FROM {source}"
_WHOLE = "(SELECT * FROM web_pages WHERE file_id % 25 <> 7 AND file_id % 10 <> 0)"

ORACLE = {
    "corpus_scan": duckdb(_SCAN.format(id="CAST(file_id AS VARCHAR)", source="web_pages"), "web_pages"),
    "corpus_scan_skip": duckdb(_SCAN.format(id="CAST(file_id AS VARCHAR)", source=_WHOLE), "web_pages"),
    "corpus_scan_numeric": duckdb(_SCAN.format(id="file_id", source="web_pages"), "web_pages"),
    "corpus_first_n": duckdb(
        f"""SELECT CAST(file_id AS VARCHAR) AS file_id, CAST(length(content) AS BIGINT) AS chars, content
            FROM (SELECT * FROM web_pages ORDER BY path LIMIT {FIRST_N}) WHERE file_id % 25 <> 7""", "web_pages"),
    "corpus_outcomes": duckdb(
        """SELECT path, CAST(strlen(content) AS BIGINT) AS bytes, CASE WHEN file_id % 25 = 7 THEN 'unreadable'
             WHEN file_id % 10 = 0 THEN 'repaired' ELSE 'read' END AS outcome,
             COUNT(*) FILTER (file_id % 25 <> 7) OVER () AS files_read,
             COUNT(*) FILTER (file_id % 25 <> 7 AND file_id % 10 = 0) OVER () AS files_damaged FROM web_pages""", "web_pages"),
    "corpus_run_metrics": duckdb(
        """SELECT COUNT(*) AS files, CAST(SUM(length(content)) AS BIGINT) AS chars,
           (SELECT COUNT(*) FROM links) AS links, (SELECT CAST(SUM(len(words)) AS BIGINT) FROM tokens) AS words
           FROM web_pages""", "web_pages", links=_LINKS, tokens=_WORDS),
    "extract_links": duckdb(_LINKS, "web_pages"),
    "extract_links_numeric": duckdb(_EXACT, "web_pages"),
    "incoming_counts": duckdb(_INCOMING, "web_pages", links=_LINKS),
    "outgoing_counts": duckdb(_OUTGOING, "web_pages"),
    "top_incoming": duckdb(_INCOMING + " ORDER BY incoming DESC, file_id LIMIT 5", "web_pages", links=_LINKS),
    "top_outgoing": duckdb(_OUTGOING + " ORDER BY outgoing DESC, file_id LIMIT 5", "web_pages"),
    "page_tokens": duckdb(
        """SELECT file_id, CAST(i - 1 AS INT) AS position, words[i] AS word
           FROM (SELECT file_id, words, unnest(range(1, len(words) + 1)) AS i FROM tokens)""", "web_pages", tokens=_WORDS),
    "page_bigrams": duckdb(_PAIRS, "web_pages", tokens=_WORDS),
    "bigram_counts": duckdb(_BIGRAMS, "web_pages", tokens=_WORDS, pairs=_PAIRS),
    "top_bigrams": duckdb(
        _BIGRAMS + " ORDER BY occurrences DESC, bigram LIMIT 5", "web_pages", tokens=_WORDS, pairs=_PAIRS
    ),
    "format_top_links": duckdb(
        """SELECT kind, CAST(rn AS INT) AS position, CASE kind
             WHEN 'bigram' THEN '''' || item || ''': ' || n || ' occurrences'
             WHEN 'incoming' THEN 'File ' || item || ': ' || n || ' incoming links'
             ELSE 'File ' || item || ': ' || n || ' outgoing links' END AS line
           FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, item) AS rn FROM (
             SELECT 'incoming' AS kind, file_id AS item, incoming AS n FROM inc
             UNION ALL SELECT 'outgoing', CAST(file_id AS VARCHAR), outgoing FROM outg
             UNION ALL SELECT 'bigram', bigram, occurrences FROM bi)) WHERE rn <= 5""",
        "web_pages", links=_LINKS, tokens=_WORDS, pairs=_PAIRS, inc=_INCOMING, outg=_OUTGOING, bi=_BIGRAMS),
    "link_edges": duckdb("SELECT file_id AS src, target AS dst, COUNT(*) AS mult FROM exact GROUP BY 1, 2",
                         "web_pages", exact=_EXACT),
}
