"""Directories of HTML files as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagetrail.functions import text


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.html")
        .option("ignoreCorruptFiles", "true")
        .option("ignoreMissingFiles", "true")
        .load(paths)
    )


def pages_of(files: DataFrame) -> DataFrame:
    """(path, file_id, content, bytes, damaged) of files (path, content binary); undecodable bytes are removed where
    ``damaged``. Files without content could not be read and are left out."""
    raw = F.col("content")
    read = files.filter(raw.isNotNull()).withColumn("damaged", ~F.is_valid_utf8(raw.cast("string")))
    return read.select(
        "path", text.file_id(F.col("path")).alias("file_id"), text.drop_undecodable(raw).alias("content"),
        F.octet_length(raw).cast("bigint").alias("bytes"), "damaged",
    )


def kept_pages(pages: DataFrame, on_bad_utf8: str = "drop") -> DataFrame:
    """Pages as their text allows: ``"drop"`` keeps damaged ones without the undecodable bytes, ``"skip"`` leaves them out."""
    if on_bad_utf8 not in ("drop", "skip"):
        raise ValueError(f"on_bad_utf8 must be 'drop' or 'skip', not {on_bad_utf8!r}")
    return pages.filter(~F.col("damaged")) if on_bad_utf8 == "skip" else pages


def numbered(files: DataFrame) -> DataFrame:
    """(path, file_id, content) of undamaged files whose name ends in ``<number>.html``, with that number as file_id."""
    named = files.filter(text.numeric_file_id(F.col("path")).isNotNull())
    pages = kept_pages(pages_of(named), "skip")
    return pages.select("path", text.numeric_file_id(F.col("path")).alias("file_id"), "content")


def corpus_scan(spark: SparkSession, paths: str | list[str], on_bad_utf8: str = "drop") -> DataFrame:
    """One row per ``*.html`` file: path, file_id, content.

    ``on_bad_utf8="drop"`` removes undecodable bytes; ``"skip"`` leaves out files that have any.
    """
    return kept_pages(pages_of(_files(spark, paths)), on_bad_utf8).select("path", "file_id", "content")


def corpus_scan_numeric(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``numbered`` over the HTML files of a folder; others are left out unopened."""
    return numbered(_files(spark, paths))


def first_files(spark: SparkSession, paths: str | list[str], n: int | None) -> DataFrame:
    """The first ``n`` files by path; all of them if ``n`` is None or not positive.

    The listing gives the last of the wanted paths; files behind it are left out before any file is opened.
    """
    if n is None or n <= 0:
        return _files(spark, paths)
    location = F.col("_metadata.file_path")
    last = _files(spark, paths).select(location.alias("at")).orderBy("at").limit(n).agg(F.max("at")).first()[0]
    require(last is not None, f"no HTML files under {paths}")
    return _files(spark, paths).filter(location <= last)


def corpus_first_n(spark: SparkSession, paths: str | list[str], n: int | None, on_bad_utf8: str = "drop") -> DataFrame:
    """``corpus_scan`` of the first ``n`` files by path."""
    return kept_pages(pages_of(first_files(spark, paths, n)), on_bad_utf8).select("path", "file_id", "content")


def compacted(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``pages_of`` all HTML files."""
    return pages_of(_files(spark, paths))


def first_rows(rows: DataFrame, n: int | None) -> DataFrame:
    """As ``first_files`` for a table with a ``path``."""
    if n is None or n <= 0:
        return rows
    last = rows.select("path").orderBy("path").limit(n).agg(F.max("path")).first()[0]
    return rows.filter(F.col("path") <= last)


def table_first_n(pages: DataFrame, n: int | None, on_bad_utf8: str = "drop") -> DataFrame:
    """As ``corpus_first_n`` for a table written from ``compacted``."""
    return kept_pages(first_rows(pages, n), on_bad_utf8)


def listing(spark: SparkSession, paths: str | list[str], n: int | None = None) -> DataFrame:
    """(path, bytes) of the first ``n`` HTML files, unopened."""
    return first_files(spark, paths, n).select("path", F.col("length").alias("bytes"))


def file_outcomes(listed: DataFrame, pages: DataFrame, on_bad_utf8: str = "drop") -> DataFrame:
    """(path, bytes, outcome) for each file of ``listed`` (path, bytes): ``read``, ``repaired`` or ``skipped`` where it was damaged, and
    ``unreadable`` where ``pages`` (path, damaged), written before, has no row of it."""
    damaged = F.lit("skipped" if on_bad_utf8 == "skip" else "repaired")
    outcome = F.when(F.col("damaged").isNull(), "unreadable").when(F.col("damaged"), damaged).otherwise("read")
    return listed.join(pages.select("path", "damaged"), "path", "left").select("path", "bytes", outcome.alias("outcome"))


def observed(pages: DataFrame, name: str = "pages") -> tuple[DataFrame, Observation]:
    """``pages`` and what the job that reads them sees on its way: files, bytes and damaged files."""
    seen = Observation(name)
    counts = (
        F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count_if("damaged").alias("damaged")
    )
    return pages.observe(seen, *counts), seen


def is_table(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a finished parquet table and not a folder of HTML files."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("ignoreMissingFiles", "true")
    return not listed.load(path).select("path").isEmpty()


def numbered_pages(spark: SparkSession, source: str) -> DataFrame:
    """``corpus_scan_numeric`` of a folder, or the numbered pages of a compacted table."""
    if not is_table(spark, source):
        return corpus_scan_numeric(spark, source)
    pages = spark.read.parquet(source).withColumn("file_id", text.numeric_file_id(F.col("path")))
    return pages.filter("file_id IS NOT NULL")


def file_totals(spark: SparkSession, paths: str | list[str]) -> dict[str, int]:
    """Number and bytes of the HTML files, without opening them."""
    totals = _files(spark, paths).agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    return totals.first().asDict()


def require(condition: bool, message: str) -> None:
    if not condition:
        raise ValueError(message)
