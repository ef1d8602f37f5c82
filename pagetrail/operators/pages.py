"""Links and words of pages: per-page rows, counts, top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.functions import text

TOP = 5
KINDS = ("outgoing", "incoming", "bigram")


def extract_links(corpus: DataFrame) -> DataFrame:
    """(file_id, target) per link, repeats kept, targets as strings."""
    return corpus.select("file_id", F.explode(text.link_targets(F.col("content"))).alias("target"))


def extract_links_numeric(corpus: DataFrame) -> DataFrame:
    """(file_id, targets) per page id, targets as bigints. If an id occurs in several paths the last path wins."""
    pages = corpus.select("file_id", "path", text.numeric_link_targets(F.col("content")).alias("targets"))
    return pages.groupBy("file_id").agg(F.max_by("targets", "path").alias("targets"))


def outgoing_counts(corpus: DataFrame) -> DataFrame:
    """Links per page, 0 included; pages that share an id are added up."""
    links = F.size(text.link_targets(F.col("content")))
    return corpus.groupBy("file_id").agg(F.sum(links).cast("bigint").alias("outgoing"))


def incoming_counts(corpus: DataFrame) -> DataFrame:
    """Links per target, whether or not the target exists as a page."""
    return extract_links(corpus).groupBy(F.col("target").alias("file_id")).agg(F.count("*").alias("incoming"))


def page_tokens(corpus: DataFrame) -> DataFrame:
    return corpus.select("file_id", text.words(F.col("content")).alias("words"))


def page_bigrams(corpus: DataFrame) -> DataFrame:
    """(file_id, bigram) per pair of neighbouring words; no shuffle."""
    pairs = page_tokens(corpus).select("file_id", F.inline(text.word_pairs(F.col("words"))))
    return pairs.select("file_id", text.bigram(F.col("first"), F.col("second")).alias("bigram"))


def bigram_counts(corpus: DataFrame) -> DataFrame:
    return page_bigrams(corpus).groupBy("bigram").agg(F.count("*").alias("occurrences"))


def top(counts: DataFrame, key: str, count: str, n: int = TOP) -> DataFrame:
    """The ``n`` largest counts; ties by key."""
    return counts.orderBy(F.desc(count), F.asc(key)).limit(n)


def top_lists(corpus: DataFrame, n: int = TOP) -> DataFrame:
    """(kind, position, item, count): the three top lists out of one pass over the content.

    Every page emits its counts as one array, so the text is read and parsed once and all three counts share one
    shuffle of partial sums. The rank filter is applied per task before rows meet in their kind's task.
    """
    parsed = corpus.select(
        "file_id",
        text.link_targets(F.col("content")).alias("targets"),
        text.words(F.col("content")).alias("words"),
    ).withColumn("pairs", text.word_pairs(F.col("words")))

    # entries (first, second, n): an outgoing count has n, a bigram has both words, an incoming link neither
    no_words, no_counts = F.array().cast("array<string>"), F.array().cast("array<int>")
    emitted = F.concat(
        F.arrays_zip(
            F.array(F.col("file_id").cast("string")).alias("first"), no_words.alias("second"),
            F.array(F.size("targets")).alias("n"),
        ),
        F.arrays_zip(F.col("targets").alias("first"), no_words.alias("second"), no_counts.alias("n")),
        F.arrays_zip(F.col("pairs.first").alias("first"), F.col("pairs.second").alias("second"), no_counts.alias("n")),
    )
    kind = F.when(F.col("n").isNotNull(), 0).when(F.col("second").isNull(), 1).otherwise(2)
    counts = (
        parsed.select(F.inline(emitted))
        .groupBy(kind.alias("kind"), "first", "second")
        .agg(F.sum(F.coalesce("n", F.lit(1))).alias("count"))
        .select("kind", F.concat_ws(" ", "first", "second").alias("item"), "count")
    )
    order = Window.partitionBy("kind").orderBy(F.desc("count"), F.asc("item"))
    ranked = counts.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)
    return ranked.withColumn("kind", F.get(F.array(*[F.lit(kind) for kind in KINDS]), F.col("kind")))


def format_top_links(tops: DataFrame) -> DataFrame:
    """(kind, position, line): report lines of ``top_lists``."""
    line = (
        F.when(F.col("kind") == "bigram", F.format_string("'%s': %d occurrences", "item", "count"))
        .when(F.col("kind") == "incoming", F.format_string("File %s: %d incoming links", "item", "count"))
        .otherwise(F.format_string("File %s: %d outgoing links", "item", "count"))
    )
    return tops.select("kind", "position", line.alias("line"))


def corpus_run_metrics(corpus: DataFrame) -> DataFrame:
    """One row: pages, characters, links and words of a corpus."""
    content = F.col("content")
    sizes = corpus.select(
        F.length(content).alias("chars"),
        F.size(text.link_targets(content)).alias("links"),
        F.size(text.words(content)).alias("words"),
    )
    return sizes.agg(
        F.count("*").alias("files"),
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in ("chars", "links", "words")],
    )
