"""Link graph: edges, degrees, degree statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def link_edges(links: DataFrame) -> DataFrame:
    """(src, dst, mult) out of (file_id, targets); repeated links add to ``mult``."""
    pairs = links.select(F.col("file_id").alias("src"), F.explode("targets").alias("dst"))
    return pairs.groupBy("src", "dst").agg(F.count("*").alias("mult"))


def out_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, out_links) for every node; links to unknown targets count too."""
    totals = edges.groupBy(F.col("src").alias("node")).agg(F.sum("mult").alias("out_links"))
    return nodes.join(totals, "node", "left").select("node", F.coalesce("out_links", F.lit(0)).alias("out_links"))


def in_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, in_links) for every node; links to unknown targets go nowhere."""
    totals = edges.groupBy(F.col("dst").alias("node")).agg(F.sum("mult").alias("in_links"))
    return nodes.join(totals, "node", "left").select("node", F.coalesce("in_links", F.lit(0)).alias("in_links"))


def degree_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per direction: mean, median, max, min and the quintiles, linearly interpolated and exact.

    Degrees are first reduced to a histogram. A graph of E links has fewer than 2*sqrt(E) distinct degrees, so the
    percentile step sees few rows however large the graph is.
    """
    def histogram(degrees: DataFrame, column: str, direction: str) -> DataFrame:
        counted = degrees.groupBy(F.col(column).alias("degree")).agg(F.count("*").alias("n"))
        return counted.withColumn("direction", F.lit(direction))

    both = histogram(in_degree(nodes, edges), "in_links", "incoming").unionByName(
        histogram(out_degree(nodes, edges), "out_links", "outgoing")
    )
    cuts = F.percentile("degree", F.array(*[F.lit(q) for q in (0.2, 0.4, 0.5, 0.6, 0.8)]), F.col("n"))
    stats = both.groupBy("direction").agg(
        (F.sum(F.col("degree") * F.col("n")) / F.sum("n")).alias("mean"),
        F.max("degree").alias("max"),
        F.min("degree").alias("min"),
        cuts.alias("cuts"),
    )
    return stats.select(
        "direction",
        "mean",
        F.col("cuts")[2].alias("median"),
        "max",
        "min",
        F.col("cuts")[0].alias("q20"),
        F.col("cuts")[1].alias("q40"),
        F.col("cuts")[3].alias("q60"),
        F.col("cuts")[4].alias("q80"),
    )
