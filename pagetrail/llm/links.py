"""Connected components of link tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.session import materialize, remove_scratch, scratch_path


def _written(df: DataFrame, paths: list[str]) -> DataFrame:
    path = scratch_path(df.sparkSession, "links")
    paths.append(path)
    return materialize(df, "links", path)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for each node of ``links`` (a, b) but the roots.

    Links between a node and itself and repeated links do not count; nulls must not occur. Alternating star contraction:
    each round hangs the neighbours of a node on its smallest neighbour, first the larger ones, then the smaller ones,
    until every component is one star. Rounds grow with the logarithm of the size; every round is written to the shared
    folder, so that joins on a node with very many links can be split, and old rounds are removed.
    """
    spark = links.sparkSession
    paths: list[str] = []
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    stars = _written(pairs, paths)
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = _written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), paths)
        larger = both.join(smallest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = _written(larger.distinct(), paths)
        smallest = _written(larger.groupBy("a").agg(F.min("b").alias("m")), paths)
        smaller = larger.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
        stars = _written(smaller.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct(), paths)
        nodes = stars.agg(F.count("*"), F.countDistinct("a")).first()
        hung = stars.select(F.col("b").alias("a")).join(stars.select("a"), "a", "left_semi").isEmpty()
        for path in paths[:-1]:
            remove_scratch(spark, path)
        del paths[:-1]
        if hung and nodes[0] == nodes[1]:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
