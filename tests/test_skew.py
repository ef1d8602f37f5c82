"""Joins and counts with one key holding more than a third of the rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagetrail.operators import graph, requests, star

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def no_broadcast(spark):
    """Settings under which the tables of a test behave like tables too large to broadcast."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_requests(spark, n=40_000):
    path = F.when(F.col("id") % 5 < 2, "hot").otherwise((F.col("id") % 1000).cast("string"))
    return spark.range(0, n, numPartitions=8).select(
        F.col("id").alias("request_id"),
        F.lit(datetime(2024, 1, 1)).alias("ts"),
        F.when(F.col("id") % 10 < 3, "POST").otherwise("GET").alias("method"),
        path.alias("path"),
        F.create_map(F.lit("X-note"), F.sha2(F.col("id").cast("string"), 512)).alias("headers"),
        F.lit("192.0.2.1").alias("remote_addr"),
    )


def test_hot_page_is_split_in_the_lookup(spark, no_broadcast):
    pages = spark.range(0, 500).select(F.concat(F.col("id").cast("string"), F.lit(".html")).alias("page"))
    pages = pages.unionByName(spark.createDataFrame([("hot.html",)], "page string"))
    routed = requests.route_requests(hot_requests(spark), pages)
    assert "skew=true" in final_plan(routed)
    counts = {r.outcome: r.n for r in routed.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    assert counts["not_implemented"] == 12_000
    assert sum(counts.values()) == 40_000


def test_requests_without_a_lookup_do_not_share_a_key(spark):
    posts = hot_requests(spark).withColumn("method", F.lit("POST"))
    pages = spark.createDataFrame([("hot.html",)], "page string")
    decided = requests.decide(posts, "v5")
    assert decided.filter("page IS NOT NULL").isEmpty()
    assert requests.route_requests(posts, pages).filter("status = 501").count() == 40_000


def test_hot_ip_is_split_in_the_fact_join(spark, no_broadcast):
    logs = hot_requests(spark).select(
        F.col("request_id").alias("id"),
        F.lit("A").alias("country"),
        F.col("path").alias("client_ip"),
        F.lit("Male").alias("gender"),
        F.lit(None).cast("int").alias("age"),
        F.lit("low").alias("income"),
        F.lit(False).alias("is_banned"),
        F.lit("00:00:00").alias("time_of_day"),
        F.element_at("headers", F.lit("X-note")).alias("requested_file"),
        F.col("ts").alias("request_time"),
    )
    failed = logs.limit(0).select("id", "request_time", "requested_file", F.lit(0).alias("error_code"))
    facts = star.build_star(logs, failed).request_events
    assert "skew=true" in final_plan(facts)
    assert facts.count() == 40_000
    assert facts.select("event_id").distinct().count() == 40_000


def test_hot_target_and_source_counts(spark, rows):
    n = 30_000
    edges = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("src"),
        F.when(F.col("id") % 3 == 1, 1).otherwise(F.col("id")).alias("dst"),
        F.lit(1).cast("bigint").alias("mult"),
    )
    nodes = spark.range(n).select(F.col("id").alias("node"))
    assert rows(graph.out_degree(nodes, edges).orderBy(F.desc("out_links")).limit(1)) == [(0, 10_000)]
    assert rows(graph.in_degree(nodes, edges).orderBy(F.desc("in_links")).limit(1)) == [(1, 10_000)]
