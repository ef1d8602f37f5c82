import pytest
from pyspark.sql import functions as F

from pagetrail.operators import graph, pagerank
from pagetrail.operators.pagerank import page_rank, top_ranked
from pagetrail.session import materialize

TINY = [(0, 1), (0, 2), (1, 2), (2, 0), (3, 0), (3, 1), (3, 2)]


def make(spark, nodes, links):
    edges = spark.createDataFrame(links, "src long, dst long").groupBy("src", "dst").agg(F.count("*").alias("mult"))
    return spark.createDataFrame([(n,) for n in nodes], "node long"), edges


def by_node(ranks):
    return {row.node: row.pr for row in ranks.collect()}


def brute_force(nodes, links, tolerance=0.005):
    n = len(nodes)
    rank = dict.fromkeys(nodes, 1 / n)
    out = {v: sum(1 for s, _ in links if s == v) for v in nodes}
    while True:
        new = dict.fromkeys(nodes, 0.15 / n)
        for s, t in links:
            if s in rank and t in rank:
                new[t] += 0.85 * rank[s] / out[s]
        if sum(abs(new[v] - rank[v]) for v in nodes) < tolerance:
            return rank
        rank = new


def test_sanity(spark):
    ranks = by_node(page_rank(*make(spark, range(4), TINY)).ranks)
    assert abs(sum(ranks.values()) - 1) < 0.01
    assert min(ranks, key=ranks.get) == 3 and max(ranks, key=ranks.get) == 2


def test_returns_the_iterate_before_the_last_step(spark):
    result = page_rank(*make(spark, range(4), TINY))
    assert result.iterations == 9
    assert result.changes[-1] == pytest.approx(0.003619, abs=1e-6)
    assert [by_node(result.ranks)[v] for v in range(4)] == pytest.approx([0.373561, 0.207492, 0.381447, 0.0375], abs=1e-6)


def test_links_to_missing_pages_leak(spark):
    ranks = by_node(page_rank(*make(spark, range(2), [(0, 1), (0, 9)]), fixed_iterations=1).ranks)
    assert ranks == pytest.approx({0: 0.075, 1: 0.2875})


@pytest.mark.parametrize("heavy_targets", [1_000_000, 1])
def test_hub_with_a_third_of_all_links(spark, heavy_targets):
    """The separate path for heavy sources gives the same ranks as brute force."""
    nodes = range(40)
    links = [(0, t) for t in range(1, 40)] + [(s, s % 7) for s in nodes] + [(s, s % 7) for s in nodes] + [(5, 99)]
    ranks = by_node(page_rank(*make(spark, nodes, links), heavy_targets=heavy_targets).ranks)
    assert ranks == pytest.approx(brute_force(list(nodes), links))


def test_top_ties_by_node(spark):
    nodes, edges = make(spark, [4, 3, 2, 1], [(1, 9)])
    result = page_rank(nodes, edges, fixed_iterations=1)
    assert [row.node for row in top_ranked(result.ranks, 2).collect()] == [1, 2]


def test_degrees(spark, rows):
    nodes, edges = make(spark, range(3), [(0, 1), (0, 1), (0, 9), (2, 0)])
    assert rows(graph.in_degree(nodes, edges)) == [(0, 1), (1, 2), (2, 0)]
    assert rows(graph.out_degree(nodes, edges)) == [(0, 3), (1, 0), (2, 1)]


def test_degree_stats_interpolate(spark):
    degrees = [1, 2, 5, 9, 10]
    links = [(100 + i, node) for node, n in enumerate(degrees) for i in range(n)]
    stats = graph.degree_stats(*make(spark, range(5), links)).filter("direction = 'incoming'").first()
    assert [stats.q20, stats.q40, stats.q60, stats.q80] == pytest.approx([1.8, 3.8, 6.6, 9.2])
    assert (stats["median"], stats["max"], stats["min"], stats["mean"]) == (5, 10, 1, pytest.approx(5.4))


def test_multi_links(spark, rows):
    links = spark.createDataFrame([(0, [1, 1, None])], "file_id long, targets array<long>")
    assert rows(graph.link_edges(links)) == [(0, 1, 2), (0, None, 1)]


def test_a_step_neither_shuffles_nor_sorts_edges(spark):
    nodes = spark.range(3000).withColumnRenamed("id", "node")
    edges = spark.range(30_000).select((F.col("id") % 3000).alias("src"), (F.col("id") * 7 % 3000).alias("dst"))
    edges = materialize(edges.groupBy("src", "dst").agg(F.count("*").alias("mult")), "edges")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = pagerank._Links(nodes, edges, 4 << 20, 1_000_000)
        assert links.buckets == 4
        state = materialize(graph.out_degree(nodes, edges).withColumn("pr", F.lit(1.0 / 3000)), "ranks")
        with pagerank._setting(spark, pagerank._SORTED_BUCKETS, "true"):
            flows = links._flow(links._light_edges, state.select("node", F.col("pr").alias("share")))
            plan = flows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(node") == 1 and "hashpartitioning(src" not in plan
        assert plan.count("Sort [node") == 1 and "Sort [src" not in plan and "Bucketed: true" in plan
        assert flows.count() == edges.count()
        links.release()
        assert not spark.catalog.tableExists(links._table)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_buckets_follow_stored_bytes(spark):
    nodes, edges = make(spark, range(4), TINY)
    for stored, expected in ((1, 1), (3 << 20, 3), (pagerank.BUCKET_BYTES * 9, 9)):
        links = pagerank._Links(nodes, edges, stored, 1_000_000)
        links.release()
        assert links.buckets == expected
