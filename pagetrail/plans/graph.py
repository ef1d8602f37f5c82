"""Registered queries over the link graph at scale."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagetrail.adapters import duckdb, graph_edges, graph_nodes
from pagetrail.operators import graph
from pagetrail.operators.pagerank import page_rank, top_ranked

FIXED_STEPS = 2
# the check unrolls this many steps; convergence on the driver's graph takes fewer
_UNROLLED = 12


def in_degree(spark, sf_dir):
    return graph.in_degree(graph_nodes(spark, sf_dir), graph_edges(spark, sf_dir))


def out_degree(spark, sf_dir):
    return graph.out_degree(graph_nodes(spark, sf_dir), graph_edges(spark, sf_dir))


def degree_stats(spark, sf_dir):
    stats = graph.degree_stats(graph_nodes(spark, sf_dir), graph_edges(spark, sf_dir))
    rounded = [F.round(name, 6).alias(name) for name in ("mean", "median", "q20", "q40", "q60", "q80")]
    return stats.select("direction", "max", "min", *rounded)


def _ranked(spark, sf_dir, **options):
    return page_rank(graph_nodes(spark, sf_dir), graph_edges(spark, sf_dir), **options)


def _rounded(ranks):
    return ranks.select("node", F.round("pr", 9).alias("pr"))


def pagerank(spark, sf_dir):
    return _rounded(_ranked(spark, sf_dir).ranks)


def pagerank_fixed_k(spark, sf_dir):
    return _rounded(_ranked(spark, sf_dir, fixed_iterations=FIXED_STEPS).ranks)


def pagerank_convergence(spark, sf_dir):
    return _ranked(spark, sf_dir).convergence().select("iteration", F.round("l1_change", 9).alias("l1_change"))


def pagerank_top(spark, sf_dir):
    return _rounded(top_ranked(_ranked(spark, sf_dir).ranks))


QUERIES = {
    f.__name__: f
    for f in (in_degree, out_degree, degree_stats, pagerank, pagerank_fixed_k, pagerank_convergence, pagerank_top)
}

_IN = """SELECT node, CAST(COALESCE(SUM(mult), 0) AS BIGINT) AS in_links
    FROM graph_nodes LEFT JOIN graph_edges ON dst = node GROUP BY 1"""
_OUT = """SELECT node, CAST(COALESCE(SUM(mult), 0) AS BIGINT) AS out_links
    FROM graph_nodes LEFT JOIN graph_edges ON src = node GROUP BY 1"""


def _cuts(direction: str, column: str, source: str) -> str:
    cuts = ", ".join(f"ROUND(quantile_cont({column}, {q}), 6) AS {name}" for name, q in
                     (("median", 0.5), ("q20", 0.2), ("q40", 0.4), ("q60", 0.6), ("q80", 0.8)))
    return (f"SELECT '{direction}' AS direction, MAX({column}) AS max, MIN({column}) AS min, "
            f"ROUND(AVG({column}), 6) AS mean, {cuts} FROM {source}")


def _chain(steps: int, query: str) -> str:
    """Unrolled ranks p0..pk with their changes."""
    parts = [
        "graph_nodes AS MATERIALIZED (SELECT p_partkey AS node FROM part)",
        """graph_edges AS MATERIALIZED (SELECT l_orderkey % n AS src, l_partkey AS dst, COUNT(*) AS mult
           FROM lineitem CROSS JOIN (SELECT COUNT(*) AS n FROM part) c GROUP BY 1, 2)""",
        "n AS MATERIALIZED (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM graph_nodes)",
        f"outs AS MATERIALIZED ({_OUT})",
        "p0 AS MATERIALIZED (SELECT node, 1.0e0 / n AS pr, CAST(NULL AS DOUBLE) AS moved FROM graph_nodes, n)",
    ]
    for k in range(1, steps + 1):
        parts.append(f"""p{k} AS MATERIALIZED (
            SELECT q.node, 0.15e0 / n + 0.85e0 * COALESCE(g.gain, 0) AS pr,
                   abs(0.15e0 / n + 0.85e0 * COALESCE(g.gain, 0) - q.pr) AS moved
            FROM p{k - 1} q CROSS JOIN n LEFT JOIN (
                SELECT dst, SUM(mult * s.pr / out_links) AS gain
                FROM graph_edges JOIN p{k - 1} s ON s.node = src JOIN outs o ON o.node = src
                GROUP BY dst) g ON g.dst = q.node)""")
    changes = " UNION ALL ".join(
        f"SELECT {k} AS iteration, SUM(moved) AS l1_change FROM p{k}" for k in range(1, steps + 1)
    )
    ranks = " UNION ALL ".join(f"SELECT {k} AS step, node, pr FROM p{k}" for k in range(steps + 1))
    parts += [
        f"changes AS MATERIALIZED ({changes})",
        f"ranks AS ({ranks})",
        "stop AS (SELECT MIN(iteration) AS k FROM changes WHERE l1_change < 0.005e0)",
    ]
    return f"WITH {', '.join(parts)} {query}"


ORACLE = {
    "in_degree": duckdb(_IN, "graph_nodes", "graph_edges"),
    "out_degree": duckdb(_OUT, "graph_nodes", "graph_edges"),
    "degree_stats": duckdb(
        _cuts("incoming", "in_links", "ins") + " UNION ALL " + _cuts("outgoing", "out_links", "outs"),
        "graph_nodes", "graph_edges", ins=_IN, outs=_OUT),
    "pagerank": _chain(_UNROLLED, "SELECT node, ROUND(pr, 9) AS pr FROM ranks, stop WHERE step = k - 1"),
    "pagerank_fixed_k": _chain(FIXED_STEPS, f"SELECT node, ROUND(pr, 9) AS pr FROM p{FIXED_STEPS}"),
    "pagerank_convergence": _chain(
        _UNROLLED, "SELECT iteration, ROUND(l1_change, 9) AS l1_change FROM changes, stop WHERE iteration <= k"
    ),
    "pagerank_top": _chain(
        _UNROLLED, "SELECT node, ROUND(pr, 9) AS pr FROM ranks, stop WHERE step = k - 1 ORDER BY ranks.pr DESC, node LIMIT 5"
    ),
}
