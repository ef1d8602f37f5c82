"""PageRank with the leak, multi-link and previous-iterate rules of the link-graph report."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.operators.graph import out_degree
from pagetrail.session import hadoop_path, materialize, remove_scratch, scratch_path

DAMPING = 0.85
BASE_RANK = 0.15
TOLERANCE = 0.005
# A page with more distinct targets than this is handled apart, so that its links spread over all tasks.
HEAVY_SOURCE_TARGETS = 1_000_000
# Stored bytes of edges in a bucket: at most, and, while there are fewer buckets than shuffle partitions, at least.
BUCKET_BYTES, SMALL_BUCKET_BYTES = 64 << 20, 1 << 20
# Ranks of heavy pages (16 bytes a row) are broadcast up to this size.
HEAVY_BROADCAST_BYTES = 16 << 20
# Lets a scan of buckets with one sorted file each count as sorted.
_SORTED_BUCKETS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@dataclass
class PageRankResult:
    """``ranks`` is (node, pr); ``changes`` the L1 change of each iteration run; ``converged`` tells whether the last one
    was below the tolerance."""

    ranks: DataFrame
    changes: list[float] = field(default_factory=list)
    converged: bool = True

    @property
    def iterations(self) -> int:
        return len(self.changes)

    def convergence(self) -> DataFrame:
        """(iteration, l1_change), one row per iteration."""
        spark = self.ranks.sparkSession
        rows = [(i + 1, change) for i, change in enumerate(self.changes)]
        return spark.createDataFrame(rows, "iteration int, l1_change double")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _stored_bytes(spark: SparkSession, path: str) -> int:
    target, store = hadoop_path(spark, path)
    return store.getContentSummary(target).getLength()


class _Links:
    """Edges stored for repeated joins with the ranks of their sources.

    Ordinary edges are a table in buckets by source, each one sorted file, so a step neither shuffles nor sorts
    them, and a lost executor costs reading its buckets again. Edges of heavy sources would fill single buckets, so they are
    spread by target and meet their few source ranks by broadcast.
    """

    def __init__(self, nodes: DataFrame, edges: DataFrame, stored: int, heavy_targets: int) -> None:
        spark = edges.sparkSession
        self._spark, self._table, self._path = spark, f"pagetrail_edges_{uuid.uuid4().hex}", scratch_path(spark, "edge-buckets")
        spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(stored / SMALL_BUCKET_BYTES))
        self.buckets = max(1, spread, math.ceil(stored / BUCKET_BYTES))
        known = edges.join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi")
        fanout = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("targets"))
        self._heavy = materialize(fanout.filter(F.col("targets") > heavy_targets).select("node"), "heavy-sources")
        self._heavy_rows = self._heavy.count()
        light = known
        self._heavy_edges = None
        if self._heavy_rows:
            heavy_src = self._heavy.select(F.col("node").alias("src"))
            light = known.join(heavy_src, "src", "left_anti")
            heavy = known.join(heavy_src, "src", "left_semi")
            self._heavy_edges = materialize(heavy.repartition(self.buckets, "dst"), "heavy-edges")
        writer = light.repartition(self.buckets, "src").write.bucketBy(self.buckets, "src").sortBy("src")
        writer.option("path", self._path).format("parquet").saveAsTable(self._table)
        self._light_edges = spark.table(self._table)

    def contributions(self, state: DataFrame) -> DataFrame:
        """(node, gain): rank flowing into each node."""
        shares = state.filter("out_links > 0").select("node", (F.col("pr") / F.col("out_links")).alias("share"))
        flows = self._flow(self._light_edges, shares)
        if self._heavy_edges is not None:
            heavy = shares.join(self._heavy, "node", "left_semi")
            if self._heavy_rows * 16 <= HEAVY_BROADCAST_BYTES:
                heavy = F.broadcast(heavy)
            flows = flows.unionByName(self._flow(self._heavy_edges, heavy))
        return flows.groupBy("node").agg(F.sum("flow").alias("gain"))

    @staticmethod
    def _flow(edges: DataFrame, shares: DataFrame) -> DataFrame:
        joined = edges.join(shares, edges["src"] == shares["node"])
        return joined.select(edges["dst"].alias("node"), (F.col("share") * F.col("mult")).alias("flow"))

    def release(self) -> None:
        self._spark.sql(f"DROP TABLE IF EXISTS {self._table}")
        remove_scratch(self._spark, self._path)


def page_rank(
    nodes: DataFrame,
    edges: DataFrame,
    tolerance: float = TOLERANCE,
    fixed_iterations: int | None = None,
    heavy_targets: int = HEAVY_SOURCE_TARGETS,
) -> PageRankResult:
    """Rank ``nodes`` (node) over ``edges`` (src, dst, mult).

    A rank starts at 1/n and becomes 0.15/n + 0.85 * sum(rank(src) * mult / out(src)), where out(src) counts every
    link, also those to unknown targets; pages without links pass nothing on. The loop ends when the L1 change falls
    below ``tolerance`` and returns the ranks *before* that last step; it always ends, as a step shrinks the change by
    the damping factor. With ``fixed_iterations`` it runs that many steps and returns the last.

    Each step's ranks are written to the shared folder, so the plan stays one step long, and the ranks before them are
    removed. The driver sees one number per step.
    """
    spark = nodes.sparkSession
    # a text-free copy of the input, so that the steps below do not compute it again
    edges_path = scratch_path(spark, "edges")
    edges = materialize(edges.select("src", "dst", "mult"), "edges", edges_path)
    nodes = materialize(nodes.select("node").distinct(), "nodes")
    n = nodes.count()
    if n == 0:
        raise ValueError("no nodes to rank")
    links = _Links(nodes, edges, _stored_bytes(spark, edges_path), heavy_targets)
    state_path = scratch_path(spark, "ranks")
    state = materialize(out_degree(nodes, edges).withColumn("pr", F.lit(1.0 / n)), "ranks", state_path)
    changes: list[float] = []
    try:
        with _setting(spark, _SORTED_BUCKETS, "true"):
            while fixed_iterations is None or len(changes) < fixed_iterations:
                gains = links.contributions(state)
                new_rank = F.lit(BASE_RANK / n) + F.lit(DAMPING) * F.coalesce(F.col("gain"), F.lit(0.0))
                step = state.join(gains, "node", "left").select(
                    "node", "out_links", new_rank.alias("pr"), F.abs(new_rank - F.col("pr")).alias("moved")
                )
                written_path = scratch_path(spark, "ranks")
                written = materialize(step, "ranks", written_path)
                changes.append(written.agg(F.sum("moved")).first()[0])
                if fixed_iterations is None and changes[-1] < tolerance:
                    remove_scratch(spark, written_path)
                    break
                remove_scratch(spark, state_path)
                state, state_path = written.drop("moved"), written_path
    finally:
        links.release()
    return PageRankResult(state.select("node", "pr"), changes, bool(changes) and changes[-1] < tolerance)


def top_ranked(ranks: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` highest ranks; ties by node."""
    return ranks.orderBy(F.desc("pr"), F.asc("node")).limit(n)
