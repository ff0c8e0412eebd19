"""Connected components of an edge table, as a loop of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import LoopState, broadcast_if_small, cut_lineage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of an undirected edge table; the component is its smallest node.

    Alternates two steps until nothing changes: every node links its larger
    neighbours to its smallest one, then its smaller neighbours. Both are an
    aggregation (combined before the shuffle), whose result is written, and an
    equi-join with it: a broadcast while it is small, else a plain shuffle join,
    whose partitions Spark can split, so a node may have a third of all edges. Each round is written to the
    checkpoint folder; only a count and a checksum come to the driver. Self loops
    make a component of one, null ends are ignored, an empty table gives no rows.
    """
    state = LoopState(edges.sparkSession)
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    now = state.save(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select("b", "b")
            ).groupBy("node").agg(F.min("component").alias("component"))
        seen = mark
        now = state.save(_small_star(_large_star(now)))


def _small(least: DataFrame) -> DataFrame:
    """Written once; broadcast up to 200,000 nodes, some tens of MB."""
    return broadcast_if_small(cut_lineage(least), 200_000)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _small(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    return both.where("b >= a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = _small(edges.groupBy("a").agg(F.min("b").alias("m")))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).distinct()
