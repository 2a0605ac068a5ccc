"""Connected components of an undirected graph, by large-star and small-star rounds over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import written

#: Smallest neighbours of up to this many nodes (16 bytes each) are broadcast to the edges; more are joined by shuffle.
BROADCAST_NODES = 500_000


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns a, b. Returns node and root, the smallest node reachable, for all nodes but the roots.

    Each round links the neighbours of a node to the smallest of them: first the larger ones, then the others. The smallest is an
    aggregate that combines map-side, and the join that brings it back, if it is no broadcast, is between plain shuffles, which
    adaptive execution splits where a node has very many neighbours. The graph is done when no node with a smaller neighbour has any other
    one: all edges then lead to the root. The driver sees two counts per round.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = now.union(now.select("b", "a"))
        low = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n")))
        ends, unfinished = _progress(low)
        if not unfinished:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        few = ends <= BROADCAST_NODES
        keep = _plan if few else written
        large = keep(both.where("b > a").join(_sized(low.select("a", "m"), few), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))
        low = keep(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(_sized(low, few), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now = written(small.where("a <> b").distinct())


def _plan(df: DataFrame) -> DataFrame:
    """What is joined by broadcast need not be written first."""
    return df


def _sized(low: DataFrame, few: bool) -> DataFrame:
    """A graph has at most twice as many nodes as edges, so the number of edges bounds the table."""
    return F.broadcast(low) if few else low


def _progress(low: DataFrame) -> tuple[int, int]:
    """Twice the number of edges; the number of nodes with a smaller neighbour and another one."""
    return tuple(low.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if((F.col("m") < F.col("a")) & (F.col("n") > 1))).first())
