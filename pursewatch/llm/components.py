"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from pursewatch.llm.common import stored


def _smallest(pairs: DataFrame, node: str, other: str) -> DataFrame:
    return pairs.groupBy(node).agg(F.min(other).alias("low"))


def _kept(edges: DataFrame, name: str) -> tuple[DataFrame, dict]:
    """The edges stored, with a mark of them that the write itself takes."""
    mark = Observation()
    seen = edges.observe(mark, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("bits"))
    return stored(seen, name), mark.get


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of the edges ``a``, ``b``.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each node hands its
    neighbours to the smallest of them, until every edge leads to the component's smallest node.
    Nodes' minima are folded before the shuffle and no neighbourhood is gathered; each round is
    written to the shared folder. Loops and repeated edges change nothing.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now, mark = _kept(edges.where("a != b").select(a, b).distinct(), "edges")
    seen = None
    while mark != seen:
        seen = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _smallest(both, "a", "b").select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a != b").distinct()
        low = _smallest(large, "a", "b")
        small = large.join(low, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(low.select("a", F.col("low").alias("b")))
        now, mark = _kept(small.distinct(), "stars")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
