"""Connected components by alternating stars, with every round written to shared storage.

Each round links a node's larger neighbours to its smallest one (large star), then a node
and its smaller neighbours to the smallest of them (small star). The number of edges never
grows, and paths shorten by half or more, so the rounds grow with the logarithm of the
longest path. A node with very many neighbours is a map-side combined minimum followed by
an equi-join, which adaptive execution splits; nothing is gathered per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.common import settle


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return edges.select(F.inline(ends))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    least = near.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    return (
        near.where("b > a")
        .join(least, F.col("a") == F.col("u"))
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` hold the larger node in a."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    lifted = edges.join(least, F.col("a") == F.col("u")).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lifted.union(least.select("u", "m")).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether each node hangs on one root, and no root hangs on a node."""
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )
    seen = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node it can reach.

    ``links`` holds undirected pairs of longs in columns ``a`` and ``b``; pairs with a null,
    loops and repeated pairs change nothing. A node that only has loops is left out.
    """
    whole = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = whole.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b")
    edges = settle(pairs.distinct(), "edges")
    while not _is_done(edges):
        edges = settle(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
