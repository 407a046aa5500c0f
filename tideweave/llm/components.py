"""Connected components of an edge list by alternating star contractions, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideweave.llm.common import stored

#: Rounds after which a graph counts as not converging; each at least halves the longest paths.
MOST_ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star step, then one small-star step, on edges (a, b) with a < b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").where("b > a AND b <> m").select(F.col("m").alias("a"), "b").distinct()
    # Each node's smaller neighbours are joined to the smallest of them.
    low = large.groupBy("b").agg(F.min("a").alias("m"))
    rest = large.join(low, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return low.select(F.col("m").alias("a"), "b").unionByName(rest).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the root is the smallest node it is connected to.

    Edges of a node with itself and repeated edges add nothing; no edges give no rows.
    """
    now = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    now = stored(now, "edges")
    state = None
    for _ in range(MOST_ROUNDS):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
            return roots.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        state, now = seen, stored(_stars(now), "edges")
    raise RuntimeError("components did not converge")
