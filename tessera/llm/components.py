"""Connected components of a link table, by alternating star contraction.

Only DataFrame operations: partial minima before each shuffle, joins that AQE can
split when one node has very many links, and a checkpoint in the shared folder
after every round so that lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import shared_dir


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that occurs in links(a, b); root is the smallest
    node reachable. Null ends and loops link nothing; nodes without a link to
    another node don't occur. Repeated links count once. An empty table gives an
    empty table.

    Each round: every node's larger neighbours move to its smallest neighbour
    (large star), then every node's smaller neighbours move to the smallest of
    them (small star). It ends when each node hangs directly on one root.
    """
    shared_dir(links.sparkSession)
    edges = _ordered(links).checkpoint()
    while True:
        if _is_star_forest(edges):
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("low").alias("a"), F.col("v").alias("b")).where("a < b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("low"))
        joined = large.join(least, "b")
        small = joined.select(F.col("low").alias("a"), "b").unionByName(joined.where("a > low").select(F.col("low").alias("a"), F.col("a").alias("b")))
        edges = small.distinct().checkpoint()


def _is_star_forest(edges: DataFrame) -> bool:
    """True if no node has two parents and no parent has a parent itself."""
    twice = edges.groupBy("b").agg(F.count("*").alias("n")).where("n > 1")
    chained = edges.select("a").distinct().join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
    return twice.isEmpty() and chained.isEmpty()
