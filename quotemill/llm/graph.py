"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is its smallest node.

    Each round hangs every node on the smallest node it can see and stops when no link moves, after about as many rounds as
    the logarithm of the longest chain. Rows are (node, parent): a node with many neighbours is aggregated before it is
    shuffled and never gathered.
    """
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = staged(small.select("e.*").filter("a <> b").distinct(), name)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return roots.union(roots.select(F.col("component").alias("node"), "component").distinct())
        before = now
