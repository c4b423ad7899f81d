"""Connected components of a link table, by large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from iotlake.llm.tables import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that is linked with another; component is its smallest reachable node.

    Null ends and links of a node with itself count for nothing. Each round is a table in the shared folder;
    rounds end when a round changes nothing.
    """
    edges = stored(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "components")
    before = None
    while True:
        seen = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if seen == before or not seen.n:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before = seen
        edges = stored(_small_star(_large_star(edges)), "components")
