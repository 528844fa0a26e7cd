"""Connected components of a graph given as links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.frames import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node itself)."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame, label: str = "components") -> DataFrame:
    """Rows (node, root) for every node of `links(a, b)`; root is the smallest node reachable.

    Each round halves the distances, so rounds grow with the logarithm of the longest chain. A round is
    stored, which cuts lineage; only a count and a checksum come to the driver. Neighbours are never
    gathered: minima are combined before the shuffle, and the join on a hub can be split.
    Links of a node to itself are ignored.
    """
    links = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{label}-links",
    )
    state = None
    while True:
        now = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first()
        if tuple(now) == state or now[0] == 0:
            break
        state = tuple(now)
        links = stored(_small_star(_large_star(links)), f"{label}-round")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
