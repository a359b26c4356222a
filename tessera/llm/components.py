"""Connected components of a table of links, by large-star / small-star rounds.

Each round re-points links to smaller ids (Kiveris et al., 2014) until nothing changes; every
node then points to the smallest id it can reach.  In a large star the minima are written
before they are joined, so that the join is between two plain shuffles and a node with very
many links can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(links: DataFrame):
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected links (a, b); ids are not null."""
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))  # few smaller neighbours each
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = cut(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(links)
        if state == before:
            break
    own = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)
