"""Connected components of a graph given by its links, by alternating large and small stars.

Each round links every node's larger neighbours (large star), then its smaller ones (small star),
to the smallest node it sees; a component becomes a star around its smallest node after a number
of rounds that grows with the logarithm of its size. Rounds are written tables. A node with very
many links is one row where minima are taken (they are combined before the shuffle) and is joined
with its links between two plain exchanges, which adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanwh.llm.shared import written


def state(links: DataFrame) -> tuple:
    """Number and order-free checksum of the links."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first())


def with_minimum(links: DataFrame) -> DataFrame:
    """(a, b) with ``m``, the smallest of a and all its neighbours b."""
    least = written(links.groupBy("a").agg(F.min("b").alias("m")), "least")
    return links.join(least.hint("merge"), "a").withColumn("m", F.least("a", "m"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``links`` (a, b: bigint) is connected to.
    Nodes without a link to another node are not in the result."""
    links = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, now = None, state(links)
    while now != before and now[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = with_minimum(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = written(large, "large-star")
        small = with_minimum(large)
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l")).select("l.*")
        links = written(small.where("a <> b").distinct(), "small-star")
        before, now = now, state(links)
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
