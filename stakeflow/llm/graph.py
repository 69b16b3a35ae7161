"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeflow.llm.tables import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u, v``): root is the smallest node
    of its component.

    Alternates large and small stars until the edges stay the same; every round
    is a written table.  Hubs cost one partial minimum per task, and their
    edges spread again as they are tied to smaller nodes.
    """
    now = materialise(edges.where("u <> v").select("u", "v").distinct(), name)
    seen = None
    while True:
        for star in (_large_star, _small_star):
            now = materialise(star(now).where("u <> v").distinct(), name)
        mark = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == seen or not mark[0]:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v"), F.col("v"))).distinct()
